"""Document fingerprints by Order MinHash, in DataFrame functions only.

A document is its sequence of words. Each k-mer (k words in a row) is numbered by its occurrence, so a repeated k-mer counts
as often as it occurs. A random order of the numbered k-mers is dealt over the slots of the signature by their hash; each slot selects
its ``minimal`` smallest, puts them back into the order of the text and hashes that tuple. Two documents agree in a slot
if they share both the selected k-mers and their order, so the share of equal slots falls with the edit distance, also where
moving text about leaves the set of k-mers as it was.

Everything happens inside one row: k-mers and positions are packed into 64-bit integers, so that ordering them is one
sort of primitive integers, and no row of the document is ever exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed layout: the lowest bits of a packed integer hold the position of a k-mer, those above it a hash.
POSITION_BITS = 23
POSITIONS = 1 << POSITION_BITS
SLOTS, MINIMAL, K = 64, 2, 3
EMPTY = -1


def packed(hashed: Column, position: Column) -> Column:
    """The upper bits of a hash with a position below them. Beyond 2^23 words positions begin anew, which orders ties only."""
    return F.shiftleft(F.shiftright(hashed, POSITION_BITS), POSITION_BITS).bitwiseOR(F.pmod(position, F.lit(POSITIONS)).cast("long"))


def position(x: Column) -> Column:
    return x.bitwiseAND(F.lit(POSITIONS - 1))


def differs(values: Column, x: Column, i: Column, back: int, bits: int) -> Column:
    """Whether ``x`` at index ``i`` has other bits from ``bits`` up than the value ``back`` places before it, or there is none."""
    return F.coalesce(F.shiftright(x.bitwiseXOR(F.get(values, i - back)), bits) != 0, F.lit(True))


def group_starts(values: Column, bits: int) -> Column:
    """The indexes, from 0, at which a sorted array of integers begins a new value of the bits from ``bits`` up."""
    indexes = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)))
    starts = F.filter(indexes, lambda i: differs(values, F.get(values, i), i, 1, bits))
    return F.when(F.size(values) > 0, starts).otherwise(F.array().cast("array<int>"))


def with_fingerprint(
    docs: DataFrame, text: Column, name: str, k: int = K, slots: int = SLOTS, minimal: int = MINIMAL, seed: int = 0
) -> DataFrame:
    """``docs`` with ``name``, an array of ``slots`` 32-bit hashes; -1 marks a slot that no k-mer fell into.

    Words are what stands between white space. A text of fewer than ``k`` words is one k-mer of all its words; a text without
    words, or a null one, has only empty slots. Equal texts have equal fingerprints.
    """
    if slots < 2 or slots & (slots - 1):
        raise ValueError("the number of slots must be a power of 2")
    slot_bits = 64 - (slots - 1).bit_length()
    words, kmers, repeats, starts, numbered, chosen, order = (
        f"__{name}_{x}" for x in ("words", "kmers", "repeats", "starts", "numbered", "chosen", "order")
    )
    none = F.array().cast("array<bigint>")
    found = docs.withColumn(words, F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""))
    n = F.size(words)
    each = F.transform(
        F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))),
        lambda i: packed(F.xxhash64(F.lit(seed), *[F.get(F.col(words), i + j) for j in range(k)]), i),
    )
    found = found.withColumn(kmers, F.when(n > 0, F.sort_array(each)).otherwise(none))
    # Equal k-mers now stand side by side in the order of the text: those after the first are numbered by their place.
    again = F.filter(F.col(kmers), lambda x, i: ~differs(F.col(kmers), x, i, 1, POSITION_BITS))
    found = found.withColumn(repeats, again)
    found = found.withColumn(starts, group_starts(F.col(repeats), POSITION_BITS))

    def numbered_hash(x: Column, occurrence: Column) -> Column:
        return packed(F.xxhash64(F.shiftright(x, POSITION_BITS), occurrence), position(x))

    firsts = F.transform(
        F.filter(F.col(kmers), lambda x, i: differs(F.col(kmers), x, i, 1, POSITION_BITS)),
        lambda x: numbered_hash(x, F.lit(0)),
    )
    later = F.flatten(
        F.transform(
            F.col(starts),
            lambda start, g: F.transform(
                F.slice(F.col(repeats), start + 1, F.coalesce(F.get(F.col(starts), g + 1), F.size(repeats)) - start),
                lambda x, i: numbered_hash(x, i + 1),
            ),
        )
    )
    found = found.withColumn(numbered, F.sort_array(F.concat(firsts, later)))
    # The top bits of the hash are the slot: each slot is a stretch of the sorted array and begins with its smallest.
    found = found.withColumn(
        chosen, F.filter(F.col(numbered), lambda x, i: differs(F.col(numbered), x, i, minimal, slot_bits))
    )
    found = found.withColumn(order, group_starts(F.col(chosen), slot_bits))

    def tuple_hash(start: Column, g: Column) -> Column:
        size = F.coalesce(F.get(F.col(order), g + 1), F.size(chosen)) - start
        in_text = F.sort_array(
            F.transform(
                F.slice(F.col(chosen), start + 1, size),
                lambda x: F.struct(position(x).alias("at"), F.shiftright(x, POSITION_BITS).alias("hash")),
            )
        )
        return F.struct(
            F.shiftright(F.get(F.col(chosen), start), slot_bits).cast("int").alias("slot"),
            F.pmod(F.xxhash64(F.transform(in_text, lambda c: c["hash"])), F.lit(1 << 31)).cast("int").alias("hash"),
        )

    by_slot = F.map_from_entries(F.transform(F.col(order), tuple_hash))
    every = F.sequence(F.lit(-(slots // 2)), F.lit(slots // 2 - 1))
    # The map is bound as a lambda's variable, so that it is made once and not again for every slot.
    signature = F.transform(
        F.array(by_slot), lambda taken: F.transform(every, lambda s: F.coalesce(F.element_at(taken, s), F.lit(EMPTY)))
    )
    return found.withColumn(name, F.get(signature, F.lit(0))).drop(words, kmers, repeats, starts, numbered, chosen, order)


def likeness(left: Column, right: Column) -> Column:
    """The share of equal slots among those that are taken in either; equal fingerprints are alike by 1."""
    both = F.arrays_zip(left.alias("a"), right.alias("b"))
    taken = F.size(F.filter(both, lambda x: (x["a"] != EMPTY) | (x["b"] != EMPTY)))
    same = F.size(F.filter(both, lambda x: (x["a"] == x["b"]) & (x["a"] != EMPTY)))
    return F.when(left == right, F.lit(1.0)).otherwise(same / taken)


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.when(x == EMPTY, F.lit("-")).otherwise(F.lower(F.hex(x)))), ".")


QUANTILES = 256


def with_next(docs: DataFrame, doc_id: str, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<column>`` of the next row by descending ``doc_id``; after the last row comes the first.

    Rows are cut into stretches of the id: between quantiles of all ids, and evenly inside them. Each stretch is sorted by
    itself, so the texts are shuffled once; only the first row of each stretch is carried over to the stretch before it.
    Rows that share an id are ordered by a hash of the columns; a null id comes last. A single row follows itself.
    """
    spark = docs.sparkSession
    each = -(-4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // QUANTILES)
    cuts = F.percentile_approx(F.col(doc_id), [i / QUANTILES for i in range(QUANTILES + 1)], 20 * QUANTILES)
    bounds = sorted(set(docs.agg(cuts).head()[0] or []))  # at most QUANTILES + 1 numbers
    part = stretch(F.col(doc_id), bounds, each)
    order = [F.desc_nulls_last(doc_id), F.xxhash64(*columns), *columns]
    window = Window.partitionBy("__part").orderBy(*order)
    ranked = docs.withColumn("__part", part).withColumns(
        {"__first": F.lag(F.lit(False), 1, True).over(window), "__last": F.lead(F.lit(False), 1, True).over(window)}
        | {f"next_{c}": F.lead(c).over(window) for c in columns}
    )
    heads = ranked.where("__first").select("__part", *[F.col(c).alias(f"__head_{c}") for c in columns])
    # One row for each stretch, so a single task sorts a few numbers only.
    down = Window.orderBy(F.desc("__part"))
    follows = heads.select("__part").select(
        F.col("__part").alias("__of"),
        F.coalesce(F.lead("__part").over(down), F.first("__part").over(down)).alias("__part"),
    )
    carried = follows.join(heads, "__part").drop("__part")
    return ranked.join(carried, (F.col("__part") == F.col("__of")) & F.col("__last"), "left").select(
        *docs.columns,
        *[F.when(F.col("__last"), F.col(f"__head_{c}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}") for c in columns],
    )


def stretch(value: Column, bounds: list[int], each: int) -> Column:
    """The number of the stretch of a value, ascending: found by halving the bounds, then evenly between two of them. Null is -1."""

    def within(low: int, high: int) -> Column:
        if high - low <= 1:
            width = max(bounds[high] - bounds[low], 1) if high < len(bounds) else 1
            inner = F.floor((value - F.lit(bounds[low])) / F.lit(width) * each)
            return (F.lit(low * each) + F.least(F.greatest(inner, F.lit(0)), F.lit(each - 1))).cast("int")
        middle = (low + high) // 2
        return F.when(value < bounds[middle], within(low, middle)).otherwise(within(middle, high))

    if not bounds:
        return F.lit(-1)
    return F.when(value.isNull(), F.lit(-1)).otherwise(within(0, len(bounds)))
