"""Mixing sources to target weights: every document is repeated a Poisson number of times.

The mean of a source is its target share of all text divided by the share that it has, times ``epochs``. The number is the
inverse of the Poisson distribution at a uniform number that a hash of seed and document gives, so it depends neither on
partitioning nor on the run. Copies are exploded and put in a global order by a second hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored

HEX_DIGITS = 13  # 52 bits, which a double holds
FULL = float(16**HEX_DIGITS)
# Up to so many rows of a source's name and rate are broadcast.
FEW_SOURCES = 10_000
SALTS = 64


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1), the same in every engine that has MD5: the middle of one of 2^52 equal steps."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    digits = F.substring(F.md5(text), 1, HEX_DIGITS)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + F.lit(0.5)) / F.lit(FULL)


def poisson_steps(rate: Column) -> Column:
    """The distribution function of Poisson(rate) at 0, 1, 2, ..., as far as a 52-bit number can tell it from 1.

    The last term lies ten standard deviations and forty beyond the mean. Terms are summed from logarithms, so a large
    rate doesn't underflow before its mode.
    """
    last = F.ceil(rate + 10 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(
        F.lit(0.0).alias("log_term"), F.lit(0.0).alias("total"), F.array().cast("array<double>").alias("steps")
    )

    def step(state: Column, k: Column) -> Column:
        log_term = F.when(k == 0, -rate).otherwise(state["log_term"] + F.log(rate) - F.log(k.cast("double")))
        total = state["total"] + F.exp(log_term)
        return F.struct(log_term.alias("log_term"), total.alias("total"), F.concat(state["steps"], F.array(total)).alias("steps"))

    steps = F.aggregate(F.sequence(F.lit(0), last), start, step, lambda state: state["steps"])
    return F.when(rate > 0, steps).otherwise(F.array(F.lit(1.0)))


def source_rates(
    docs: DataFrame, weights: Mapping[str, float] | None, epochs: float, source: str, text: str, default_weight: float
) -> DataFrame:
    """``__source``, ``rate``: one row for each source, with the mean number of copies of its documents.

    Weights count by source name; a source without one has ``default_weight``. They are scaled to add up to 1 over the
    sources at hand, by size of text in characters.
    """
    size = docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("__source")).agg(
        F.sum(F.coalesce(F.length(text), F.lit(0))).cast("double").alias("size")
    )
    given = F.lit(float(default_weight))
    for name, value in (weights or {}).items():
        given = F.when(F.col("__source") == name, F.lit(float(value))).otherwise(given)
    size = size.where("size > 0").withColumn("weight", given)
    # Sums of exact numbers, so that the order of addition doesn't show in the last digit.
    all_size = size.agg(F.sum(F.col("size").cast("decimal(38,0)")).cast("double")).scalar()
    all_weight = size.agg(F.sum(F.col("weight").cast("decimal(28,12)")).cast("double")).scalar()
    return size.select(
        "__source", (F.lit(float(epochs)) * F.col("weight") / all_weight * all_size / F.col("size")).alias("rate")
    )


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    epochs: float = 1.0,
    seed: int = 0,
    default_weight: float = 1.0,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``docs`` repeated to the target weights, with ``rate``, ``n_copies``, ``copy`` (from 0) and ``shuffle_key``, in global order.

    A document of a source with rate r appears Poisson(r) times, so also not at all; the expected size of each source is its
    weight's share of ``epochs`` times all text. A null source is a source of its own, named ``''`` with the empty one;
    a null ``doc_id`` draws as an empty one. Rows that share a ``doc_id`` draw the same number. A source without any text has
    nothing to reach its share with and is left out; weights of 0 leave their sources out. The names that are added replace
    columns of the same names.
    """
    added = ("rate", "n_copies", "copy", "shuffle_key")
    names = [c for c in docs.columns if c not in added]
    rates = stored(source_rates(docs, weights, epochs, source, text, default_weight))
    keyed = docs.select(names).withColumn("__source", F.coalesce(F.col(source).cast("string"), F.lit("")))
    if rates.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES:
        joined = keyed.join(F.broadcast(rates), "__source")
    else:  # too many to send to every task: a source is dealt over salts, so that a large one isn't one task
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = keyed.withColumn("__salt", F.pmod(F.xxhash64(doc_id), F.lit(SALTS)).cast("int"))
        joined = salted.join(rates.withColumn("__salt", salts), ["__source", "__salt"]).drop("__salt")
    drawn = joined.withColumn("__steps", poisson_steps(F.col("rate"))).withColumn("__u", uniform(seed, F.col(doc_id)))
    copies = drawn.withColumn("n_copies", F.size(F.filter("__steps", lambda step: step <= F.col("__u"))).cast("long"))
    return (
        copies.where("n_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_copies") - 1)))
        .withColumn("shuffle_key", uniform(seed + 1, F.col(doc_id), F.col("copy")))
        .select(*names, *added)
        .orderBy("shuffle_key", doc_id, "copy")
    )
