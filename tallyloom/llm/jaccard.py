"""Near-duplicates by an n-gram Jaccard join with prefix filtering.

Each document's distinct word n-grams are put into one global order, rare ones first, and only the first quarter or so
(the prefix, whose length follows from the similarity) is joined on: two documents that are similar enough share an n-gram of
their prefixes. Rarity comes from a table of counts over all documents, hashed to a fixed number of slots; any order gives
the same result, so it only needs to tell frequent n-grams from rare ones.

A pair that shares a prefix n-gram is a candidate if the lengths allow it (length filter), if enough n-grams are left
behind the shared one (positional filter), and if the numbers of n-grams in ranges of the hash allow it (suffix filter).
Candidates are made distinct and verified once, on the whole texts.

No group is expanded into all pairs. First, each document is held against the smallest of those that share an n-gram with
it, and linked documents are joined into components. A frequent n-gram's group is dealt over salts with a smallest document each,
and those are held against the smallest of all. Members of a group that still belong to different components after that are
compared in memory, block by block, so that there is no row for a pair of them (``groups``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.contamination import LOWER, run_hashes
from tallyloom.llm.groups import HASHED_BYTES, missing_links, parity, similar
from tallyloom.llm.storage import connected, stored
from tallyloom.llm.textbytes import byte_hashes, by_size, mix, text_bytes

SLOT_BITS = 22
SLICES = 64
RANGES = 16
HOT_DOCS, HOT_MEANS = 500, 8
SALTS = 32
# The white space between words.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's runs of ``n`` words; fewer words are one run, none are none."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    if not len(start):
        return [np.zeros(0, np.uint64)] * len(texts)
    words = mix(byte_hashes(data).run(start, end))
    runs = run_hashes(words, np.arange(max(len(words) - n + 1, 0)), n)
    bounds = np.searchsorted(start, offsets)
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= n:
            sets.append(np.unique(runs[a : b - n + 1]))
        else:
            sets.append(run_hashes(words[a:b], np.zeros(1, np.int64), b - a) if b > a else np.zeros(0, np.uint64))
    return sets


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def packed(counts: np.ndarray) -> bytes:
    """Numbers that are mostly small, as compressed bytes: the first tells how wide they are."""
    kind = next(k for k in (1, 2, 4, 8) if k == 8 or counts.max(initial=0) < 1 << (8 * k))
    return bytes([kind]) + zlib.compress(counts.astype(f"<u{kind}").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), f"<u{data[0]}").astype(np.uint64)


def survey(docs: DataFrame, n: int) -> DataFrame:
    """One pass: a row with ``size``, ``ranges`` and ``parity`` for each document, and the task's counts by slice of the slots."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in by_size(batches, "text", HASHED_BYTES):
            sets = shingle_sets(batch.column(1), n)
            whole = np.concatenate(sets)
            np.add.at(counts, slot(whole), np.uint32(1))
            ranges = [np.bincount((s >> np.uint64(40)).astype(np.int64) % RANGES, minlength=RANGES) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(ranges, pa.list_(pa.int32())),
                    pa.array([parity(s) for s in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int32()),
                    pa.nulls(len(sets), pa.binary()),
                ],
                ["doc", "size", "ranges", "parity", "slice", "counts"],
            )
        if counts.any():
            parts = [packed(c) for c in counts.reshape(SLICES, -1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(SLICES, pa.int64()),
                    pa.nulls(SLICES, pa.int32()),
                    pa.nulls(SLICES, pa.list_(pa.int32())),
                    pa.nulls(SLICES, pa.binary()),
                    pa.array(range(SLICES), pa.int32()),
                    pa.array(parts, pa.binary()),
                ],
                ["doc", "size", "ranges", "parity", "slice", "counts"],
            )

    return docs.mapInArrow(look, "doc long, size int, ranges array<int>, parity binary, slice int, counts binary")


def slot_counts(surveyed: DataFrame) -> np.ndarray:
    """The counts of all slots over all documents: a table of fixed size, summed slice by slice."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of what a task has read of each slice; one row a slice goes on.
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[i] = sums.get(i, 0) + unpacked(part.as_py())
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums.keys(), pa.int32()), pa.array([packed(s) for s in sums.values()], pa.binary())], ["slice", "counts"]
        )

    parts = surveyed.where("slice is not null").select("slice", "counts").repartition(SLICES, "slice")
    table = np.zeros((SLICES, (1 << SLOT_BITS) // SLICES), np.uint64)
    for row in parts.mapInArrow(add, "slice int, counts binary").collect():  # 2^SLOT_BITS numbers, whatever the input
        table[row["slice"]] += unpacked(bytes(row["counts"]))
    return table.reshape(-1)


def prefix_rows(docs: DataFrame, n: int, percent: int, counts: np.ndarray) -> DataFrame:
    """``gram``, ``doc``, ``place`` of every n-gram in a document's prefix; ``salt`` is over 0 for some of a frequent one's rows.

    ``place`` holds the size of the document's set in its upper and the n-gram's position in its lower 32 bits.
    """
    mean = max(float(counts.mean()), 1e-9)
    rarity = np.minimum(counts * (16 / max(mean, 1.0)), 255).astype(np.uint8)
    hot = np.packbits(counts > max(HOT_DOCS, HOT_MEANS * mean))
    shared = docs.sparkSession.sparkContext.broadcast((rarity, hot))  # 9 bits for each of 2^SLOT_BITS slots

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, packed = shared.value
        frequent = np.unpackbits(packed).astype(bool)
        for batch in by_size(batches, "text", HASHED_BYTES):
            grams, docs_, places, salts = [], [], [], []
            for doc, found in zip(batch.column(0).to_numpy(), shingle_sets(batch.column(1), n), strict=True):
                size = len(found)
                if not size:
                    continue
                length = size - -(-percent * size // 100) + 1
                slots = slot(found)
                order = np.lexsort((found, rank[slots]))[:length]
                grams.append(found[order])
                docs_.append(np.full(length, doc))
                places.append((np.int64(size) << np.int64(32)) | np.arange(length))
                salts.append(np.where(frequent[slots[order]], 1 + doc % SALTS, 0))
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(grams).view(np.int64)),
                        pa.array(np.concatenate(docs_)),
                        pa.array(np.concatenate(places)),
                        pa.array(np.concatenate(salts).astype(np.int16)),
                    ],
                    ["gram", "doc", "place", "salt"],
                )

    return docs.mapInArrow(emit, "gram long, doc long, place long, salt short")


def size_of(place: Column) -> Column:
    return F.shiftright(place, 32)


def could_match(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The suffix filter: n-grams that one document has more of in a range of the hash than the other can't be shared."""
    x = sizes.select(F.col("doc").alias("x"), F.col("ranges").alias("rx"), F.col("size").alias("sx"))
    y = sizes.select(F.col("doc").alias("y"), F.col("ranges").alias("ry"), F.col("size").alias("sy"))
    apart = F.aggregate(F.zip_with("rx", "ry", lambda a, b: F.abs(a - b)), F.lit(0), lambda total, d: total + d)
    most = F.floor((F.col("sx") + F.col("sy") - apart) / 2)
    return pairs.join(x, "x").join(y, "y").where((100 + percent) * most >= percent * (F.col("sx") + F.col("sy"))).select("x", "y")


def verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, judged on the whole texts; each pair comes with both texts, never a group.

    Where an id has several texts, each of them counts.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(iter([whole]), "text_x", HASHED_BYTES):
                distinct = batch.column(3).fill_null("").dictionary_encode()  # many pairs have the same y
                own, others = shingle_sets(batch.column(2), n), shingle_sets(distinct.dictionary, n)
                keep = [similar(s, others[at], percent) for s, at in zip(own, distinct.indices.to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["x", "y"]).filter(pa.array(keep, pa.bool_()))

    texts_x = docs.select(F.col("doc").alias("x"), F.col("text").alias("text_x"))
    texts_y = docs.select(F.col("doc").alias("y"), F.col("text").alias("text_y"))
    both = pairs.join(texts_x, "x").join(texts_y, "y").select("x", "y", "text_x", "text_y")
    return both.mapInArrow(judge, "x long, y long")


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for each row: the smallest id that similar documents lead to, its own included.

    Two documents are linked if 100 times the n-grams they share is at least ``percent`` times those that either has. A-Z
    count as a-z, words are split at ASCII white space. A text with fewer than ``n`` words is one n-gram; a null or wordless
    one has none and is linked with nothing. N-grams are compared by 64-bit hash. Rows that share an id are one document as
    far as links go, each with its own ``n_shingles``, and all their texts count; a row with a null id is linked with nothing and
    has a null component.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    surveyed = stored(survey(rows, n))
    sizes = surveyed.where("slice is null").select("doc", "size", "ranges", "parity")
    named = rows.where("doc is not null")
    table = prefix_rows(named, n, percent, slot_counts(surveyed))
    # The same order in every group, so that the n-grams of a document mostly have one and the same smallest partner.
    smallest = [size_of(F.col("place")), F.col("doc")]
    group = Window.partitionBy("gram", "salt").orderBy(*smallest)
    shared = stored(
        table.withColumns(
            {
                "pivot": F.first("doc").over(group),
                "pivot_place": F.first("place").over(group),
                "alone": F.lag("doc").over(group).isNull() & F.lead("doc").over(group).isNull(),
            }
        )
        .where("salt > 0 or not alone")
        .drop("alone")
    )
    top = Window.partitionBy("gram").orderBy(*smallest)
    heads = (
        shared.where("salt > 0 and doc = pivot")
        .withColumns({"pivot": F.first("doc").over(top), "pivot_place": F.first("place").over(top)})
    )
    long_enough = 100 * size_of(F.col("pivot_place")) >= percent * size_of(F.col("place"))
    to_pivot = (
        shared.unionByName(heads).where((F.col("doc") != F.col("pivot")) & long_enough)
        .select(F.col("doc").alias("x"), F.col("pivot").alias("y")).distinct()
    )
    distinct_sizes = sizes.where("doc is not null").select("doc", "size", "ranges").distinct()
    links = stored(verified(could_match(to_pivot, distinct_sizes, percent).distinct(), named, n, percent).distinct())
    found = connected(links)

    # What is left: documents that share an n-gram and still belong to different components.
    placed = shared.join(found, shared["doc"] == found["node"], "left").select(
        F.col("gram").alias("bucket"), "doc", F.coalesce("component", "doc").alias("comp")
    )
    info = sizes.where("doc is not null").select("doc", "size", "parity").distinct()
    more = missing_links(placed, info, named, lambda t: shingle_sets(t, n), percent)
    final = connected(links.union(more))
    return sizes.join(final, sizes["doc"] == final["node"], "left").select(
        F.col("doc").alias(doc_id), F.col("size").cast("long").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is that of their component, unchanged. Rows without an id stay; of rows that share the
    id that stays, all stay."""
    gone = (
        near_duplicates(docs, doc_id=doc_id, **options)
        .where(F.col("component_id") != F.col(doc_id))
        .select(F.col(doc_id).alias("__gone"))
        .distinct()
    )
    return docs.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")
