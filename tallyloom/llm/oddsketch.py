"""Near-duplicates by MinHash, with odd sketches to judge candidates.

``SAMPLES`` MinHash values of each set, every one paired with its number, are folded into a bitmap of ``BITS`` parities, an odd
sketch (Mitzenmacher, Pagh and Pham, 2014). Two sketches differ in the more bits, the fewer samples agree, so that the number of
ones in their exclusive or estimates the similarity, and best where it is high. Documents meet in bands of ``ROWS`` samples each.

Equal sets are one document from the start. Each document of a band's bucket is held against the least of it, candidates whose
sketches are too far apart are dropped, and the others are confirmed on their whole sets. Whatever shares a bucket and is still
apart after that is compared within its bucket, with no row for a pair (``groups``).

At a similarity of exactly the threshold of 85 %, two documents miss each other in all bands with a chance of 7e-9, and a sketch
drops them with a chance below 1e-9; both fall fast above it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.groups import missing_links, parity, seal
from tallyloom.llm.jaccard import shingle_sets, verified
from tallyloom.llm.storage import connected, stored
from tallyloom.llm.textbytes import BASE, U64, by_size, mix

SAMPLES, BANDS, ROWS = 256, 32, 5
BITS = 1024
SIGMAS = 6
PIECE = 1 << 15
SKETCH_KIND = "doc long, size int, a long, b long, bands binary, sketch binary, parity binary"
SEEDS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * U64(BASE))
ODD = mix(SEEDS) | U64(1)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """``SAMPLES`` least values of each set, each under an order of its own: an odd multiple of the hash after an exclusive or.

    All sets go by together, in pieces that stay in a core's cache.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    least = np.full((len(sets), SAMPLES), ~U64(0))
    filled = np.flatnonzero(sizes)
    ends = np.cumsum(sizes)[filled]
    starts = ends - sizes[filled]
    whole = np.concatenate([*sets, np.zeros(0, np.uint64)])
    for at in range(0, len(whole), PIECE):
        part = whole[at : at + PIECE]
        first, last = np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + len(part), "left")
        cuts, own = np.maximum(starts[first:last] - at, 0), filled[first:last]
        found, buffer = np.empty((len(own), SAMPLES), np.uint64), np.empty_like(part)
        for i in range(SAMPLES):
            np.bitwise_xor(part, SEEDS[i], out=buffer)
            np.multiply(buffer, ODD[i], out=buffer)
            found[:, i] = np.minimum.reduceat(buffer, cuts)
        least[own] = np.minimum(least[own], found)
    return least


def odd_sketches(least: np.ndarray) -> list[bytes]:
    spots = mix(least + np.arange(SAMPLES, dtype=np.uint64) * U64(BASE)) & U64(BITS - 1)
    spots = spots.astype(np.int64) + np.arange(len(least))[:, None] * BITS
    flips = np.bincount(spots.ravel(), minlength=len(least) * BITS).reshape(-1, BITS) & 1
    return [row.tobytes() for row in np.packbits(flips.astype(np.uint8), axis=1, bitorder="little")]


def band_keys(least: np.ndarray) -> list[bytes]:
    samples = least[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(least), axis=0)
    for i in range(ROWS):
        keys = mix(keys ^ samples[:, :, i]) * U64(BASE)
    return [row.tobytes() for row in keys]


def estimate(ones: np.ndarray) -> np.ndarray:
    """The similarity that so many differing bits of two sketches speak for."""
    kept = np.maximum(1 - 2 * np.asarray(ones) / BITS, 1e-9)
    return 1 + BITS / (4 * SAMPLES) * np.log(kept)


def most_ones(percent: int) -> int:
    """The most bits in which the sketches of two similar enough sets differ, ``SIGMAS`` deviations of both samples and bits allowed."""
    apart = SAMPLES * (1 - percent / 100)
    ones = lambda m: BITS / 2 * (1 - math.exp(-4 * m / BITS))
    high = apart + SIGMAS * math.sqrt(apart * percent / 100)
    thrown = 2 * high
    return math.ceil(ones(high) + SIGMAS * math.sqrt(2 * thrown * thrown / BITS))


def sketched(docs: DataFrame, n: int) -> DataFrame:
    """One pass over ``docs`` (``doc``, ``text``): of each row its set's size, seal, band keys, odd sketch and parity bitmap."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", 1 << 20):
            sets = shingle_sets(batch.column(1), n)
            least = minhashes(sets)
            seals = [seal(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([s[0] for s in seals], pa.int64()),
                    pa.array([s[1] for s in seals], pa.int64()),
                    pa.array(band_keys(least), pa.binary()),
                    pa.array(odd_sketches(least), pa.binary()),
                    pa.array([parity(s) for s in sets], pa.binary()),
                ],
                ["doc", "size", "a", "b", "bands", "sketch", "parity"],
            )

    return docs.mapInArrow(look, SKETCH_KIND)


def buckets(nodes: DataFrame) -> DataFrame:
    """``bucket``, ``doc``, ``size``: a row for each band of each document."""
    places = F.sequence(F.lit(0), F.lit(BANDS - 1))
    key = F.substring(F.col("bands"), F.col("band") * 8 + 1, F.lit(8))
    return nodes.withColumn("band", F.explode(places)).select(F.xxhash64("band", key).alias("bucket"), "doc", "size")


def close_sketches(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches are no further apart than those of similar sets."""
    limit = most_ones(percent)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, BITS // 64) for i in (2, 3))
                ones = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                yield batch.select(["x", "y"]).filter(pa.array(ones <= limit))

    x = nodes.select(F.col("doc").alias("x"), F.col("sketch").alias("sx"), F.col("size").alias("nx"))
    y = nodes.select(F.col("doc").alias("y"), F.col("sketch").alias("sy"), F.col("size").alias("ny"))
    sized = (100 * F.col("nx") >= percent * F.col("ny")) & (100 * F.col("ny") >= percent * F.col("nx"))
    both = pairs.join(x, "x").join(y, "y").where(sized).select("x", "y", "sx", "sy")
    return both.mapInArrow(judge, "x long, y long").distinct()


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 85, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` (the id is its component's) for each row.

    Documents are linked if 100 times the n-grams they share is at least ``percent`` times those that either has, confirmed on
    whole sets; a component is named by its smallest id. A-Z count as a-z, words are split at ASCII white space. A text with
    fewer than ``n`` words is one n-gram; a null or wordless one has none and is linked with nothing. Rows that share an id are
    one document as far as links go, each with its own ``n_shingles``, and all their texts count; a row with a null id is linked
    with nothing and has a null component and a null ``kept``.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    seen = stored(sketched(texts, n))
    linkable = seen.where("doc is not null and size > 0")
    classes = linkable.groupBy("size", "a", "b").agg(F.min("doc").alias("node"))
    named = stored(seen.select("doc", "size", "a", "b").where("doc is not null and size > 0").join(classes, ["size", "a", "b"]).select("doc", "size", "node").distinct())
    nodes = stored(
        linkable.join(classes.withColumnRenamed("node", "doc"), ["size", "a", "b", "doc"], "left_semi").dropDuplicates(["doc", "size", "a", "b"])
    )
    # An id with several texts holds their classes together.
    several = named.groupBy("doc").agg(F.min("node").alias("x"), F.max("node").alias("most")).where("x < most").select("doc", "x")
    held = named.join(several, "doc").select("x", F.col("node").alias("y")).where("x <> y")

    members = stored(buckets(nodes))
    least = members.groupBy("bucket").agg(F.min(F.struct("size", "doc")).alias("least"), F.count("doc").alias("n")).where("n > 1")
    shared = stored(members.join(least.select("bucket", F.col("least.doc").alias("pivot")), "bucket").select("bucket", "doc", "pivot"))
    pairs = shared.where("doc <> pivot").select(F.col("doc").alias("x"), F.col("pivot").alias("y")).distinct()
    owners = texts.join(nodes.select("doc").distinct(), "doc", "left_semi")
    links = stored(verified(close_sketches(pairs, nodes, percent), owners, n, percent).union(held).distinct())
    found = connected(links)

    placed = shared.join(found, F.col("doc") == F.col("node"), "left").select("bucket", "doc", F.coalesce("component", "doc").alias("comp"))
    more = missing_links(placed, nodes.select("doc", "size", "parity"), owners, lambda t: shingle_sets(t, n), percent)
    final = connected(links.union(more))
    own = named.groupBy("doc").agg(F.min("node").alias("own"))
    component = own.join(final, F.col("own") == F.col("node"), "left").select(
        F.col("doc").alias("of"), F.coalesce("component", "own").alias("component")
    )
    joined = seen.select("doc", "size").join(component, F.col("doc") == F.col("of"), "left")
    result = F.coalesce("component", "doc")
    return joined.select(
        F.col("doc").alias(doc_id), F.col("size").cast("long").alias("n_shingles"), result.alias("component_id"), (F.col("doc") == result).alias("kept")
    )
