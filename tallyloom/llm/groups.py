"""Which sets of a group are similar, exactly, without a row for each pair of them.

Similarity joins put documents into groups (of an n-gram, of a band) such that similar ones meet in some group. A group's pairs
grow with the square of its size, so they are never rows: a group is dealt to blocks, each pair of blocks is a cell, and a task
compares the members of a cell in memory. It does so twice. First with parity bitmaps of the sets, of which only members with a
close partner pass; then with the sets of those, of which only links that join two components pass. Both times there are at most
as many rows as members of cells. Near copies meet in many groups, so a pair counts in the first that it shares alone.

A parity bitmap has the bit of a hash flipped once for each element, so two bitmaps differ in at most as many bits as their sets
do in elements: what the comparison of bitmaps rejects can't be similar enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored
from tallyloom.llm.textbytes import BASE, U64, by_size, mix

BLOCK_ROWS, BLOCK_BYTES = 2048, 8 << 20
TILE_WORDS = 1 << 21
# Texts hashed at a time: their prefix hashes take some 40 times as much memory.
HASHED_BYTES = 1 << 20
STEP = 1024
MOST_BITS = 1 << 20
Sets = Callable[[pa.Array], list[np.ndarray]]


def parity(hashes: np.ndarray) -> bytes:
    """The parity bitmap of a set of hashes: a power of two of bits, at least two an element (up to ``MOST_BITS``)."""
    bits = min(max(64, 1 << max(2 * len(hashes) - 1, 1).bit_length()), MOST_BITS)
    flips = np.bincount((hashes & U64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()


def seal(hashes: np.ndarray) -> tuple[int, int]:
    """Two numbers that only equal sets share, but for chance."""
    if not len(hashes):
        return 0, 0
    both = np.array([hashes.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(hashes + U64(BASE)))], np.uint64).view(np.int64)
    return int(both[0]), int(both[1])


def most_apart(total: np.ndarray, percent: int) -> np.ndarray:
    """How many elements two similar sets of that many together can differ in."""
    return (100 - percent) * total // (100 + percent)


def by_width(bitmaps: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and rows of the bitmaps of each width, in words."""
    widths = np.array([len(b) // 8 for b in bitmaps], np.int64)
    found = {}
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        found[int(w)] = at, np.frombuffer(b"".join(bitmaps[i] for i in at), np.uint64).reshape(-1, w)
    return found


def folded(rows: np.ndarray, width: int) -> np.ndarray:
    while rows.shape[1] > width:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def met_before(a: pa.Table, b: pa.Table) -> np.ndarray:
    """Which members of two blocks share a bucket before this one, by their lists of buckets."""
    found = np.zeros((a.num_rows, b.num_rows), bool)
    if "others" not in a.column_names:
        return found
    flat = []
    for block in (a, b):
        lists = block["others"].combine_chunks()
        owner = np.repeat(np.arange(block.num_rows), lists.value_lengths().to_numpy())
        earlier = (values := lists.flatten().to_numpy()) < block["bucket"].to_numpy()[owner]
        flat.append((owner[earlier], values[earlier]))
    names = np.intersect1d(flat[0][1], flat[1][1])
    for at in range(0, len(names), STEP):
        part, marks = names[at : at + STEP], []
        for block, (owner, values) in zip((a, b), flat, strict=True):
            place = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[place] == values
            marks.append(np.zeros((block.num_rows, len(part)), np.float32))
            marks[-1][owner[hit], place[hit]] = 1
        found |= (marks[0] @ marks[1].T) > 0
    return found


def close_pairs(
    left: list[bytes],
    right: list[bytes],
    sizes: tuple[np.ndarray, np.ndarray],
    comps: tuple[np.ndarray, np.ndarray],
    met: np.ndarray,
    percent: int,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of different components, not ``met`` before, that sizes and bitmaps don't rule out."""
    ours, theirs = by_width(left), by_width(right)
    for wa, (ia, a) in ours.items():
        for wb, (ib, b) in theirs.items():
            sa, sb = sizes[0][ia], sizes[1][ib]
            if 100 * min(sa.max(), sb.max()) < percent * max(sa.min(), sb.min()):
                continue
            width = min(wa, wb)
            x, y = folded(a, width), folded(b, width)
            step = max(1, TILE_WORDS // (len(y) * width))
            for at in range(0, len(x), step):
                part = slice(at, at + step)
                apart = np.bitwise_count(x[part, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64)
                allowed = most_apart(sa[part, None] + sb[None, :], percent)
                fits = (apart <= allowed) & (np.abs(sa[part, None] - sb[None, :]) <= allowed)
                fits &= (comps[0][ia][part, None] != comps[1][ib][None, :]) & ~met[np.ix_(ia[part], ib)]
                i, j = np.nonzero(fits)
                if len(i):
                    yield ia[part][i], ib[j]


def dealt(members: DataFrame, blocks: Column) -> DataFrame:
    """``members`` in every cell of their group's ``blocks``, sorted by ``cell``; ``side`` is 2 in a cell of one block with itself."""
    own = F.pmod(F.xxhash64("doc", F.lit(7)), blocks.cast("long"))
    spread = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))
    a, b = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(a == b, 2).when(F.col("own") == a, 0).otherwise(1).cast("byte")
    cells = spread.select(F.xxhash64("bucket", a, b).alias("cell"), side.alias("side"), *members.columns)
    return cells.repartition("cell").sortWithinPartitions("cell")


def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell, which follow each other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        cell = batch.column(0).to_numpy()
        if not len(cell):
            continue
        bounds = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1), len(cell)]
        for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
            if held and cell[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = cell[start]
    if held:
        yield pa.Table.from_batches(held)


def sides(cell: pa.Table) -> Iterator[tuple[pa.Table, pa.Table]]:
    """The two blocks of a cell; twice the same if it is of one block with itself."""
    side = cell["side"].to_numpy()
    whole, left, right = (cell.filter(pa.array(side == s)) for s in (2, 0, 1))
    if whole.num_rows > 1:
        yield whole, whole
    if left.num_rows and right.num_rows:
        yield left, right


def columns_of(a: pa.Table, b: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    return a[name].to_numpy(), b[name].to_numpy()


def with_close_partner(members: DataFrame, percent: int) -> DataFrame:
    """The members (``bucket``, ``doc``, ``comp``) that some member of another component may be similar to."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in by_cell(batches):
            for a, b in sides(cell):
                hit_a, hit_b = np.zeros(a.num_rows, bool), np.zeros(b.num_rows, bool)
                maps = a["parity"].to_pylist(), b["parity"].to_pylist()
                for i, j in close_pairs(*maps, columns_of(a, b, "size"), columns_of(a, b, "comp"), met_before(a, b), percent):
                    hit_a[i] = hit_b[j] = True
                for block, hit in ((a, hit_a), (b, hit_b)) if b is not a else ((a, hit_a | hit_b),):
                    if hit.any():
                        yield from block.select(["bucket", "doc", "comp"]).filter(pa.array(hit)).combine_chunks().to_batches()

    blocks = F.ceil(F.col("n") / BLOCK_ROWS)
    return dealt(members, blocks).mapInArrow(look, "bucket long, doc long, comp long")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def links_of(members: DataFrame, percent: int) -> DataFrame:
    """Links (``x``, ``y``) of similar members with whole sets, as many as it takes to join components."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in by_cell(batches):
            links: list[tuple[int, int]] = []
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while parent.setdefault(c, c) != c:
                    c = parent[c] = parent[parent[c]]
                return c

            for a, b in sides(cell):
                sets = [[np.frombuffer(s, np.uint64) for s in t["set"].to_pylist()] for t in (a, b)]
                maps = [[parity(s) for s in own] for own in sets]
                size = tuple(np.array([len(s) for s in own], np.int64) for own in sets)
                docs, comps = columns_of(a, b, "doc"), columns_of(a, b, "comp")
                for i, j in close_pairs(*maps, size, comps, met_before(a, b), percent):
                    for p, q in zip(i.tolist(), j.tolist(), strict=True):
                        if a is b and q < p:
                            continue
                        u, v = root(int(comps[0][p])), root(int(comps[1][q]))
                        if u != v and similar(sets[0][p], sets[1][q], percent):
                            parent[u] = v
                            links.append((int(docs[0][p]), int(docs[1][q])))
            if links:
                x, y = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    return members.mapInArrow(judge, "x long, y long")


def one_of_each_group(members: DataFrame) -> DataFrame:
    """``members`` of buckets that hold more than one component, with their number ``n``; of buckets with the very same members
    one, as near copies meet in many."""
    who = F.shiftright(F.xxhash64("doc"), 32)
    groups = members.groupBy("bucket").agg(
        F.min("comp").alias("least"),
        F.max("comp").alias("most"),
        F.count("doc").alias("n"),
        F.sum(who).alias("total"),
        F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("mixed"),
    )
    one = groups.where("least < most").groupBy("n", "total", "mixed").agg(F.min("bucket").alias("bucket"))
    return members.join(one.select("bucket", "n"), "bucket")


def missing_links(members: DataFrame, info: DataFrame, docs: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """Links that join the components of ``members`` (``bucket``, ``doc``, ``comp``) wherever two similar sets share a bucket.

    ``info`` has ``doc``, ``size`` and ``parity`` of each set, ``docs`` the texts (``doc``, ``text``) that ``sets`` makes sets of. An id may
    have several sets; each of them counts.
    """
    mixed = one_of_each_group(members)
    with_maps = mixed.join(info.select("doc", F.col("size").cast("long").alias("size"), "parity"), "doc")
    close = stored(with_close_partner(with_maps.select("bucket", "doc", "comp", "size", "parity", "n"), percent).distinct())
    some = stored(one_of_each_group(close))
    # A document's buckets are at most as many as it has n-grams or bands.
    lists = some.groupBy("doc").agg(F.sort_array(F.collect_set("bucket")).alias("others"))
    maps = info.select("doc", F.col("size").cast("long").alias("size"), "parity")
    listed = some.join(lists, "doc").join(maps, "doc").select("bucket", "doc", "comp", "size", "parity", "others", "n")
    near = stored(with_close_partner(listed, percent).distinct().join(lists, "doc").select("bucket", "doc", "comp", "others"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", HASHED_BYTES):
            found = [s.tobytes() for s in sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc", "set"])

    asked = docs.join(near.select("doc").distinct(), "doc", "left_semi").select("doc", "text")
    held = stored(asked.mapInArrow(whole, "doc long, set binary"))
    heavy = near.join(held.groupBy("doc").agg(F.sum(F.length("set")).alias("bytes")), "doc").groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    full = near.join(heavy, "bucket").join(held, "doc").select("bucket", "doc", "comp", "others", "set", "bytes")
    blocks = F.ceil(F.greatest(F.col("bytes"), F.lit(1)) / BLOCK_BYTES)
    return stored(links_of(dealt(full, blocks).drop("bytes"), percent).distinct())
