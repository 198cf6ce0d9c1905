"""The prefix trie of all conversations, built as a z-fast trie in batches.

A conversation is a path of turns. The state of the path after d turns is a 128-bit hash, so that equal prefixes are equal
hashes wherever they are. Only compacted nodes (ends of conversations and branches) are rows of the node table; each is found
by its handle, the hash of its path at the two-fattest depth of the edge above it (Belazzougui, Boldi, Pagh and Vigna, 2009).
Fat binary search finds a conversation's exit node in a logarithm of its turns many joins of hashes.

Conversations are inserted in batches, each a fixed multiple of the one before: the exit nodes of a batch are located in the
trie so far, edges are cut where conversations leave them, and the rests are sorted below their exit points, a task streaming
over them with the open path as its only state. The earlier batches are a random sample of the rest, so a first turn that a
third of all conversations share is dealt over as many exit points as the sample has found below it.

Long conversations are cut into segments of ``SEGMENT`` turns whose starts are nodes as well, so that no row grows with a
conversation. Sums over subtrees go up by pointer doubling, and every edge is expanded to a row for each of its depths at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored
from tallyloom.llm.textbytes import BASE, U64, mix

SEGMENT = 512
FIRST_BATCH, GROWTH = 4096, 64
PIECE = 1 << 16
WIDTH = 16
ROOT = bytes(WIDTH)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
SEGMENT_KIND = "conv long, seg long, last boolean, start long, n long, path binary, weights array<long>"
NODE_COLUMNS = ["id", "depth", "up", "above", "path", "weights"]


def turn_keys(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``key`` (16 bytes that stand for role and text), ``n_bytes`` of the text; null role or text is empty.

    Rows without a conversation id belong to no conversation and are left out.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    told = F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    return conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.substring(F.unhex(told), 1, WIDTH).alias("key"),
        F.octet_length(text_).cast("long").alias("n_bytes"),
    )


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` with ``place``, from 1 in the order of ``turn`` (null first), equal turn numbers by their keys.

    All turns are sorted in ranges; a conversation that spans several adds up what the ranges before hold of it.
    """
    order = [F.asc_nulls_first("turn"), F.asc("key")]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = turns.withColumn("salt", F.monotonically_increasing_id())  # repeated rows may go to several ranges
    ranged = stored(
        salted.repartitionByRange(parts, F.col("conv"), *order, F.col("salt")).withColumn("part", F.spark_partition_id())
    )
    counts = ranged.groupBy("conv", "part").agg(F.count("conv").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = ranged.withColumn("own", F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order, "salt")))
    return own.join(carried, ["conv", "part"]).select("conv", (F.col("own") + F.col("before")).alias("place"), "key", "n_bytes")


def hash_at(path: str, base: Column, depth: Column) -> Column:
    """The hash at ``depth`` of a path whose first hash is that at ``base``."""
    return F.substring(F.col(path), ((depth - base) * WIDTH + 1).cast("int"), F.lit(WIDTH))


def words_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8").reshape(-1, 2)


def segments(turns: DataFrame) -> DataFrame:
    """The conversations in segments of up to ``SEGMENT`` turns: hashes and bytes so far at each depth from ``start`` on.

    The hash after d turns is the exclusive or of one random number for each pair of a depth and a turn.
    """
    grouped = turns.groupBy("conv", F.floor((F.col("depth") - 1) / SEGMENT).cast("long").alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "key", "n_bytes"))).alias("turns")
    )

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, weights, hi, lo = [], [], [], []
            for row in batch.column(2):
                own = row.values
                depth = own.field("depth").to_numpy().astype(U64)
                key = words_of(b"".join(own.field("key").to_pylist()))
                each = np.stack([mix(key[:, i] ^ mix(depth * U64(BASE) + U64(i))) for i in (0, 1)], axis=1)
                path = np.bitwise_xor.accumulate(each, axis=0)
                paths.append(path.tobytes())
                weights.append(np.cumsum(own.field("n_bytes").to_numpy()))
                hi.append(path[-1, 0])
                lo.append(path[-1, 1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(paths, pa.binary()),
                    pa.array(weights, pa.list_(pa.int64())),
                    pa.array(np.array(hi, U64).view(np.int64)),
                    pa.array(np.array(lo, U64).view(np.int64)),
                ],
                ["conv", "seg", "path", "weights", "hi", "lo"],
            )

    rolled = grouped.mapInArrow(roll, "conv long, seg long, path binary, weights array<long>, hi long, lo long")
    whole = Window.partitionBy("conv").orderBy("seg")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    carried = rolled.withColumns(
        {
            "hi0": F.coalesce(F.bit_xor("hi").over(before), F.lit(0)),
            "lo0": F.coalesce(F.bit_xor("lo").over(before), F.lit(0)),
            "w0": F.coalesce(F.sum(F.element_at("weights", -1)).over(before), F.lit(0)),
            "last": F.lead("seg").over(whole).isNull(),
        }
    ).select("conv", "seg", "last", "path", "weights", "hi0", "lo0", "w0")

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                first = np.array([[r["hi0"], r["lo0"]]], np.int64).view(U64)
                path = np.concatenate([first, words_of(r["path"]) ^ first])
                out.append((path.tobytes(), [r["w0"], *(w + r["w0"] for w in r["weights"])]))
            seg = batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(seg * SEGMENT),
                    pa.array([len(p) // WIDTH - 1 for p, _ in out], pa.int64()),
                    pa.array([p for p, _ in out], pa.binary()),
                    pa.array([w for _, w in out], pa.list_(pa.int64())),
                ],
                ["conv", "seg", "last", "start", "n", "path", "weights"],
            )

    return stored(carried.mapInArrow(join_up, SEGMENT_KIND).withColumn("end", hash_at("path", F.lit(0), F.col("n"))))


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    zeros = f"(length(bin({low} ^ {high})) - 1)"
    return F.expr(f"shiftleft(shiftright({high}, {zeros}), {zeros})")


def locate(batch: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of ``batch`` that end at no node yet, with ``leaves_at``, the depth they share with the trie, and ``exit``, the
    node on whose edge that is (null: at a node).

    Fat binary search for the deepest node whose whole path is shared: the handle at the two-fattest depth of what is left of
    the interval either belongs to a node on the path, which moves the lower end, or the upper end comes below it. The edge
    below that node is found by its first hash, and compared with the rest of the path.
    """
    handles = nodes.select(
        hash_at("path", F.col("above") + 1, fattest("above", "depth")).alias("handle"),
        F.col("id").alias("node"),
        F.col("depth").alias("node_depth"),
        F.col("above").alias("node_above"),
    )
    start, stop = F.col("start"), F.col("start") + F.col("n")
    open_, found = batch.withColumns({"low": start, "high": stop}), None
    while True:
        probe = fattest("low", "high")
        whole = (F.col("node_depth") <= stop) & (hash_at("path", start, F.col("node_depth")) == F.col("node"))
        missed = F.col("node").isNull()
        step = open_.withColumns({"probe": probe, "probed": hash_at("path", start, probe)}).join(
            handles, F.col("probed") == F.col("handle"), "left"
        )
        step = stored(
            step.select(
                *batch.columns,
                F.when(missed, F.col("low")).when(whole, F.col("node_depth")).otherwise(F.col("node_above")).alias("low"),
                F.when(missed, F.col("probe") - 1).when(whole, F.col("high")).otherwise(F.col("node_above")).alias("high"),
            )
        )
        closed, open_ = step.where("low >= high"), step.where("low < high")
        found = closed if found is None else found.union(closed)
        if open_.isEmpty():
            break
    edges = nodes.select(
        F.substring("path", 1, WIDTH).alias("first"), F.col("id").alias("exit"), F.col("depth").alias("exit_depth"), F.col("path").alias("edge")
    )
    rest = found.where(F.col("low") < stop).withColumn("next", hash_at("path", start, F.col("low") + 1))
    both = rest.join(edges, F.col("next") == F.col("first"), "left")
    steps = F.sequence(F.lit(1).cast("long"), F.least(stop, F.col("exit_depth")) - F.col("low"))
    shared = F.size(F.filter(steps, lambda i: hash_at("path", start, F.col("low") + i) == hash_at("edge", F.lit(1), i)))
    common = F.when(F.col("exit").isNull(), F.lit(0)).otherwise(shared)
    return stored(both.select(*batch.columns, (F.col("low") + common).alias("leaves_at"), "exit"))


def cut(nodes: DataFrame, left: DataFrame) -> DataFrame:
    """The nodes with a new one wherever a path leaves or ends on an edge."""
    cuts = left.where("exit is not null").groupBy("exit").agg(F.sort_array(F.collect_set("leaves_at")).alias("cuts"))
    bounds = F.concat(F.array("above"), F.coalesce("cuts", F.array().cast("array<bigint>")), F.array("depth"))
    pieces = nodes.join(cuts, F.col("id") == F.col("exit"), "left").withColumn("bounds", bounds)
    pieces = pieces.withColumn("i", F.explode(F.sequence(F.lit(1), F.size("bounds") - 1)))
    a, b = F.element_at("bounds", F.col("i")), F.element_at("bounds", F.col("i") + 1)
    base, first = F.col("above"), F.col("above") + 1
    return pieces.select(
        hash_at("path", first, b).alias("id"),
        b.alias("depth"),
        F.when(a == base, F.col("up")).otherwise(hash_at("path", first, a)).alias("up"),
        a.alias("above"),
        F.substring(F.col("path"), ((a - base) * WIDTH + 1).cast("int"), ((b - a) * WIDTH).cast("int")).alias("path"),
        F.slice("weights", (a - base + 1).cast("int"), (b - a + 1).cast("int")).alias("weights"),
    )


def shared_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // WIDTH
    differ = np.flatnonzero((words_of(a[: n * WIDTH]) != words_of(b[: n * WIDTH])).any(axis=1))
    return int(differ[0]) if len(differ) else n


class Branch:
    """Nodes below one exit point, from the rests of paths in sorted order; holds the last path and its open nodes only."""

    def __init__(self, up: bytes, above: int) -> None:
        self.up, self.above = up, above
        self.path, self.weights, self.open = b"", [0], [0]

    def node(self, upper: int, own: int) -> tuple:
        at = lambda d: self.path[(d - 1) * WIDTH : d * WIDTH]
        return (
            at(own),
            self.above + own,
            at(upper) if upper else self.up,
            self.above + upper,
            self.path[upper * WIDTH : own * WIDTH],
            self.weights[upper : own + 1],
        )

    def close(self, down_to: int) -> Iterator[tuple]:
        """The nodes deeper than that; a node is made there if a path is left between two."""
        while self.open[-1] > down_to:
            own = self.open.pop()
            if self.open[-1] < down_to:
                self.open.append(down_to)
            yield self.node(self.open[-1], own)

    def add(self, path: bytes, weights: list[int]) -> Iterator[tuple]:
        yield from self.close(shared_turns(self.path, path))
        self.path, self.weights = path, weights
        self.open.append(len(path) // WIDTH)


def grow(left: DataFrame) -> DataFrame:
    """The nodes that the paths add below their exit points."""
    start, at = F.col("start"), F.col("leaves_at")
    skip = (at - start).cast("int")
    rests = left.where(at < start + F.col("n")).select(
        hash_at("path", start, at).alias("up"),
        at.alias("above"),
        F.expr(f"substring(path, int((leaves_at - start + 1) * {WIDTH} + 1))").alias("path"),
        F.slice("weights", skip + 1, (F.col("n") + 1).cast("int") - skip).alias("weights"),
        hash_at("path", start, at + 1).alias("first"),
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        branch = None

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal branch
            for up, above, path, weights in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if branch is None or path[:WIDTH] != branch.path[:WIDTH]:
                    if branch:
                        yield from branch.close(0)
                    branch = Branch(up, above)
                yield from branch.add(path, weights)

        for batch in batches:
            yield as_nodes(list(rows(batch)))
        if branch:
            yield as_nodes(list(branch.close(0)))

    dealt = rests.repartition("first").sortWithinPartitions("first", "path").drop("first")
    return dealt.mapInArrow(build, "id binary, depth long, up binary, above long, path binary, weights array<long>")


def as_nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], NODE_COLUMNS)


def insert(segs: DataFrame) -> DataFrame:
    """The compacted nodes without the root: ``id`` (hash at ``depth``), ``up`` and ``above`` (the same of the parent), ``path`` (the
    hashes of the edge) and ``weights`` (bytes so far from ``above`` to ``depth``)."""
    classes = stored(segs.dropDuplicates(["end"]).select("end", "start", "n", "path", "weights"))
    total, size, nodes = classes.count(), FIRST_BATCH, None
    place, below = F.pmod(F.xxhash64("end"), F.lit(1 << 40)), 0
    while nodes is None or below < 1 << 40:
        upto = (1 << 40) if size >= total else (1 << 40) * size // total
        batch = classes.where((place >= below) & (place < upto))
        if nodes is None:
            nodes = stored(grow(batch.withColumn("leaves_at", F.col("start"))))
        else:
            left = locate(batch, nodes)
            nodes = stored(cut(nodes, left).unionByName(grow(left)))
        below, size = upto, size * GROWTH
    return nodes


def id_digests(ends: DataFrame) -> DataFrame:
    """``of`` and ``sha``: of each node the digest of the ids that end there, ascending, joined by commas.

    Ids are sorted in ranges and packed to pieces of text there, so that a node with very many costs the task that digests them
    one row for each piece.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"of": node, "first": first, "piece": ",".join(ids)}], pa.schema([("of", pa.binary()), ("first", pa.int64()), ("piece", pa.string())])
            )

        for batch in batches:
            for end, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if end != node or size > PIECE:
                    if ids:
                        yield piece()
                    node, first, ids, size = end, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        kind = pa.schema([("of", pa.binary()), ("sha", pa.string())])
        for batch in batches:
            done = []
            for of, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if of == node:
                    sha.update(b",")
                else:
                    if sha:
                        done.append({"of": node, "sha": sha.hexdigest()})
                    node, sha = of, hashlib.sha256()
                sha.update(piece.encode())
            yield pa.RecordBatch.from_pylist(done, kind)
        if sha:
            yield pa.RecordBatch.from_pylist([{"of": node, "sha": sha.hexdigest()}], kind)

    sorted_ = ends.select("end", "conv").repartitionByRange(parts, "end", "conv").sortWithinPartitions("end", "conv")
    pieces = sorted_.mapInArrow(pack, "of binary, first long, piece string").repartition("of").sortWithinPartitions("of", "first")
    return pieces.select("of", "piece").mapInArrow(digest, "of binary, sha string")


def subtree_sums(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """For each node, over its subtree: ``n`` paths that end, ``low`` (their smallest id), ``leaves``, ``load`` (bytes of those paths
    from the root) and ``mass`` (bytes of the edges, its own included); ``children`` of the node itself.

    In round k a node holds the sums of all descendants less than 2^k below, and adds those of the nodes 2^k below.
    """
    here = ends.groupBy("end").agg(F.count("conv").alias("n"), F.min("conv").alias("low"))
    below = nodes.where("up is not null").groupBy(F.col("up").alias("of")).agg(F.count("id").alias("children"))
    n, weight = F.coalesce("n", F.lit(0)), F.element_at("weights", -1)
    values = stored(
        nodes.join(here, F.col("id") == F.col("end"), "left").join(below, F.col("id") == F.col("of"), "left").select(
            "id",
            n.alias("n"),
            "low",
            F.col("children").isNull().cast("long").alias("leaves"),
            (n * weight).alias("load"),
            (weight - F.element_at("weights", 1)).alias("mass"),
            F.coalesce("children", F.lit(0)).alias("children"),
        )
    )
    lines = stored(nodes.where("up is not null").select("id", F.col("up").alias("upper")))
    while not lines.isEmpty():
        sums = [F.sum(c).alias(f"{c}_") for c in ("n", "leaves", "load", "mass")]
        added = values.join(lines, "id").groupBy(F.col("upper").alias("of")).agg(F.min("low").alias("low_"), *sums)
        both = values.join(added, F.col("id") == F.col("of"), "left")
        grown = [(F.col(c) + F.coalesce(f"{c}_", F.lit(0))).alias(c) for c in ("n", "leaves", "load", "mass")]
        values = stored(both.select("id", F.least("low", "low_").alias("low"), *grown, "children"))
        upper = lines.select(F.col("id").alias("via"), F.col("upper").alias("next"))
        lines = stored(lines.where(F.col("upper") != F.lit(ROOT)).join(upper, F.col("upper") == F.col("via")).select("id", F.col("next").alias("upper")))
    return values


@dataclass
class Trie:
    """``nodes`` (compacted, with the root), ``ends`` (``conv``, ``end``: the node where each conversation ends), ``sums`` of the subtrees."""

    nodes: DataFrame
    ends: DataFrame
    sums: DataFrame

    def expanded(self) -> DataFrame:
        """A row for each distinct prefix: ``node`` (its hash), ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
        ``saved_tokens``, ``ends_sha256``. On an edge all prefixes have the members of the node below."""
        upper = self.sums.select(F.col("id").alias("upper"), F.col("low").alias("upper_low"))
        digests = id_digests(self.ends)
        known = (
            self.nodes.join(self.sums, "id")
            .join(upper, F.col("up") == F.col("upper"), "left")
            .join(digests, F.col("id") == F.col("of"), "left")
        )
        first = F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.col("above") + 1)
        each = known.withColumn("d", F.explode(F.sequence(first, F.col("depth"))))
        last, base = F.col("d") == F.col("depth"), F.element_at("weights", 1)
        before = F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.element_at("weights", (F.col("d") - F.col("above")).cast("int")))
        return each.select(
            F.when(F.col("depth") == 0, F.col("id")).otherwise(hash_at("path", F.col("above") + 1, F.col("d"))).alias("node"),
            F.col("low").alias("conv_id"),
            F.col("d").alias("depth"),
            F.when(F.col("d") == 0, F.lit(None)).when(F.col("d") == F.col("above") + 1, F.col("upper_low")).otherwise(F.col("low")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.when(last, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            (F.col("load") - F.col("n") * before - F.col("mass") + before - base).alias("saved_tokens"),
            F.when(last, F.coalesce("sha", F.lit(EMPTY_SHA))).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"),
        )


def prefix_trie(turns: DataFrame, convs: DataFrame) -> Trie:
    """The trie of all conversations. ``turns``: ``conv``, ``depth`` (1, 2, ... without gaps), ``key`` (16 bytes), ``n_bytes``; ``convs``: the
    ids (``conv``) of all conversations, those without turns included, once each. Without conversations there is no node, not
    even a root."""
    segs = segments(turns)
    turnless = convs.select("conv").join(segs.where("seg = 0").select("conv"), "conv", "left_anti")
    ends = stored(segs.where("last").select("conv", "end").union(turnless.withColumn("end", F.lit(ROOT))))
    root = ends.limit(1).select(
        F.lit(ROOT).alias("id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("up"),
        F.lit(0).cast("long").alias("above"),
        F.lit(b"").alias("path"),
        F.array(F.lit(0).cast("long")).alias("weights"),
    )
    nodes = stored(insert(segs).unionByName(root))
    return Trie(nodes, ends, subtree_sums(nodes, ends))


def share_heads(conversations: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to share their first turns, as ``turns`` and ``convs`` of ``prefix_trie``.

    The first h turns of conversation c come from conversation c - c % every (all if it has fewer, none if there is none), then
    follow its own after its first h; h is crc32 of the decimal c, modulo ``most``. Turns are ordered by ``turn``, null first.
    """
    placed = stored(numbered(turn_keys(conversations)))
    counts = placed.groupBy("conv").agg(F.count("conv").alias("n"))
    head = F.crc32(F.col("conv").cast("string")) % most
    given = counts.select("conv", head.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    sizes = counts.select(F.col("conv").alias("of"), F.col("n").alias("n_base"))
    known = stored(given.join(sizes, F.col("base") == F.col("of"), "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))))
    heads = placed.where(F.col("place") < most).withColumnRenamed("conv", "of")
    taken = known.select("conv", "base", "h").join(heads, F.col("base") == F.col("of")).where("place <= h")
    own = placed.join(known.select("conv", "h", "taken"), "conv").where("place > h")
    turns = taken.select("conv", F.col("place").alias("depth"), "key", "n_bytes").union(
        own.select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "key", "n_bytes")
    )
    return turns, known.select("conv")
