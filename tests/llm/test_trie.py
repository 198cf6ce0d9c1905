"""The conversation trie against a plain one, with tiny batches and segments so that all paths of the build are taken."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import queries, trie
from tests.llm import brute

KIND = "conv_id long, turn long, role string, text string, path string, depth int"


def plain(paths):
    """Node rows of conversations given as id: list of (role, text), by depth and members."""
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, rows = defaultdict(int), []
    for p in members:
        kids[p[:-1]] += len(p) > 0
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1].encode()) if p else 0
    for p, own in members.items():
        done = ",".join(str(c) for c in sorted(own) if len(paths[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        rows.append((min(own), len(p), parent, len(own), kids[p], leaves[p], saved[p], brute.sha(done)))
    return sorted(rows, key=str)


def rebuilt(rows):
    """The contract's conversations from raw rows (conversation, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            own[c].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def built(spark, paths):
    keyed = [(c, d, r, t, "", 0) for c, turns in paths.items() for d, (r, t) in enumerate(turns, 1)]
    turns = trie.turn_keys(spark.createDataFrame(keyed, KIND).repartition(3)).withColumnRenamed("turn", "depth")
    convs = spark.createDataFrame([(c,) for c in paths], "conv long")
    return trie.prefix_trie(turns, convs)


def rows_of(frame):
    return sorted(
        (
            (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
            for r in frame.collect()
        ),
        key=str,
    )


def some_paths(seed):
    rng = random.Random(seed)
    turn = lambda: (rng.choice(["user", "bot"]), "x" * rng.randint(0, 3) + rng.choice("äb"))
    paths = {0: [], 1: []}
    for c in range(2, 60):
        base = list(rng.choice(list(paths.values())))
        cut = rng.randint(0, len(base))
        paths[c] = base[:cut] + [turn() for _ in range(rng.choice([0, 0, 1, 2, 5]))]
    paths[70] = [turn() for _ in range(23)]
    paths[71] = paths[70][:17] + [turn() for _ in range(9)]
    paths[72] = list(paths[70])
    paths[73] = paths[70][:8]
    paths[-4] = [("user", "")] * 11  # the same turn again and again
    return paths


@pytest.mark.parametrize(("segment", "first", "growth"), [(4, 3, 4), (512, 5, 3)])
def test_equals_the_plain_trie(spark, monkeypatch, segment, first, growth):
    monkeypatch.setattr(trie, "SEGMENT", segment)
    monkeypatch.setattr(trie, "FIRST_BATCH", first)
    monkeypatch.setattr(trie, "GROWTH", growth)
    monkeypatch.setattr(trie, "PIECE", 10)
    paths = some_paths(segment)
    found = built(spark, paths)
    assert rows_of(found.expanded()) == plain(paths)
    compact = {r.id: r for r in found.nodes.collect()}
    assert len(compact) < found.expanded().count()
    assert all(r.up in compact and compact[r.up].depth == r.above for r in compact.values() if r.up is not None)


def test_rebuilding_nulls_ties_and_turnless_conversations(spark):
    rng = random.Random(2)
    some = lambda: (rng.choice(["u", None]), rng.choice(["a", "b", None, ""]))
    ids = [c for c in range(-12, 40) if c % 5 != 3 and not 25 <= c < 30]
    rows = [(c, t, *some()) for c in ids for t in range(rng.randint(1, 12))]
    rows += [(c, None, "system", "first") for c in (2, 4, 7, 20)] + [(5, 0, *rows[[r[0] for r in rows].index(5)][2:])]
    rows += [(c, 0, "u", "short") for c in (26, 27, 28, 29)]  # conversation 25 isn't there
    rows += [(33, 0, "u", "alone"), (None, 0, "u", "of none"), (100, 1, "u", "t" * 100_000)]
    expected = rebuilt(rows)
    assert any(not p for p in expected.values())
    frame = spark.createDataFrame([(*r, "own", 1) for r in rows], KIND).repartition(4)
    turns, convs = trie.share_heads(frame)
    assert rows_of(trie.prefix_trie(turns, convs).expanded()) == plain(expected)


def test_one_conversation_over_many_ranges(spark):
    """A conversation with most of all rows, and one turn number on most of its rows."""
    rows = [(1, t if t < 50 else 50, "u", str(t % 7), "", 0) for t in range(600)] + [(c, 0, "u", "0", "", 0) for c in range(2, 9)]
    placed = trie.numbered(trie.turn_keys(spark.createDataFrame(rows, KIND).repartition(5)))
    assert sorted(r.place for r in placed.where("conv = 1").collect()) == list(range(1, 601))
    assert [r.place for r in placed.where("conv > 1").collect()] == [1] * 7


def test_no_conversations(spark):
    turns, convs = trie.share_heads(spark.createDataFrame([], KIND))
    assert trie.prefix_trie(turns, convs).expanded().collect() == []


def test_test_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op13_prefix_trie(spark, folder)) == plain(rebuilt(rows))


@pytest.mark.parametrize(("low", "high", "expected"), [(0, 1, 1), (0, 8, 8), (4, 7, 6), (3, 4, 4), (8, 9, 9), (5, 300, 256), (511, 513, 512)])
def test_two_fattest_number(spark, low, high, expected):
    frame = spark.createDataFrame([(low, high)], "low long, high long")
    assert frame.select(trie.fattest("low", "high")).head()[0] == expected
    trailing = {n: (n & -n) for n in range(low + 1, high + 1)}
    assert max(trailing, key=trailing.get) == expected


def test_sums_over_conversations(spark):
    found = built(spark, some_paths(1)).expanded()
    assert found.where(F.col("depth") == 0).head().n_convs == len(some_paths(1))
