"""MinHash near-duplicates against brute force, the sketches by themselves, and growth of the comparison within groups."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tallyloom.llm import groups, oddsketch
from tests.llm import brute

KIND = "doc_id long, text string, size int, bucket string"


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "own") for i, t in rows], KIND).repartition(4)


def test_components_equal_brute_force(docs, passages):
    result = oddsketch.near_duplicates(docs)
    assert found(result) == brute.components(passages, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in result.collect())


def test_test_table(spark, documents):
    assert found(oddsketch.near_duplicates(frame_of(spark, documents))) == brute.components(documents, 85)


def families(seed, size, edits, words=120, n=4):
    """Groups of texts with a few words changed at random in each, most of them near the threshold."""
    rng = random.Random(seed)
    vocabulary, texts = [f"t{i}" for i in range(3000)], []
    for _ in range(n):
        base = rng.choices(vocabulary, k=words)
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(*edits)):
                own[rng.randrange(words)] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [groups.BLOCK_ROWS, 5])
def test_groups_around_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(groups, "BLOCK_ROWS", block)
    monkeypatch.setattr(groups, "BLOCK_BYTES", 8 << 20 if block > 5 else 6000)
    rows = families(3, 25, (0, 3))
    expected = brute.components(rows, 85)
    assert 8 < len({c for _, c in expected.values()}) < 90
    assert found(oddsketch.near_duplicates(frame_of(spark, rows))) == expected


def test_shared_and_missing_ids_copies_and_empty_tables(spark):
    a, b = "six words are in this text", "and quite another one is that"
    rows = [(1, a), (1, b), (2, b), (3, a), (3, a), (None, a), (5, None), (6, " \t"), (7, "two words"), (8, "Two  WORDS"), (9, "x " * 50_000)]
    frame = spark.createDataFrame([(i, t, 1, "own") for i, t in rows], KIND)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in oddsketch.near_duplicates(frame).collect())
    assert got == [
        (0, 2, None, None), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (3, 2, 1, False),
        (5, 0, 5, True), (6, 0, 6, True), (7, 1, 7, True), (8, 1, 7, False), (9, 1, 9, True),
    ]
    assert oddsketch.near_duplicates(frame.limit(0)).count() == 0


def overlapping(rng, size, similarity):
    """Two sets of that size and similarity."""
    common = round(2 * size * similarity / (1 + similarity))
    hashes = rng.integers(0, 1 << 63, 2 * size - common, dtype=np.uint64)
    return np.unique(hashes[:size]), np.unique(hashes[size - common :])


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(1)
    for similarity in (0.8, 0.85, 0.9, 0.97):
        ones = []
        for _ in range(60):
            a, b = oddsketch.odd_sketches(oddsketch.minhashes(list(overlapping(rng, 400, similarity))))
            ones.append(int(np.bitwise_count(np.frombuffer(a, np.uint64) ^ np.frombuffer(b, np.uint64)).sum()))
        assert abs(float(oddsketch.estimate(np.array(ones)).mean()) - similarity) < 0.02
        assert similarity < 0.85 or max(ones) < oddsketch.most_ones(85)
    assert oddsketch.estimate(np.array([oddsketch.most_ones(85)]))[0] > 0.6


def test_samples_of_a_batch_are_those_of_each_set(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (0, 1, 7, 0, 50, 3, 200, 0)]
    monkeypatch.setattr(oddsketch, "PIECE", 16)
    found = oddsketch.minhashes(sets)
    for s, own in zip(sets, found, strict=True):
        for i in (0, 1, 255):
            each = [(int(h) ^ int(oddsketch.SEEDS[i])) * int(oddsketch.ODD[i]) % (1 << 64) for h in s]
            assert int(own[i]) == min(each, default=(1 << 64) - 1)
    assert oddsketch.minhashes([]).shape == (0, oddsketch.SAMPLES)


def test_bitmaps_never_differ_in_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(2)
    for size_a, size_b, common in [(3, 5, 2), (40, 50, 30), (100, 130, 100), (1000, 1300, 900), (0, 4, 0)]:
        pool = rng.integers(0, 1 << 63, size_a + size_b, dtype=np.uint64)
        a, b = np.unique(pool[:size_a]), np.unique(pool[size_a - common : size_a - common + size_b])
        x, y = (np.frombuffer(groups.parity(s), np.uint64)[None, :] for s in (a, b))
        width = min(x.shape[1], y.shape[1])
        apart = int(np.bitwise_count(groups.folded(x, width) ^ groups.folded(y, width)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_rows_of_a_group_grow_with_its_size_only(spark):
    """Near copies of which no two are similar enough: none passes on more rows than there are members."""
    counts = []
    for size in (40, 80):
        rows = families(7, size, (9, 9), n=1)
        members = spark.createDataFrame([(1, i, i) for i, _ in rows], "bucket long, doc long, comp long")
        info = oddsketch.sketched(spark.createDataFrame(rows, "doc long, text string"), 5).select("doc", "size", "parity")
        spread = members.join(info, "doc").selectExpr("bucket", "doc", "comp", "cast(size as long) size", "parity", f"{size} as n")
        counts.append(groups.with_close_partner(spread, 40).count())
    assert counts == [40, 80]
