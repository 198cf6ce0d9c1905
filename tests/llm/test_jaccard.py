from __future__ import annotations

import random

import pytest

from tallyloom.llm import jaccard, storage
from tests.llm import brute


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_components_equal_brute_force(docs, passages):
    assert found(jaccard.near_duplicates(docs)) == brute.components(passages)


def test_test_table(spark, documents):
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    assert found(jaccard.near_duplicates(frame)) == brute.components(documents)


@pytest.mark.parametrize("hot", [500, 3])
def test_groups_near_the_threshold(spark, monkeypatch, hot):
    """Chains of edits whose ends are not similar, so that links lead through documents that are no group's smallest."""
    monkeypatch.setattr(jaccard, "HOT_DOCS", hot)
    monkeypatch.setattr(jaccard, "HOT_MEANS", 0)
    monkeypatch.setattr(jaccard, "SALTS", 3)
    rng = random.Random(9)
    texts, words = [], [f"t{i}" for i in range(2000)]
    for _ in range(6):
        base = rng.choices(words, k=60)
        for _ in range(15):
            base = list(base)
            for _ in range(rng.randint(1, 2)):
                base[rng.randrange(len(base))] = rng.choice(words)
            if rng.random() < 0.3:
                base = base[: rng.randint(45, 60)] + rng.choices(words, k=3)
            texts.append(" ".join(base))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    expected = brute.components(rows)
    assert len({c for _, c in expected.values()}) > 6
    assert found(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == expected


def test_shared_and_missing_ids_and_empty_tables(spark):
    text = "six words are in this text"
    frame = spark.createDataFrame([(1, text), (1, text), (None, text), (4, text), (5, None)], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(frame).collect())
    assert rows == [(0, 2, None), (1, 2, 1), (1, 2, 1), (4, 2, 1), (5, 0, 5)]
    assert jaccard.near_duplicates(frame.limit(0)).count() == 0
    assert sorted(r.doc_id or 0 for r in jaccard.keep_one(frame).collect()) == [0, 1, 1, 5]


def test_keep_one_leaves_columns_alone(docs, passages):
    left = jaccard.keep_one(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {d for d, (_, c) in brute.components(passages).items() if c == d}


def test_connected_follows_long_paths(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (7, 3), (200, 200), (None, 1)]
    rows = {(r.node, r.component) for r in storage.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert rows == {(i, 0) for i in range(51)} | {(100, 100), (101, 100)}


def test_rows_that_share_an_id_and_differ_in_text(spark):
    a, b = "six words are in this text", "and quite another one is that"
    rows = [(1, a), (1, b), (2, b), (3, a), (4, None), (1, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(frame).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_near_copies_of_which_few_are_similar(spark):
    """One family of near copies around the threshold: the rows compared grow with its size, and no link is lost."""
    rng = random.Random(5)
    words = [f"t{i}" for i in range(2000)]
    base, rows = rng.choices(words, k=150), []
    for i in range(160):
        own = list(base)
        for _ in range(3):
            own[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(own)))
    expected = brute.components(rows)
    assert len({c for _, c in expected.values()}) > 10
    assert found(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == expected
