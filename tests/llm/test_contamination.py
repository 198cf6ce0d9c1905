from __future__ import annotations

import random
import time

import pyarrow as pa
import pytest

from tallyloom.llm import contamination
from tests.llm import brute


@pytest.fixture(scope="module")
def items(passages):
    texts = [t for _, t in passages if t]
    cut = [" ".join(t.split()[5:40]) for t in texts[:25]]
    return [*enumerate(cut), (101, "w1 w2"), (102, "x"), (103, ""), (104, None), (105, " - "), (7, "W3, w4; w5")]


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_finds_what_brute_force_finds(spark, docs, passages, items, block, monkeypatch):
    monkeypatch.setattr(contamination, "SHARD_BYTES", 5000)
    tests = spark.createDataFrame(items, "item_id long, text string")
    result = contamination.find_contamination(docs, tests, block_bytes=block)
    rows = {r.doc_id: r for r in result.withColumn("n_hit", contamination.n_hit(result["hit_spans"])).collect()}
    assert "size" in result.columns
    for doc, text in passages:
        n_words, hit, ids = brute.contamination(text, items)
        row = rows[doc]
        assert (row.n_words, row.n_hit, row["items"]) == (n_words, len(hit), ids)
        assert {w for a, b in row.hit_spans for w in range(a, b)} == hit
        assert (row.longest_match > 0) == bool(hit)


def test_longest_match_spans_consecutive_windows(spark):
    words = " ".join(f"q{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "before " + words[: words.index("q30")] + "after")], "doc_id long, text string")
    tests = spark.createDataFrame([(1, words)], "item_id long, text string")
    row = contamination.find_contamination(docs, tests).head()
    assert row.longest_match == 30 and row["items"] == ["1"]


def test_affected_documents_go_and_columns_stay(spark, docs, passages, items):
    tests = spark.createDataFrame(items, "item_id long, text string")
    left = contamination.decontaminate(docs, tests)
    assert left.columns == docs.columns
    clean = {d for d, t in passages if not brute.contamination(t, items)[1]}
    rows = left.collect()
    assert {r.doc_id for r in rows} == clean and all(r["items"] == f"kept{r.doc_id}" for r in rows)


def test_no_items_no_documents(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.decontaminate(docs, none).count() == docs.count()
    assert contamination.find_contamination(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_items_without_id_count_except_in_the_list(spark, block):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "e f c d"), (3, "g h"), (4, None)], "doc_id long, text string")
    tests = spark.createDataFrame([(None, "A, b"), (None, "e f"), (None, None), (9, "c d")], "item_id long, text string")
    found = contamination.find_contamination(docs, tests, block_bytes=block)
    rows = {r.doc_id: (r.hit_spans, r["items"], r.longest_match) for r in found.collect()}
    assert rows == {1: ([[0, 4]], ["9"], 2), 2: ([[0, 4]], ["9"], 2), 3: ([], [], 0), 4: ([], [], 0)}
    without_ids = tests.where("item_id is null")
    assert {r.doc_id for r in contamination.decontaminate(docs, without_ids, block_bytes=block).collect()} == {3, 4}


def longest_by_brute_force(text, items, window):
    words, best = text.split(), 0
    for item in (i.split() for i in items):
        for a in range(len(words)):
            for b in range(len(item) - window + 1 if len(item) >= window else min(len(item), 1)):
                n = 0
                while a + n < len(words) and b + n < len(item) and words[a + n] == item[b + n]:
                    n += 1
                best = max(best, n if n >= min(window, len(item)) else 0)
    return best


def test_longest_match_against_brute_force(spark):
    rng = random.Random(3)

    def text(most):
        return " ".join(rng.choice("abc") for _ in range(rng.randrange(most)))

    items, texts = [text(14) for _ in range(40)], [text(60) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tests = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for window in (3, 7):
        rows = contamination.find_contamination(docs, tests, window=window).collect()
        assert {r.doc_id: r.longest_match for r in rows} == {i: longest_by_brute_force(t, items, window) for i, t in enumerate(texts)}


def test_different_windows_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(contamination, "mix", lambda x: x & contamination.np.uint64(1))
    texts = ["a b c d", "a c b d", "b c d a", "a b c d", "d d d d"]
    test = contamination.TestItems(list("vwxyz"), pa.array(texts), 3)
    words = [tuple(texts[i].split()) for i in range(5)]
    found = {tuple(w) for t in words for w in (t[:3], t[1:])}
    assert len(test.at) == len(found)
    assert sorted(map(tuple, (test.item_lists[i] for i in test.list_of))) == sorted(
        tuple(i for i, t in enumerate(words) if w in (t[:3], t[1:])) for w in found
    )


def test_many_items_with_one_prompt(spark):
    prompt = " ".join(f"p{i}" for i in range(30))
    items = [(i, f"{prompt} question {i} of many") for i in range(3000)]
    test = contamination.TestItems([str(i) for i, _ in items], pa.array([t for _, t in items]), 10)
    words = contamination.Words.of(pa.array([f"see: {prompt} and more {d}" for d in range(300)]))
    begin = time.process_time()
    at, which = contamination.matches(words, test)
    assert len(at) == 300 * 21 and set(contamination.longest(words, at, which, test)) == set(range(10, 31))
    assert {len(test.item_lists[i]) for i in test.list_of[which]} == {3000} and time.process_time() - begin < 2
    docs = spark.createDataFrame([(d, f"see: {prompt} and more {d}") for d in range(300)], "doc_id long, text string")
    rows = contamination.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert all((len(r["items"]), r.longest_match, r.hit_spans) == (3000, 30, [[1, 31]]) for r in rows)
