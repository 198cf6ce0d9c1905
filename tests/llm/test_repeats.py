from __future__ import annotations

import numpy as np
import pytest

from tallyloom.llm import repeats
from tests.llm import brute


def found(frame):
    return {r.doc_id: (r.n_bytes, [list(s) for s in r.spans], bytes(r.kept)) for r in frame.collect()}


@pytest.mark.parametrize(("length", "pack", "bucket"), [(50, None, None), (50, 4000, 3000), (20, 20_000, 2000), (90, 30_000, 5000)])
def test_cuts_what_brute_force_cuts(docs, passages, length, pack, bucket):
    result = repeats.cut_repeats(docs, length, pack_bytes=pack, bucket_bytes=bucket)
    assert found(result) == brute.cut_repeats(passages, length)
    assert {"items", "size"} <= set(result.columns)


def test_test_table(spark, documents):
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    assert found(repeats.cut_repeats(frame)) == brute.cut_repeats(documents, 50)


def test_rows_that_share_an_id_and_rows_without_one(spark):
    long = "this sentence is longer than fifty bytes, as it goes on and on"
    frame = spark.createDataFrame([(1, long), (1, long), (2, long), (None, long), (None, None)], "doc_id long, text string")
    kept = sorted((r.doc_id or 0, len(r.kept)) for r in repeats.cut_repeats(frame).collect())
    assert kept == [(0, 0), (0, len(long)), (1, len(long)), (1, len(long)), (2, 0)]


def test_empty_table_and_clashing_names(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, kept int, spans int")
    result = repeats.cut_repeats(frame)
    assert result.columns == ["doc_id", "n_bytes", "spans", "kept"] and result.count() == 0


def test_suffix_sort_orders_each_group():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 900).astype(np.uint8)
    at = np.sort(rng.integers(0, 880, 400))
    group = np.sort(rng.integers(0, 7, 400))
    order = repeats.SuffixOrder(data, 20).sort(at, group)
    assert (group[order] == group).all() and sorted(order) == list(range(400))
    strings = [(g, data[a : a + 20].tobytes()) for g, a in zip(group, at[order], strict=True)]
    assert strings == sorted(strings)


def test_colliding_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(repeats.SuffixOrder, "common", lambda self, a, b: np.full(len(a), self.length))
    data = np.frombuffer(b"abcdeXbcdeabcde", np.uint8)
    at, five = np.array([0, 5, 10]), np.full(3, 5)
    bits = repeats.repeated_strings(data, at, five, np.zeros(3, np.int64), np.zeros(3, np.uint32), np.array([1, 2, 3]), 5)
    assert bits.tolist() == [0, 0, 1]


def hot_passage(n):
    """Stretches of 75 bytes whose anchor is in a passage that all hold, with a few bytes before it and their own after it."""
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 123, 50)
    data = rng.integers(97, 100, (n, 75))
    data[:, 4:54] = shared
    return data.astype(np.uint8).ravel(), np.arange(n) * 75, np.full(n, 75), np.full(n, 25), rng.permutation(n)


def in_earlier(data, at, size, doc, length):
    first = {}
    for a, n, d in zip(at, size, doc, strict=True):
        for i in range(n - length + 1):
            s = (i, data[a + i : a + i + length].tobytes())
            first[s] = min(d, first.get(s, d))
    held = [[d > first[i, data[a + i : a + i + length].tobytes()] for i in range(n - length + 1)] for a, n, d in zip(at, size, doc, strict=True)]
    return [sum(1 << i for i, x in enumerate(own) if x) for own in held]


def test_strings_round_a_common_passage_are_compared_once_each(monkeypatch):
    compared = []
    common = repeats.SuffixOrder.common
    monkeypatch.setattr(repeats.SuffixOrder, "common", lambda self, a, b: compared.append(len(a)) or common(self, a, b))
    data, at, size, lead, doc = hot_passage(2000)
    bits = repeats.repeated_strings(data, at, size, lead, np.zeros(2000, np.uint32), doc, 50)
    assert bits.tolist() == in_earlier(data, at, size, doc, 50)
    assert sum(compared) <= 2000 * 26


def test_suffixes_of_one_anchor_are_sorted_a_part_at_a_time(monkeypatch):
    monkeypatch.setattr(repeats, "SORTED_AT_ONCE", 1000)
    sizes = []
    sort = repeats.SuffixOrder.sort
    monkeypatch.setattr(repeats.SuffixOrder, "sort", lambda self, suffix, group: sizes.append(len(suffix)) or sort(self, suffix, group))
    data, at, size, lead, doc = hot_passage(700)
    h = np.where(np.arange(700) % 10, 7, np.arange(700)).astype(np.uint32)
    bits = repeats.repeated_strings(data, at, size, lead, h, doc, 50)
    some = h == 7
    assert bits[some].tolist() == in_earlier(data, at[some], size[some], doc[some], 50)
    assert sum(sizes) == 700 * 26 and max(sizes) <= 1000 + some.sum()


def test_buckets_are_answered_once(docs):
    result = repeats.cut_repeats(docs, pack_bytes=20_000, bucket_bytes=20_000)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count(", answer(") == 1


def test_anchors_do_not_depend_on_where_chunks_end(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    whole, changes = repeats.anchors(repeats.byte_hashes(data), len(data), 50, 25)
    monkeypatch.setattr(repeats, "CHUNK", 64)
    some, others = repeats.anchors(repeats.byte_hashes(data), len(data), 50, 25)
    assert (whole == some).all() and (changes == others).all() and (np.flatnonzero(np.diff(whole)) + 1 == changes).all()


def test_runs_and_rest_of_each_text():
    data = np.frombuffer(b"abcdefgh", np.uint8)
    gone = np.array([1, 0, 1, 1, 1, 0, 0, 1], bool)
    spans, kept = repeats.without(data, np.array([0, 0, 3, 4, 7, 8, 8]), gone)
    assert spans.to_pylist() == [[], [[0, 1], [2, 3]], [[0, 1]], [[0, 1]], [[0, 1]], []]
    assert kept.to_pylist() == [b"", b"b", b"", b"fg", b"", b""]
    spans, kept = repeats.without(data[:0], np.array([0, 0]), gone[:0])
    assert spans.to_pylist() == [[]] and kept.to_pylist() == [b""]
