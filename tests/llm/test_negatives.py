"""Hard negatives against a plain version, and the residue arithmetic by itself."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import negatives

KIND = "vec_id long, embedding array<float>, label int, row string, score double"


def plain(rows, every, low=80):
    """Rows as (id, vector, label): what the operator promises, pair by pair."""
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], c)
        for i, v, c in rows
        if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda scored: sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0))
    out = []
    for a, (i, v, c) in enumerate(good):
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, d) for b, (j, w, d) in enumerate(good) if b != a]
        for score, j, _ in order([s for s in scored if s[2] == c])[:5]:
            fits = [s for s in scored if s[2] != c and low * score <= 100 * s[0] <= 100 * score]
            out += [(i, j, k, n, score, s) for k, (s, n, _) in enumerate(order(fits)[:5], 1)]
    return out


def mined(frame, every, **options):
    found = negatives.mine_hard_negatives(frame, F.col("vec_id") % every == 0, **options)
    return [tuple(r) for r in found.collect()]


def comparable(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def some(n, seed=1, dims=20):
    rng = random.Random(seed)
    near = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    return [(i, [x + rng.gauss(0, 0.7) for x in rng.choice(near)], rng.randrange(4)) for i in range(n)]


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", 0.5) for i, v, c in rows], KIND).repartition(3)


@pytest.mark.parametrize("low", [0, 80])
def test_equals_the_plain_version(spark, monkeypatch, low):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 7)
    monkeypatch.setattr(negatives, "ROW_BLOCK", 40)
    rows = some(300)
    expected = plain(rows, 10, low)
    assert len(expected) > 300
    assert comparable(mined(frame_of(spark, rows), 10, low=low)) == comparable(expected)


def test_ties_copies_nulls_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5, -0.25, 1.0]
    rows = [(i, same, i % 3) for i in range(40)]  # all scores tie
    rows += [(100, None, 1), (110, [1.0, None, 2.0], 1), (120, [nan, 1.0, 1.0], 1), (130, [inf, 1.0, 1.0], 1), (140, same, None)]
    rows += [(200, [], 1), (210, [0.5], 2), (220, [0.5, 1.0, 1.0, 4.0], 0), (None, [0.6, 0.1, 0.9], 1), (230, same, 77)]
    rows += [(10, same, 1), (10, same, 2)]  # an id twice more, with another label too
    found = mined(frame_of(spark, rows), 10)
    assert comparable(found) == comparable(plain(rows, 10))
    assert not {a for a, *_ in found} & {100, 110, 120, 130, 140, 230, None}


def test_empty_table_and_no_anchor(spark):
    assert mined(frame_of(spark, some(20)).limit(0), 1) == []
    assert mined(frame_of(spark, some(20)).where("vec_id % 10 <> 0"), 10) == []


def test_vectors_beyond_exact_scores_are_refused(spark):
    with pytest.raises(ValueError, match="too long"):
        mined(frame_of(spark, [(0, [1e9, 1.0], 1), (1, [1.0, 1.0], 2)]), 1)


@pytest.mark.parametrize(("largest", "dims"), [(3, 5), (300, 64), (5_000, 200), (2_000_000, 130)])
def test_residue_products_are_exact(largest, dims):
    rng = np.random.default_rng(4)
    a, b = rng.integers(-largest, largest + 1, (9, dims)), rng.integers(-largest, largest + 1, (11, dims))
    a[0], b[0] = largest, -largest  # the extreme score
    bound = dims * largest**2
    primes = negatives.primes_for(bound)
    found = negatives.products(negatives.residues(a, primes), negatives.residues(b, primes), primes)
    assert found.tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
    assert bound * 2 < math.prod(primes)


def test_float32_sums_stay_exact():
    assert negatives.DEPTH * (max(negatives.PRIMES) // 2) ** 2 < 1 << 24
    assert math.prod(negatives.PRIMES) > 2 * negatives.MOST and math.gcd(*negatives.PRIMES) == 1
