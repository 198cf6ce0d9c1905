"""Sums kept up to date with a replica, against sums over the whole table."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.plans.maintained import MaintainedSums, Refreshed
from tallyloom.plans.repair import repair
from tallyloom.plans.replicate import ConcurrentWrite, Replica

DDL = "id BIGINT, account STRING, company INT, amount DECIMAL(18,2), n INT, write_date TIMESTAMP_NTZ"
T0 = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def some_row(i, day, rng):
    amount = rng.choice([None, Decimal("0.00"), Decimal("1.25"), Decimal("-1.25"), Decimal(rng.randrange(-500, 500)) / 100])
    return (i, rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]), amount, rng.choice([None, 1, 2]), T0 + timedelta(days=day))


def expected(rows):
    groups = defaultdict(list)
    for _, account, company, amount, n, _ in rows.values():
        groups[account, company].append((amount, n))
    plus = lambda xs: sum(xs) if xs else None
    return {
        key: (len(own), *(plus([x[i] for x in own if x[i] is not None]) for i in (0, 1))) for key, own in groups.items()
    }


def kept(sums):
    rows = sums.read().collect()
    found = {(r.account, r.company): (r.n_rows, r.total, r.pieces) for r in rows}
    assert len(found) == len(rows)
    return found


def by_account(target, **options):
    keys = {"account": F.col("account"), "company": F.col("company")}
    return MaintainedSums(target, "t", "s", keys, {"total": F.col("amount"), "pieces": F.col("n")}, **options)


def test_random_batches_move_rows_between_groups(spark, tmp_path):
    rng = random.Random(5)
    target = Replica(spark, str(tmp_path), slot_rows=40)
    sums = by_account(target, parts=3)
    rows = {i: some_row(i, 0, rng) for i in range(200)}
    target.merge("t", frame(spark, list(rows.values())))
    assert sums.refresh() == Refreshed(5, len(expected(rows)), True) and kept(sums) == expected(rows)
    for day in (1, 2, 3):
        batch = [some_row(i, day, rng) for i in rng.sample(range(120, 260), 30)]
        rows |= {r[0]: r for r in batch}
        target.merge("t", frame(spark, batch))
        done = sums.refresh()
        assert not done.anew and 0 < done.slots < 5 and kept(sums) == expected(rows)
        assert sums.refresh() == Refreshed(0, 0, False) and kept(sums) == expected(rows)
    # Deleted rows, up to whole groups, are seen as soon as the replica is repaired.
    rows = {i: r for i, r in rows.items() if r[1] != "a" and i % 7}
    repair(target, "t", frame(spark, list(rows.values())))
    assert not sums.refresh().anew and kept(sums) == expected(rows)
    assert not any(account == "a" for account, _ in kept(sums))
    repair(target, "t", frame(spark, list(rows.values())).limit(0))
    sums.refresh()
    assert kept(sums) == {}


def test_sums_that_missed_a_version_are_made_anew(spark, tmp_path):
    rng = random.Random(6)
    target = Replica(spark, str(tmp_path), slot_rows=50)
    sums = by_account(target)
    rows = {i: some_row(i, 0, rng) for i in range(100)}
    target.merge("t", frame(spark, list(rows.values())))
    sums.refresh()
    # Two merges of different slots leave what is needed, two of one slot don't.
    for batches, anew in (((range(0, 5), range(60, 65)), False), ((range(0, 5), range(3, 9)), True)):
        for i in batches:
            batch = [some_row(j, 10, rng) for j in i]
            rows |= {r[0]: r for r in batch}
            target.merge("t", frame(spark, batch))
        assert sums.refresh().anew == anew and kept(sums) == expected(rows)


def test_only_changed_slots_and_touched_groups_are_read(spark, tmp_path, monkeypatch):
    rng = random.Random(7)
    target = Replica(spark, str(tmp_path), slot_rows=10)
    sums = by_account(target, parts=64)
    rows = {i: (i, f"k{i % 50}", 1, Decimal(1), 1, T0) for i in range(300)}
    target.merge("t", frame(spark, list(rows.values())))
    sums.refresh()
    seen = defaultdict(list)
    rows_of, read_slots = Replica.rows_of, Replica.read_slots

    def seen_rows(self, table, versions):
        seen["rows"] += [r.slot for r in versions.collect()]
        return rows_of(self, table, versions)

    def seen_slots(self, table, slots):
        seen["parts"] += [s for s in slots if s >= 0]
        return read_slots(self, table, slots)

    monkeypatch.setattr(Replica, "rows_of", seen_rows)
    monkeypatch.setattr(Replica, "read_slots", seen_slots)
    rows[123] = (123, "k7", 1, Decimal(rng.randrange(5, 9)), 1, T0 + timedelta(days=1))
    target.merge("t", frame(spark, [rows[123]]))
    assert sums.refresh() == Refreshed(1, 2, False)
    assert seen["rows"] == [12, 12] and len(seen["parts"]) <= 2
    assert kept(sums) == expected(rows)


def test_a_refresh_that_dies_or_comes_second_changes_nothing(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    target = Replica(spark, str(tmp_path), slot_rows=50)
    sums = by_account(target, parts=4)
    rows = {i: some_row(i, 0, rng) for i in range(100)}
    target.merge("t", frame(spark, list(rows.values())))
    sums.refresh()
    before = kept(sums)
    batch = [some_row(i, 1, rng) for i in range(20)]
    rows |= {r[0]: r for r in batch}
    target.merge("t", frame(spark, batch))
    commit, replace = Replica._commit, Replica.replace

    def dies(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(Replica, "_commit", dies)
    with pytest.raises(RuntimeError):
        sums.refresh()
    monkeypatch.setattr(Replica, "_commit", commit)
    assert kept(sums) == before

    def second(self, table, *rest):
        monkeypatch.setattr(Replica, "replace", replace)
        by_account(target, parts=4).refresh()
        return replace(self, table, *rest)

    monkeypatch.setattr(Replica, "replace", second)
    with pytest.raises(ConcurrentWrite):
        sums.refresh()
    assert kept(sums) == expected(rows)


def test_refusals_and_empty_tables(spark, tmp_path):
    target = Replica(spark, str(tmp_path), slot_rows=50)
    with pytest.raises(LookupError):
        by_account(target).refresh()
    target.merge("t", frame(spark, []))
    sums = by_account(target, parts=4)
    sums.refresh()
    assert kept(sums) == {}
    rows = {1: (1, "a", 1, Decimal(2), None, T0)}
    target.merge("t", frame(spark, list(rows.values())))
    sums.refresh()
    assert kept(sums) == expected(rows)
    with pytest.raises(ValueError, match="parts"):
        by_account(target, parts=5).refresh()
    with pytest.raises(ValueError, match="other sums"):
        MaintainedSums(target, "t", "s", {"account": F.col("account")}, {"total": F.col("amount")}, parts=4).refresh()
    with pytest.raises(ValueError, match="reserved"):
        MaintainedSums(target, "t", "x", {"slot": F.col("account")}, {})
    with pytest.raises(TypeError, match="integer or a decimal"):
        MaintainedSums(target, "t", "y", {"account": F.col("account")}, {"x": F.col("amount").cast("double")}).refresh()


def test_large_merges_leave_which_rows_a_refresh_sums(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyloom.plans.replicate.LARGE_MERGE", -1)
    rng = random.Random(9)
    target = Replica(spark, str(tmp_path), slot_rows=40)
    sums = by_account(target, parts=3)
    rows = {i: some_row(i, 0, rng) for i in range(-60, 140)}
    target.merge("t", frame(spark, list(rows.values())))
    sums.refresh()
    summed, measured = [], MaintainedSums._measured
    monkeypatch.setattr(MaintainedSums, "_measured", lambda self, part, sign: summed.append(part) or measured(self, part, sign))
    for day in (1, 2):
        batches = [[some_row(i, day, rng) for i in rng.sample(range(a, b), 12)] for a, b in ((-60, -20), (90, 170))]
        for batch in batches:
            rows |= {r[0]: r for r in batch}
            target.merge("t", frame(spark, batch))
        done = sums.refresh()
        assert not done.anew and kept(sums) == expected(rows)
        brought = {r[0] for batch in batches for r in batch}
        new, old = ({r.id for r in part.select("id").collect()} for part in summed[-2:])
        assert new == brought and old <= brought
    # A repair keeps no ids, so whole versions are summed after it.
    rows = {i: r for i, r in rows.items() if i % 5}
    repair(target, "t", frame(spark, list(rows.values())))
    assert not sums.refresh().anew and kept(sums) == expected(rows)
    target.merge("t", frame(spark, [some_row(7, 9, rng)]))
    assert len(list((tmp_path / "brought" / "t").iterdir())) <= 6
