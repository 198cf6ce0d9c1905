"""Deleted and late rows: a replica made equal to its source again, reading rows only where they differ."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import repair as repairing
from tallyloom.plans.repair import differing_ranges, intervals, range_digests, repair, within
from tallyloom.plans.replicate import ConcurrentWrite, Replica

DDL = "id BIGINT, name STRING, rate DOUBLE, write_date TIMESTAMP_NTZ"
T0 = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some_rows(n, rng):
    return {i: (i, rng.choice(["a", "b", None]), rng.choice([1.0, -0.5, None]), T0 + timedelta(days=i)) for i in range(-20, n)}


def replicated(spark, root, rows, slot_rows=50):
    target = Replica(spark, str(root), slot_rows=slot_rows)
    target.merge("t", frame(spark, list(rows.values())))
    return target


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_random_deletes_late_and_back_dated_rows(spark, tmp_path, parts):
    rng = random.Random(parts)
    rows = some_rows(600, rng)
    target = replicated(spark, tmp_path, rows)
    for i in rng.sample(sorted(rows), 25):
        del rows[i]
    for i in rng.sample(sorted(rows), 5):
        rows[i] = (i, "late change", rows[i][2], T0 - timedelta(days=900))
    for i in range(250, 320):
        rows.pop(i, None)  # a whole slot and more
    rows[5000] = (5000, "late row in a slot of its own", float("nan"), None)
    source = frame(spark, list(rows.values())).repartition(4)
    done = repair(target, "t", source, parts=parts)
    rows[5000] = (5000, "late row in a slot of its own", None, None)
    assert content(target.read("t")) == sorted(rows.values(), key=repr)
    assert done.slots > 1 and done.fetched < len(rows)
    assert repair(target, "t", source, parts=parts) == repairing.Repaired(0, 0, 0)


def test_more_slots_than_a_batch_holds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repairing, "FEW_SLOTS", 3)
    monkeypatch.setattr(repairing, "FEW_INTERVALS", 1)
    monkeypatch.setattr(repairing, "PARTS", 2)
    rows = some_rows(400, random.Random(1))
    target = replicated(spark, tmp_path, rows)
    for i in range(0, 400, 40):
        del rows[i]
    assert repair(target, "t", frame(spark, list(rows.values()))).slots == 8
    assert content(target.read("t")) == sorted(rows.values(), key=repr)


def test_equal_ranges_are_not_read(spark, tmp_path):
    """Of a source in many files only those of differing ranges are opened for rows."""
    rows = some_rows(2000, random.Random(2))
    target = replicated(spark, tmp_path / "replica", rows, slot_rows=100)
    del rows[1234]
    path = str(tmp_path / "source")
    frame(spark, list(rows.values())).repartitionByRange(40, "id").sortWithinPartitions("id").write.parquet(path)
    source = spark.read.parquet(path)
    found = differing_ranges(target.read("t"), source, "id", 100)
    assert [r[0] for r in found.collect()] == [12]
    asked = within(source, "id", 100, found)
    assert asked.count() == 99
    plan = asked._jdf.queryExecution().executedPlan()
    assert "GreaterThanOrEqual(id,1200), LessThan(id,1300)" in plan.toString()
    leaf = plan.collectLeaves().apply(0)
    asked._jdf.queryExecution().toRdd().count()
    assert leaf.metrics().apply("numOutputRows").value() < 250
    assert repair(target, "t", source, parts=10) == repairing.Repaired(1, 1, 9)


def test_digests_tell_null_from_its_neighbour_and_repeats_from_none(spark):
    a = frame(spark, [(1, None, 1.0, None), (2, "x", None, T0)])
    b = frame(spark, [(1, "x", 1.0, None), (2, None, None, T0)])
    assert differing_ranges(a, b, "id", 10).count() == 1
    assert differing_ranges(a, a.repartition(2), "id", 10).count() == 0
    twice = a.union(a).union(a)
    assert differing_ranges(a, twice, "id", 10).count() == 1
    assert range_digests(a, "id", 2).count() == 2


def test_new_columns_empty_sides_and_refusals(spark, tmp_path):
    rows = some_rows(30, random.Random(3))
    target = replicated(spark, tmp_path, rows)
    wider = frame(spark, list(rows.values())).withColumn("added", F.col("id") * 2)
    repair(target, "t", wider)
    assert content(target.read("t")) == content(wider)
    with pytest.raises(ValueError, match="has no id"):
        repair(target, "t", frame(spark, [(None, "a", 1.0, T0)]))
    with pytest.raises(LookupError):
        repair(target, "never", wider)
    repair(target, "t", wider.limit(0))
    assert target.read("t").count() == 0 and target.read("t").columns == wider.columns
    repair(target, "t", wider)
    assert content(target.read("t")) == content(wider)


def test_a_write_in_between_is_refused(spark, tmp_path, monkeypatch):
    rows = some_rows(100, random.Random(4))
    target = replicated(spark, tmp_path, rows)
    del rows[50]
    once = Replica.replace

    def late(self, table, *rest):
        monkeypatch.setattr(Replica, "replace", once)
        self.merge(table, frame(spark, [(7, "meanwhile", 1.0, T0 + timedelta(days=999))]))
        return once(self, table, *rest)

    monkeypatch.setattr(Replica, "replace", late)
    with pytest.raises(ConcurrentWrite):
        repair(target, "t", frame(spark, list(rows.values())))
    assert target.read("t").where("id = 7").head().name == "meanwhile"


def test_intervals_are_joined_where_they_touch():
    assert list(intervals([5, 3, 4, 9], 10)) == [(30, 60), (90, 100)]
    assert list(intervals([], 10)) == [] and list(intervals([-1, 0], 5)) == [(-5, 5)]
