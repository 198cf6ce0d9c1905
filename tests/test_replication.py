from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.changes import changed_rows, latest_per_key, upsert_merge
from tallyloom.operators.watermark import Watermark
from tallyloom.plans import replica as reports
from tallyloom.plans.replicate import ConcurrentWrite, Replica, replicate, replicated_erp
from tallyloom.sources.cleaning import nan_to_null
from tallyloom.sources.schemas import ERP_TABLES
from tallyloom.streaming.changes import stream_changes
from tests import literal

DDL = "id BIGINT, name STRING, rate DOUBLE, write_date TIMESTAMP_NTZ"
T0 = datetime(2024, 1, 1)


def day(n):
    return T0 + timedelta(days=n)


def table(spark, *rows):
    return spark.createDataFrame([(i, name, 1.0, written) for i, name, written in rows], DDL)


def content(df):
    return {r["id"]: r["name"] for r in df.collect()}


def test_row_written_at_the_cutoff_is_not_extracted(spark):
    source = table(spark, (1, "a", day(1)), (2, "b", day(1) + timedelta(microseconds=1)), (3, "c", None))
    assert content(changed_rows(source, day(1))) == {2: "b"}
    assert content(changed_rows(source, None)) == {1: "a", 2: "b", 3: "c"}


def test_delta_applied_twice_changes_nothing(spark):
    base = table(spark, (1, "a", day(1)), (2, "b", day(1)), (3, "c", day(1)))
    delta = table(spark, (2, "B", day(2)), (4, "d", day(2)))
    once = upsert_merge(base, delta, ["id"])
    expected = {1: "a", 2: "B", 3: "c", 4: "d"}
    assert content(once) == expected
    twice = upsert_merge(once, delta, ["id"])
    assert twice.count() == 4 and content(twice) == expected
    assert twice.columns == base.columns


@pytest.mark.parametrize(
    "old, new, winner",
    [
        (day(2), day(1), "old"),
        (day(1), day(1), "new"),
        (None, day(1), "new"),
        (day(1), None, "old"),
        (None, None, "new"),
    ],
)
def test_newer_write_date_wins_and_ties_go_to_the_delta(spark, old, new, winner):
    merged = upsert_merge(table(spark, (1, "old", old)), table(spark, (1, "new", new)), ["id"])
    assert content(merged) == {1: winner}


def test_newest_of_many_versions(spark):
    delta = table(spark, *[(1, f"v{n}", day(n)) for n in range(50)], (2, "x", None))
    assert content(latest_per_key(delta, ["id"], ["write_date"])) == {1: "v49", 2: "x"}


def test_new_columns_are_null_in_older_rows(spark):
    base = table(spark, (1, "a", day(1)), (2, "b", day(1)))
    delta = table(spark, (2, "B", day(2))).withColumn("extra", F.lit(7)).drop("rate")
    merged = {r["id"]: (r["name"], r["rate"], r["extra"]) for r in upsert_merge(base, delta, ["id"]).collect()}
    assert merged == {1: ("a", 1.0, None), 2: ("B", None, 7)}


def test_nan_becomes_null_and_types_stay(spark):
    df = spark.sql("select cast('NaN' as double) d, cast('NaN' as float) f, 1.5D g, 'NaN' s, 3 i")
    cleaned = nan_to_null(df)
    assert cleaned.dtypes == df.dtypes
    assert tuple(cleaned.first()) == (None, None, 1.5, "NaN", 3)


def versions(tmp_path, name="t"):
    found = {}
    for path in (tmp_path / "tables" / name).rglob("*.parquet"):
        found.setdefault(path.parent.parent.name, set()).add(path.parent.name)
    return found


def test_merge_rewrites_touched_slots_only(spark, tmp_path):
    replica = Replica(spark, str(tmp_path), slot_rows=10)
    replica.merge("t", table(spark, *[(i, "a", day(1)) for i in range(60)]))
    before = versions(tmp_path)
    assert set(before) == {f"slot={n}" for n in range(6)}
    replica.merge("t", table(spark, (3, "b", day(2)), (1000, "n", day(2))))
    assert content(replica.read("t")) == {**{i: "a" for i in range(60)}, 3: "b", 1000: "n"}
    after = versions(tmp_path)
    assert {s for s in after if after[s] != before.get(s)} == {"slot=0", "slot=100"}


def test_slots_grow_with_ids_and_a_small_batch_reads_one(spark, tmp_path):
    replica = Replica(spark, str(tmp_path), slot_rows=10)
    written = F.lit("2024-01-01").cast("timestamp_ntz").alias("write_date")
    replica.merge("t", spark.range(3000).select("id", F.lit("a").alias("name"), F.lit(1.0).alias("rate"), written))
    assert len(versions(tmp_path)) == 300
    read = []
    rows = Replica._rows
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(Replica, "_rows", lambda *args: read.append(rows(*args)) or read[-1])
        replica.merge("t", table(spark, (1234, "b", day(2))))
    assert read[0].count() == 10
    assert replica.read("t").count() == 3000 and content(replica.read("t").where("id = 1234")) == {1234: "b"}


def test_more_slots_than_are_named_in_a_filter(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyloom.plans.replicate.FEW_SLOTS", 2)
    replica = Replica(spark, str(tmp_path), slot_rows=10)
    for n in range(3):
        replica.merge("t", table(spark, *[(i, f"v{n}", day(n)) for i in range(50)]))
        assert content(replica.read("t")) == {i: f"v{n}" for i in range(50)}
    assert all(len(v) == 2 for v in versions(tmp_path).values())


def test_storage_stays_bounded_and_the_newest_version_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyloom.plans.replicate.FOLD_EVERY", 4)
    replica = Replica(spark, str(tmp_path), slot_rows=10)
    for n in range(11):
        replica.merge("t", table(spark, (1, f"v{n}", day(n)), *[(15, f"w{n}", day(n))] * (n < 2)))
        assert content(replica.read("t")) == {1: f"v{n}", 15: f"w{min(n, 1)}"}
    assert all(len(v) <= 2 for v in versions(tmp_path).values())
    assert len(list((tmp_path / "commits" / "t").iterdir())) <= 5


def test_layout_is_kept_with_the_table(spark, tmp_path):
    rows = [(i, "a", day(1)) for i in range(100)]
    Replica(spark, str(tmp_path), slot_rows=8).merge("t", table(spark, *rows))
    with pytest.raises(ValueError, match="8 rows a slot"):
        Replica(spark, str(tmp_path), slot_rows=16).merge("t", table(spark, *rows[:20]))
    with pytest.raises(ValueError, match="key id"):
        Replica(spark, str(tmp_path), key="rate").merge("t", table(spark, *rows[:20]).withColumn("rate", F.lit(1)))
    Replica(spark, str(tmp_path)).merge("t", table(spark, *rows[:20]))
    assert Replica(spark, str(tmp_path)).read("t").count() == 100


def test_missing_and_textual_keys_are_refused(spark, tmp_path):
    replica = Replica(spark, str(tmp_path), slot_rows=10)
    replica.merge("t", table(spark, (1, "a", day(1))))
    with pytest.raises(ValueError, match="has no id"):
        replica.merge("t", table(spark, (2, "b", day(2)), (None, "lost", day(2))))
    with pytest.raises(TypeError, match="must be an integer"):
        Replica(spark, str(tmp_path), key="name").merge("u", table(spark, (1, "a", day(1))))
    assert content(replica.read("t")) == {1: "a"}


def test_equal_write_dates_give_the_same_row_every_time(spark, tmp_path):
    rows = table(spark, *[(1, f"v{n:02}", day(1)) for n in range(40)])
    found = set()
    for n in (1, 5, 9):
        replica = Replica(spark, str(tmp_path / str(n)))
        replica.merge("t", rows.repartition(n))
        replica.merge("t", rows.repartition(n + 1))
        found.add(replica.read("t").first()["name"])
    assert found == {"v39"}


def test_second_of_two_writers_fails_and_loses_nothing(spark, tmp_path, monkeypatch):
    first, second = Replica(spark, str(tmp_path), slot_rows=10), Replica(spark, str(tmp_path), slot_rows=10)
    first.merge("t", table(spark, (1, "a", day(1))))
    commit = Replica._commit

    def interrupted(self, *args):
        monkeypatch.setattr(Replica, "_commit", commit)
        first.merge("t", table(spark, (1, "first", day(2)), (2, "first", day(2))))
        commit(self, *args)

    monkeypatch.setattr(Replica, "_commit", interrupted)
    with pytest.raises(ConcurrentWrite):
        second.merge("t", table(spark, (1, "second", day(3))))
    assert content(first.read("t")) == {1: "first", 2: "first"}
    second.merge("t", table(spark, (1, "second", day(3))))
    assert content(first.read("t")) == {1: "second", 2: "first"}


def test_leftover_of_a_writer_that_died_committing(spark, tmp_path):
    replica = Replica(spark, str(tmp_path), slot_rows=10)
    replica.merge("t", table(spark, (1, "a", day(1))))
    (tmp_path / "commits" / "t" / "seq=2" / "_temporary").mkdir(parents=True)
    replica.merge("t", table(spark, (1, "b", day(2))))
    assert content(replica.read("t")) == {1: "b"}


def test_empty_source_and_new_column(spark, tmp_path):
    replica, mark = Replica(spark, str(tmp_path)), Watermark(spark, str(tmp_path / "mark"))
    empty = table(spark, (1, "a", day(1))).where("id > 5")
    replicate(replica, {"t": empty}, mark, now=day(1))
    assert replica.read("t").count() == 0 and replica.read("t").dtypes == empty.dtypes
    replicate(replica, {"t": table(spark, (1, "a", day(2)), (2, "b", day(2)))}, mark, now=day(3))
    wider = table(spark, (2, "B", day(4)), (3, "c", day(4))).withColumn("extra", F.lit("x"))
    replicate(replica, {"t": wider}, mark, now=day(5))
    assert sorted((r["id"], r["name"], r["extra"]) for r in replica.read("t").collect()) == [
        (1, "a", None), (2, "B", "x"), (3, "c", "x"),
    ]
    assert mark.read() == day(5)


def test_watermark_follows_its_number_and_not_the_clock(spark, tmp_path, monkeypatch):
    mark = Watermark(spark, str(tmp_path / "mark"))
    monkeypatch.setattr("tallyloom.operators.watermark.utc_now", lambda: day(0))
    for n in (5, 6, 4, 9):
        mark.advance(day(n))
        monkeypatch.setattr("tallyloom.operators.watermark.utc_now", lambda n=n: day(-n))
        assert mark.read() == day(n)
    assert len(list((tmp_path / "mark").rglob("*.parquet"))) == 2


def test_merge_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    replica = Replica(spark, str(tmp_path), slot_rows=10)
    replica.merge("t", table(spark, (1, "a", day(1)), (2, "b", day(1))))
    delta = table(spark, (1, "X", day(2)))
    with monkeypatch.context() as patched:
        patched.setattr(spark, "createDataFrame", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            replica.merge("t", delta)
    assert content(replica.read("t")) == {1: "a", 2: "b"}
    replica.merge("t", delta)
    assert content(replica.read("t")) == {1: "X", 2: "b"}


def test_unknown_table(spark, tmp_path):
    with pytest.raises(LookupError):
        Replica(spark, str(tmp_path)).read("t")


def test_negative_ids_and_empty_batches(spark, tmp_path):
    replica = Replica(spark, str(tmp_path), slot_rows=10)
    replica.merge("t", table(spark, (-7, "a", day(1)), (7, "b", day(1))))
    replica.merge("t", table(spark, (1, "x", day(1))).where("id < 0"))
    assert content(replica.read("t")) == {-7: "a", 7: "b"}


def test_replication_reads_on_from_the_watermark(spark, tmp_path):
    replica, mark = Replica(spark, str(tmp_path)), Watermark(spark, str(tmp_path / "mark"))
    assert mark.read() is None
    replicate(replica, {"t": table(spark, (1, "a", day(1)))}, mark, now=day(5))
    assert mark.read() == day(5)
    late = table(spark, (1, "ignored", day(4)), (2, "b", day(6)))
    replicate(replica, {"t": late}, mark, now=day(9))
    assert content(replica.read("t")) == {1: "a", 2: "b"}
    assert mark.read() == day(9)
    replicate(replica, {"t": late}, mark, now=day(10))
    assert content(replica.read("t")) == {1: "a", 2: "b"}


def test_watermark_is_taken_before_reading(spark, tmp_path):
    replica, mark = Replica(spark, str(tmp_path)), Watermark(spark, str(tmp_path / "mark"))
    clock_of_the_scan = F.expr("convert_timezone('UTC', localtimestamp())")
    source = table(spark, (1, "a", day(1))).withColumn("write_date", clock_of_the_scan)
    cutoff = replicate(replica, {"t": source}, mark)
    assert mark.read() == cutoff and cutoff <= replica.read("t").first()["write_date"]


def test_failing_table_leaves_the_watermark(spark, tmp_path):
    replica, mark = Replica(spark, str(tmp_path)), Watermark(spark, str(tmp_path / "mark"))
    replicate(replica, {"good": table(spark, (1, "a", day(1)))}, mark, now=day(1))
    broken = table(spark, (1, "a", day(3))).withColumn("name", F.raise_error(F.lit("source is gone")).cast("string"))
    with pytest.raises(Exception, match="source is gone"):
        replicate(replica, {"good": table(spark, (2, "b", day(3))), "bad": broken}, mark, now=day(4))
    assert mark.read() == day(1)
    replicate(replica, {"good": table(spark, (2, "b", day(3)))}, mark, now=day(5))
    assert content(replica.read("good")) == {1: "a", 2: "b"}


def test_stream_keeps_newer_rows_whatever_the_order(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "replica"), slot_rows=10)
    folder = str(tmp_path / "in")

    def run():
        query = stream_changes(
            spark, folder, table(spark, (1, "a", day(1))).schema, replica, "t", str(tmp_path / "cp"), files_per_batch=1
        )
        query.awaitTermination()
        return query

    table(spark, (1, "new", day(5)), (2, "b", day(5))).coalesce(1).write.mode("append").parquet(folder)
    run()
    table(spark, (1, "old", day(2)), (3, "c", day(2))).coalesce(1).write.mode("append").parquet(folder)
    run()
    assert content(replica.read("t")) == {1: "new", 2: "b", 3: "c"}
    run()
    assert content(replica.read("t")) == {1: "new", 2: "b", 3: "c"}


def test_all_tables_are_replicated_and_reported_on(spark, tmp_path):
    row = (1, 1, 1, 1, 7, literal.money(5), literal.money(0), literal.money(0), literal.JAN, literal.JAN)
    data = literal.erp(spark, move_lines=[row])
    sources = {
        name: df if "write_date" in df.columns else df.withColumn("write_date", F.lit(day(1)).cast("timestamp_ntz"))
        for name, df in ((ERP_TABLES[table], getattr(data, table)) for table in ERP_TABLES)
        if name in ("account_move_line", "account_account", "res_company", "res_partner")
    }
    target = Replica(spark, str(tmp_path))
    replicate(target, sources, Watermark(spark, str(tmp_path / "mark")))
    names = {table: name for table, name in ERP_TABLES.items() if name in sources}
    report = reports.company_account_balance(replicated_erp(target, names))
    assert literal.rows(report) == literal.rows(reports.company_account_balance(data))


def test_large_merges_give_what_comparing_whole_rows_gives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyloom.plans.replicate.LARGE_MERGE", -1)
    rng = random.Random(3)
    replica, plain = Replica(spark, str(tmp_path), slot_rows=30_000), None
    some_day = lambda: rng.choice([None, day(1), day(2), day(3)])
    for n in range(4):
        rows = [(rng.randrange(-40, 40) * 1_000 + rng.randrange(3), f"{n}-{k}", some_day()) for k in range(150)]
        batch = table(spark, *rows)
        if n == 2:
            batch = batch.withColumn("extra", F.lit("x")).drop("rate")
        replica.merge("t", batch)
        plain = latest_per_key(batch, ["id"], ["write_date"]) if plain is None else upsert_merge(plain, batch, ["id"])
        found = replica.read("t")
        assert Counter(found.select(*plain.columns).collect()) == Counter(plain.collect())


def test_rows_of_a_large_merge_that_need_no_comparing_are_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyloom.plans.replicate.LARGE_MERGE", -1)
    replica, merged, write = Replica(spark, str(tmp_path), slot_rows=1_000), [], Replica._write
    monkeypatch.setattr(Replica, "_write", lambda self, name, rows, *rest: merged.append((rows, rest[1])) or write(self, name, rows, *rest))
    for n in range(3):
        rows = spark.range(n * 2_000, 6_000).select("id", F.lit(f"v{n}").alias("name"), F.lit(day(n)).cast("timestamp_ntz").alias("write_date"))
        replica.merge("t", rows)
        plan = merged[-1][0]._jdf.queryExecution().executedPlan().toString()
        assert merged[-1][1] and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert replica.read("t").groupBy("name").count().collect() and replica.read("t").count() == 6_000
    # Batches dealt out over all slots are brought together by slot.
    replica.merge("t", spark.range(6_000).select("id", F.lit("w").alias("name"), F.lit(day(9)).cast("timestamp_ntz").alias("write_date")).repartition(20))
    assert not merged[-1][1] and {r["name"] for r in replica.read("t").collect()} == {"w"}
