"""Shape of the physical plans: what reaches the scan, what is shuffled, and how hot keys are split."""

from __future__ import annotations

import re
from collections import Counter
from contextlib import contextmanager
from dataclasses import replace
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyloom.functions.criteria import starts_with
from tallyloom.operators.changes import changed_rows, latest_per_key
from tallyloom.operators.journal import journal, stage_journal, staged_journal
from tallyloom.operators.snapshots import SnapshotStore
from tallyloom.operators.sorting import newest_first
from tallyloom.plans import balances, lines, replica
from tallyloom.plans.replicate import Replica
from tallyloom.registry import QUERIES
from tallyloom.session import sized_shuffles
from tallyloom.sources import standin
from tallyloom.sources.jdbc import jdbc_options
from tallyloom.sources.ledger import Ledger
from tests import literal
from tests.literal import erp, ledger, line

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    values = {key.replace("__", "."): value for key, value in values.items()}
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_tables_or_runs_python(spark, name):
    text = physical(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "FlatMapGroups" not in text


def test_posted_filter_and_columns_reach_the_scan(spark):
    text = physical(balances.account_month_balance(standin.ledger(spark, FOLDER)))
    assert "EqualTo(o_orderstatus,F)" in text
    header_scan = next(line for line in text.splitlines() if "orders.parquet" in line)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in header_scan


def test_year_is_a_range_on_the_date_column(spark):
    text = physical(replica.income_statement_year(standin.erp(spark, FOLDER), year=1999))
    assert "GreaterThanOrEqual(l_shipdate,1999-01-01T00:00)" in text and "LessThan(l_shipdate,2000-01-01T00:00)" in text


def test_cutoff_reaches_the_scan(spark):
    events = standin.table(spark, FOLDER, "events")
    assert "GreaterThan(ts,2024-01-20T00:00)" in physical(changed_rows(events, datetime(2024, 1, 20), "ts"))


def test_grouping_filter_sits_below_the_sum(spark):
    text = physical(replica.cash_basis_balance(standin.erp(spark, FOLDER), accounts=[16, 50]))
    assert "In(l_partkey, [16,50])" in text


def test_staged_journal_is_pruned_by_company_and_year(spark, tmp_path):
    data = ledger(spark, [line(debe=1), line(cpbano=2021, debe=2)])
    staged = stage_journal(Ledger.combine({"a": data, "b": data}), str(tmp_path / "j"))
    report = lines.payroll_lines(staged, details=starts_with("03")).where("company = 'a' and ano = 2020")
    text = physical(report)
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "company" in partition_filters and "cpbano" in partition_filters
    assert "StringStartsWith(dgacod,03)" in text and "EqualTo(cpbest,V)" in text


def test_one_pass_reads_lines_and_headers_once(spark):
    params = {"spent": "1-1-00", "billed": "3-3-02"}
    data = standin.ledger(spark, FOLDER)
    text = physical(balances.spent_vs_billed(data, **params))
    assert text.count("lineitem.parquet") == 1 and text.count("orders.parquet") == 1
    apart = physical(balances.spent_vs_billed(data, **params, single_pass=False))
    assert apart.count("lineitem.parquet") == 2


def test_erp_sums_shuffle_partial_sums_only(spark):
    """The exchange next to the large table follows a partial sum, even when no dimension can be broadcast."""
    with settings(spark, **NO_BROADCAST):
        text = physical(replica.company_account_balance(standin.erp(spark, FOLDER)))
    above = text[: text.index("lineitem.parquet")].splitlines()[::-1]
    first_exchange = next(i for i, row in enumerate(above) if "Exchange" in row)
    assert any("partial_sum" in row for row in above[:first_exchange])


def test_large_dimensions_are_shuffled_not_broadcast(spark):
    with settings(spark, **NO_BROADCAST, spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        report = lines.expense_detail(standin.ledger(spark, FOLDER))
        rows = report.count()
        assert "Broadcast" not in physical(report)
    assert rows == lines.expense_detail(standin.ledger(spark, FOLDER)).count()


def test_versions_are_cut_before_the_shuffle(spark):
    events = standin.table(spark, FOLDER, "events")
    text = physical(latest_per_key(events, ["user_id"], ["ts"]))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def hot_voucher(spark, count=60_000):
    """A third of all lines belong to one voucher."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    base = ledger(spark)
    ids = spark.range(0, count, numPartitions=8).withColumn("key", key)
    number = F.col("key").cast("string").alias("cpbnum")
    key_columns = [F.lit(2020).alias("cpbano"), number, F.lit("A").alias("areacod")]
    wide = F.repeat(F.md5(F.col("id").cast("string")), 4)
    journal_lines = ids.select(
        *key_columns, F.lit("01").alias("cpbmes"), F.lit("5-1").alias("pctcod"), F.lit("70-11").alias("cccod"),
        F.lit("03-1").alias("dgacod"), F.lit("101").alias("codaux"), F.lit("FV").alias("ttdcod"),
        F.lit("1").alias("numdoc"), F.lit(None).cast("timestamp_ntz").alias("movfe"),
        F.lit(None).cast("timestamp_ntz").alias("movfv"), F.lit("").alias("movtipdocref"),
        F.lit("").alias("movnumdocref"), F.lit(1).cast("decimal(18,2)").alias("movdebe"),
        F.lit(0).cast("decimal(18,2)").alias("movhaber"), wide.alias("movglosa"),
    )
    headers = ids.select(*key_columns).distinct().select(
        "*", F.lit("01").alias("cpbmes"), F.lit("T").alias("cpbtip"), F.lit("9").alias("cpbnui"),
        F.lit("V").alias("cpbest"), F.lit(None).cast("timestamp_ntz").alias("cpbfec"),
    )
    return base.with_tables(lines=journal_lines, headers=headers)


SKEW = {
    **NO_BROADCAST,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
}


def test_hot_voucher_is_split(spark):
    data = hot_voucher(spark)
    with settings(spark, **SKEW):
        rows = journal(data).select("cpbnum", "movglosa", "cpbtip")
        assert len(rows.collect()) == 60_000
        assert "skew=true" in physical(rows)


def test_hot_cost_center_is_split(spark):
    data = hot_voucher(spark)
    centers = spark.range(5000).select(
        F.when(F.col("id") == 0, F.lit("70-11")).otherwise(F.concat(F.lit("c"), F.col("id"))).alias("codicc"),
        F.lit("d").alias("desccc"),
    )
    mixed = data.lines.withColumn(
        "cccod",
        F.when(F.abs(F.hash("movglosa")) % 3 == 0, F.lit("70-11")).otherwise(
            F.concat(F.lit("c"), F.abs(F.hash("movglosa")) % 4999 + 1)
        ),
    )
    with settings(spark, **SKEW):
        report = lines.expense_detail_basic(data.with_tables(lines=mixed, centers=centers))
        assert len(report.collect()) == 60_000
        assert "skew=true" in physical(report)


def test_missing_products_are_split(spark):
    """A third of the invoice lines have no product; the left join must not gather them in one task."""
    ids = spark.range(0, 60_000, numPartitions=8)
    product = F.when(F.col("id") % 3 != 0, F.col("id"))
    text = F.concat(F.md5(F.col("id").cast("string")), F.md5(F.col("id").cast("string")))
    never = F.lit(None).cast("timestamp_ntz")
    data = erp(spark)
    data = replace(
        data,
        invoice_lines=ids.select(
            "id", text.alias("name"), F.lit(1).cast("bigint").alias("partner_id"), product.alias("product_id"),
            F.lit(1).cast("bigint").alias("invoice_id"), F.lit(1).cast("bigint").alias("company_id"),
            F.lit(1).cast("decimal(18,2)").alias("price_subtotal_signed"), F.lit(1.0).alias("quantity"),
            never.alias("write_date"),
        ),
        invoices=spark.range(1, 50_000).select("id", never.alias("date_invoice")),
        product_variants=ids.select("id", F.col("id").alias("product_tmpl_id")),
        product_templates=ids.select("id", F.lit("t").alias("name")),
    )
    with settings(spark, **SKEW):
        report = replica.product_movements(data)
        assert len(report.collect()) == 60_000
        text = physical(report)
    left_joins = [row for row in text.splitlines() if "LeftOuter" in row]
    assert left_joins and any("skew=true" in row for row in left_joins)


def test_hot_partition_is_written_as_several_files(spark, tmp_path):
    data = hot_voucher(spark)
    with settings(spark, **SKEW):
        stage_journal(data, str(tmp_path / "journal"))
    files = list((tmp_path / "journal").glob("version-*/cpbano=2020/*.parquet"))
    assert len(files) > 3


def test_replica_reads_current_partitions_only(spark, tmp_path):
    target = Replica(spark, str(tmp_path), slot_rows=10)
    written = F.lit("2024-01-01").cast("timestamp_ntz").alias("write_date")
    target.merge("t", spark.range(80).select("id", F.lit("a").alias("name"), written))
    target.merge("t", spark.range(5).select("id", F.lit("b").alias("name"), written))
    current = target.read("t")
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", physical(current)).group(1)
    assert "slot" in partition_filters and "version" in partition_filters
    assert current.count() == 80 and current.where("name = 'b'").count() == 5


def test_jdbc_scan_is_split_into_ranges():
    options = jdbc_options("jdbc:x", "select a from t", split_column="id", lower=0, upper=100, partitions=8)
    assert options["dbtable"] == "(select a from t) q" and "query" not in options
    assert (options["partitionColumn"], options["numPartitions"]) == ("id", "8")
    assert jdbc_options("jdbc:x", "select a from t")["query"] == "select a from t"
    assert jdbc_options("jdbc:x", "dbo.lines")["dbtable"] == "dbo.lines"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", split_column="id")


def sort_partitions(df):
    """The rows in each partition of the plan's last exchange, which deals out a sorted report."""
    return [n for n in df.rdd.glom().map(len).collect() if n]


@pytest.mark.parametrize("name", ["receivables", "issued_documents"])
def test_a_hot_voucher_is_split_in_the_sort(spark, name):
    """One voucher, date, counterparty and account holds every line, and half of the lines are equal throughout."""
    ids = spark.range(0, 40_000, 1, 8)
    hot = ids.select(
        *[F.lit(v).cast(t).alias(k) for k, v, t in (
            ("cpbano", 2020, "int"), ("cpbnum", "1", "string"), ("areacod", "A", "string"), ("cpbmes", "01", "string"),
            ("pctcod", "5-1", "string"), ("cccod", "70-11", "string"), ("dgacod", "03-1", "string"), ("codaux", "101", "string"),
            ("ttdcod", "FV", "string"),
        )],
        F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.lit(1)).cast("string").alias("movglosa"),
        F.lit(1).cast("decimal(18,2)").alias("movdebe"),
        F.lit(0).cast("decimal(18,2)").alias("movhaber"),
    )
    small = literal.ledger(spark, [literal.line()])
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in small.lines.schema.fields if f.name not in hot.columns]
    data = small.with_tables(lines=hot.select("*", *missing).select(*small.lines.columns))
    with settings(spark, **{"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        if name == "receivables":
            report = lines.receivables(data, accounts="5-1", counterparties="101")
        else:
            report = lines.issued_documents(data, vessel="v", counterparties="101")
        sizes = sort_partitions(report)
    assert sum(sizes) == 40_000 and max(sizes) < 20_000


def test_a_partitioned_snapshot_is_sorted_once_and_reads_in_order(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") % 3).alias("vessel"), (F.col("id") * 37 % 2000).alias("n"))
    store = SnapshotStore(spark, str(tmp_path))
    store.write("r", newest_first(rows, "n"), ["vessel"], [F.col("n").desc()])
    for vessel in range(3):
        for path in (tmp_path / "reports" / "r" / "a" / f"vessel={vessel}").glob("*.parquet"):
            found = [r["n"] for r in spark.read.parquet(str(path)).collect()]
            assert found == sorted(found, reverse=True) and found
    dealt = newest_first(rows, "n").hint("rebalance", "vessel").sortWithinPartitions("vessel")
    assert "rangepartitioning" not in physical(dealt)


def test_an_account_filter_skips_row_groups_of_the_staged_journal(spark, tmp_path):
    data = hot_voucher(spark)
    accounts = F.concat(F.lit("5-"), F.format_string("%03d", F.pmod(F.hash("movglosa"), F.lit(500))))
    data = data.with_tables(lines=data.lines.withColumn("pctcod", accounts))
    staged = stage_journal(data, str(tmp_path / "journal"))
    groups = []
    for path in (tmp_path / "journal").glob("version-*/cpbano=*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("pctcod")
        groups += [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
    pages = [s.min <= s.max for s in groups]
    assert pages and staged.journal.count() == data.lines.count()
    for path in (tmp_path / "journal").glob("version-*/cpbano=*/*.parquet"):
        codes = pq.read_table(path, columns=["pctcod"])["pctcod"].to_pylist()
        assert codes == sorted(codes)


def test_a_failed_restage_leaves_the_journal_readable(spark, tmp_path):
    data = literal.ledger(spark, [literal.line(debe=1)])
    path = str(tmp_path / "journal")
    first = stage_journal(data, path)
    broken = data.lines.withColumn("movdebe", F.raise_error(F.lit("source is gone")).cast("decimal(18,2)"))
    with pytest.raises(Exception, match="source is gone"):
        stage_journal(data.with_tables(lines=broken), path)
    assert first.journal.count() == 1 and staged_journal(data, path).journal.count() == 1
    stage_journal(literal.ledger(spark, [literal.line(debe=1), literal.line(debe=2)]), path)
    assert first.journal.count() == 1 and staged_journal(data, path).journal.count() == 2
    stage_journal(data, path)
    assert len(list((tmp_path / "journal").glob("version-*"))) <= 3
    with pytest.raises(LookupError):
        staged_journal(data, str(tmp_path / "none"))


def test_shuffles_are_sized_by_what_is_scanned(spark, tmp_path):
    rows = spark.range(200_000)
    rows.write.parquet(str(tmp_path / "t"))
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    table = spark.read.parquet(str(tmp_path / "t"))
    with sized_shuffles(table.join(table.withColumnRenamed("id", "x"), F.col("id") == F.col("x")), target_bytes=10_000) as n:
        assert n > 100 and spark.conf.get(key) == str(n)
    assert spark.conf.get(key, None) == before
    with sized_shuffles(table) as n:
        assert n == int(before or spark.conf.get("spark.sql.shuffle.partitions"))


def test_product_groups_are_dealt_out_for_products_once(spark):
    data = standin.erp(spark, "/root/testdata/sf0.001")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plan = physical(replica.product_movements(data))
    assert len(re.findall(r"Exchange \(\d+\)\n|Exchange hashpartitioning|Exchange rangepartitioning", plan)) > 0
    assert sum("hashpartitioning(product_id" in row for row in plan.splitlines() if row.startswith("Arguments")) <= 2
    assert sum("hashpartitioning(p_id" in row for row in plan.splitlines()) == 0


def test_lines_dealt_out_by_product_are_grouped_where_they_are(spark):
    data = standin.erp(spark, "/root/testdata/sf0.001")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plan = physical(replica.product_movements(data))
    dealt = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
    assert sum(keys.startswith("product_id") for keys in dealt) == 2
    assert not any("date_invoice" in keys for keys in dealt)


def test_repeated_product_rows_repeat_groups_and_sum_no_line_twice(spark):
    data = standin.erp(spark, "/root/testdata/sf0.001")
    twice = replace(data, product_variants=data.product_variants.union(data.product_variants))
    shown = ["id", "p_id", "producto", "orders", "monto", "cantidad", "last_order", "company_id", "ano", "producto_descripcion"]
    once, both = (Counter(map(tuple, replica.product_movements(e).select(*shown).collect())) for e in (data, twice))
    assert both == Counter({row: n if row[1] is None else 2 * n for row, n in once.items()})
