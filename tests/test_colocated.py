"""Lines and headers in equal buckets, and criteria that are tables: plans, hot vouchers and rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.criteria import any_of, excluding, listed
from tallyloom.operators.colocated import colocated_ledger, stage_colocated
from tallyloom.operators.journal import journal, stage_journal
from tallyloom.plans import balances, lines
from tallyloom.registry import listed_accounts
from tallyloom.sources import standin
from tallyloom.sources.collation import collate_ledger
from tests.literal import header, ledger, line, rows
from tests.test_plans import NO_BROADCAST, physical, settings

FOLDER = "/root/testdata/sf0.001"


def below_join(text: str) -> list[str]:
    """The lines of a plan below its first join."""
    found = text.splitlines()
    at = next(i for i, x in enumerate(found) if "SortMergeJoin" in x)
    depth = re.search(r"[A-Z*]", found[at]).start()
    below = []
    for x in found[at + 1 :]:
        if re.search(r"[A-Z*]", x) and re.search(r"[A-Z*]", x).start() <= depth:
            break
        below.append(x)
    return below


def test_no_exchange_below_the_join(spark, tmp_path):
    source = standin.ledger(spark, FOLDER)
    with settings(spark, **NO_BROADCAST):
        staged = stage_colocated(source, str(tmp_path), buckets=6)
        report = balances.account_month_balance(staged)
        text = physical(report)
        assert "Exchange" not in "\n".join(below_join(text)) and "Bucketed: true" in text
        assert "EqualTo(cpbest,F)" in text
        assert "Exchange" in "\n".join(below_join(physical(balances.account_month_balance(source))))
        assert rows(report) == rows(balances.account_month_balance(source))


def test_opened_again_and_staged_again(spark, tmp_path):
    source = standin.ledger(spark, FOLDER)
    first = stage_colocated(source, str(tmp_path), buckets=3)
    stage_colocated(source.with_tables(lines=source.lines.where("cpbano = 1996")), str(tmp_path), buckets=5)
    again = colocated_ledger(source, str(tmp_path))
    assert {r.ano for r in balances.account_month_balance(again).collect()} == {1996}
    assert rows(balances.account_month_balance(first)) == rows(balances.account_month_balance(source))
    with pytest.raises(LookupError):
        colocated_ledger(source, str(tmp_path / "elsewhere"))


def test_a_hot_voucher_is_kept_out_of_the_buckets(spark, tmp_path):
    many = [line(num="hot", pct="5-1", debe=1, movglosa=str(i)) for i in range(300)]
    cold = [line(num=str(n), pct="4-1", haber=2) for n in range(60)]
    odd = [line(num=None, debe=1000), line(num="none such", debe=1000)]
    books = ledger(spark, lines=many + cold + odd, headers=[header(num="hot"), *(header(num=str(n)) for n in range(60))])
    staged = stage_colocated(books, str(tmp_path), buckets=4, hot_lines=100)
    folder = next(tmp_path.glob("version-*"))
    counts = [f for f in spark.read.parquet(str(folder / "lines")).groupBy(F.input_file_name()).count().collect()]
    assert max(r["count"] for r in counts) < 40
    assert spark.read.parquet(str(folder / "hot-lines")).count() == 300
    assert rows(journal(staged).select(*journal(books).columns)) == rows(journal(books))
    assert rows(balances.account_month_balance(staged)) == [("01", 2020, -120.0, "4-1"), ("01", 2020, 300.0, "5-1")]


def test_collated_codes_meet_in_their_buckets(spark, tmp_path):
    books = ledger(spark, lines=[line(num="a1 ", debe=3), line(num="A1", debe=4)], headers=[header(num="A1   ")])
    staged = stage_colocated(collate_ledger(books), str(tmp_path), buckets=4)
    assert balances.account_month_balance(staged).head()["gastos"] == 7.0


def test_a_list_prunes_years_and_rows(spark, tmp_path):
    staged = stage_journal(standin.ledger(spark, FOLDER), str(tmp_path))
    chosen = listed(listed_accounts(spark, FOLDER), "code", cpbano="year")
    text = physical(balances.voucher_balance(staged, accounts=chosen))
    assert re.search(r"PartitionFilters: \[.*dynamicpruningexpression\(cpbano", text)
    with settings(
        spark,
        **NO_BROADCAST,
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
        spark__sql__optimizer__runtime__bloomFilter__enabled="true",
    ):
        text = physical(balances.voucher_balance(staged, accounts=listed(chosen.frame, "code")))
    assert "might_contain" in text and "bloom_filter_agg" in text


def test_lists_repeat_codes_hold_nulls_and_can_be_negated(spark):
    books = ledger(spark, lines=[line(dga="03-1", debe=1), line(dga="05-1", debe=2), line(dga=None, debe=4)])
    some = spark.createDataFrame([("03-1", 2020), ("03-1", 2020), (None, 2020), ("05-1", 1999)], "detail string, y int")
    found = lambda criterion: sorted(r.saldo for r in lines.payroll_lines(books, details=criterion).collect())
    assert found(listed(some, "detail")) == [1.0, 2.0]
    assert found(listed(some, "detail", cpbano="y")) == [1.0]
    assert found(excluding(listed(some.where("y = 2020"), "detail"))) == [2.0]
    assert found(excluding(excluding(listed(some.where("y = 2020"), "detail")))) == [1.0]
    assert found(listed(some.limit(0), "detail")) == []
    spelled = spark.createDataFrame([("03-1  ",)], "detail string")
    assert [r.saldo for r in lines.payroll_lines(collate_ledger(books), details=listed(spelled, "detail")).collect()] == [1.0]
    with pytest.raises(TypeError, match="join"):
        lines.payroll_lines(books, details=any_of("05-1", listed(some, "detail")))
