"""Codes compared as the source databases compare them: joins, criteria, groups and what reaches the files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.criteria import any_of, contains, differs_from, excluding, one_of, starts_with
from tallyloom.operators.journal import stage_journal
from tallyloom.plans import balances, lines
from tallyloom.registry import _spelled
from tallyloom.sources.cleaning import stage_ledger
from tallyloom.sources.collation import DATABASE, Collation, collate_ledger
from tallyloom.sources.ledger import Ledger
from tests import literal
from tests.literal import header, ledger, line

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def mixed(spark):
    """Lines whose codes differ from those of headers and dimensions in case and trailing blanks."""
    rows = [
        line(num="v1 ", dga="03-A", pct="Ab-1", cc="Cc-1", debe=10),
        line(num="V1", dga="03-a ", pct="aB-1  ", cc="cC-1", debe=5),
        line(num="v2", dga="03-a", pct="AB-1", cc="CC-1 ", haber=2),
        line(num="v2", dga=None, pct="AB-1", cc="CC-1 ", haber=1),
        line(num="v3", dga="03 a", pct="AB-1", cc="CC-1", debe=100),
    ]
    return ledger(
        spark,
        lines=rows,
        headers=[header(num="V1  ", est="v"), header(num="V2", est="V ")],
        centers=[("cc-1", "Centre")],
        details=[("03-A  ", "Wages")],
        accounts=[("AB-1", "Spending")],
    )


def shown(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_joins_and_filters_ignore_case_and_trailing_blanks(mixed):
    report = lines.payroll_lines(collate_ledger(mixed), details=starts_with("03-a"), accounts="ab-1 ", centers=["CC-1"])
    assert shown(report, "dgacod", "pctcod", "saldo") == [("03-A", "Ab-1", 10.0), ("03-a", "AB-1", -2.0), ("03-a ", "aB-1  ", 5.0)]
    assert lines.payroll_lines(mixed, details=starts_with("03-a")).count() == 0


@pytest.mark.parametrize(
    ("criterion", "found"),
    [
        (one_of("03-A   "), 3),
        (["03-a", None], 3),
        (any_of("x", "03-A"), 3),
        (excluding("03-A"), 0),
        (excluding("03-b"), 3),
        (differs_from("03-a "), 0),
        (starts_with("03-A "), 0),
        (contains("3-A"), 3),
        (lambda column: column == "03-a", 1),
        (None, 3),
    ],
)
def test_criteria(mixed, criterion, found):
    assert lines.payroll_lines(collate_ledger(mixed), details=criterion).count() == found


def test_groups_take_spellings_together(mixed):
    balance = balances.account_month_balance(collate_ledger(mixed))
    assert shown(balance, "mes", "gastos", "codigo") == [("01", 12.0, "AB-1")]
    costs = balances.import_costs(collate_ledger(mixed), accounts="ab-1", centers="cc-1", details="03-A")
    assert shown(costs, "gastos", "cc", "dgacod") == [(13.0, "CC-1 ", "03-A")]
    both = balances.spent_vs_billed(collate_ledger(mixed), spent="AB-1", billed="none", single_pass=False)
    assert shown(both, "gastos_afectos", "facturado_neto") == [(13.0, 0.0)]


def test_case_alone_or_blanks_alone(mixed):
    assert lines.payroll_lines(collate_ledger(mixed, Collation(ignore_case=False)), posted_only=False, details="03-a").count() == 0
    blanks_count = collate_ledger(mixed, Collation(ignore_trailing=False))
    assert lines.payroll_lines(blanks_count, posted_only=False).count() == 0


def test_staged_keys_are_read_back_and_codes_that_are_numbers_have_none(spark, mixed, tmp_path):
    staged = stage_ledger(mixed, str(tmp_path), DATABASE)
    assert "pctcod_key" in staged.lines.columns and "movglosa_key" not in staged.lines.columns
    names = {name: name for name in ("cwmovim", "cwcpbte")}
    folder = next(tmp_path.glob("version-*"))
    again = Ledger.read(spark, str(folder), {"lines": names["cwmovim"], "headers": names["cwcpbte"]}, collation=DATABASE)
    assert shown(balances.account_month_balance(again), "gastos", "codigo") == [(12.0, "AB-1")]
    numbers = collate_ledger(literal.ledger(spark).with_tables(centers=spark.createDataFrame([(1, "one")], "codicc int, desccc string")))
    assert "codicc_key" not in numbers.centers.columns


def test_code_filters_reach_the_files(spark):
    staged = _spelled(spark, FOLDER)
    report = lines.expense_detail(staged, details=any_of(starts_with("Nation_1"), one_of("nAtIoN_2  ")))
    text = report._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in text.splitlines() if "cwmovim" in x and "PushedFilters" in x)
    assert "Or(StringStartsWith(dgacod_key,nation_1),EqualTo(dgacod_key,nation_2))" in scan
    posted = balances.account_month_balance(staged)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(cpbest_key,f)" in next(x for x in posted.splitlines() if "cwcpbte" in x and "PushedFilters" in x)


def test_a_staged_journal_keeps_its_keys(mixed, tmp_path):
    staged = stage_journal(collate_ledger(mixed), str(tmp_path))
    assert shown(balances.account_month_balance(staged), "gastos", "codigo") == [(12.0, "AB-1")]
    assert lines.payroll_lines(staged, details="03-a").count() == 3


def test_companies_of_different_collations_are_refused(mixed):
    with pytest.raises(ValueError, match="collations"):
        Ledger.combine({"a": mixed, "b": collate_ledger(mixed)})
    both = Ledger.combine({"a": collate_ledger(mixed), "b": collate_ledger(mixed)})
    assert balances.account_month_balance(both).where(F.col("codigo") == "AB-1").count() == 2
