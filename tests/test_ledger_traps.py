"""Behaviour of the ledger reports on rows that are easy to get wrong."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.criteria import by_company, contains, excluding, more_than, one_of, starts_with
from tallyloom.functions.text import period_month, period_year, tail_name
from tallyloom.operators.journal import stage_journal
from tallyloom.plans import balances, lines, sales
from tallyloom.sources.cleaning import clean_ledger, stage_ledger
from tallyloom.sources.ledger import Ledger
from tests.literal import JAN, MAR, frame, header, ledger, line, money, rows


def test_unknown_or_missing_center_drops_the_line(spark):
    data = ledger(spark, [line(cc="99-99"), line(cc=None), line(debe=5)])
    assert rows(lines.expense_detail(data), "gastos") == [(5.0,)]


def test_missing_detail_is_absent_from_detail_report_only(spark):
    data = ledger(spark, [line(dga=None, debe=5), line(debe=7)])
    assert rows(lines.expense_detail(data), "gastos") == [(7.0,)]
    assert rows(lines.expense_no_detail(data), "gastos", "detallegasto") == [(5.0, None), (7.0, "03-1")]


def test_payroll_with_and_without_unposted_vouchers(spark):
    data = ledger(spark, [line("1", debe=1), line("2", debe=2)], [header("1"), header("2", est="P")])
    picked = {"details": starts_with("03")}
    assert rows(lines.payroll_lines(data, **picked, posted_only=False), "saldo") == [(1.0,), (2.0,)]
    assert rows(lines.payroll_lines(data, **picked), "saldo") == [(1.0,)]


def test_all_three_parts_of_the_voucher_key_count(spark):
    other_area, other_year = line(areacod="B", debe=1), line(cpbano=2021, debe=2)
    data = ledger(spark, [line(debe=4), other_area, other_year])
    assert rows(lines.expense_detail(data), "gastos") == [(4.0,)]


def test_line_without_header_is_dropped(spark):
    data = ledger(spark, [line("1", debe=4), line("404", debe=5)])
    assert rows(lines.expense_detail_basic(data), "gastos") == [(4.0,)]


def test_opening_month_is_left_out_of_balances_only(spark):
    data = ledger(spark, [line(mes="00", debe=3), line(mes="01", debe=4)])
    assert rows(balances.account_month_balance(data)) == [("01", 2020, 4.0, "5-1")]
    assert rows(lines.expense_detail(data), "gastos") == [(3.0,), (4.0,)]


def test_voucher_balance_uses_the_header_month_for_the_opening(spark):
    data = ledger(
        spark,
        [line("1", mes="00", pct="1-1", debe=3), line("2", mes="02", pct="1-1", debe=4)],
        [header("1", mes="01"), header("2", mes="00")],
    )
    assert rows(balances.voucher_balance(data, accounts="1-1"), "mes", "saldo") == [("00", 3.0)]


def test_income_is_credit_positive(spark):
    data = ledger(spark, [line(pct="4-1", haber=10), line(pct="4-1", debe=4), line(pct="5-1", debe=1)])
    assert rows(lines.income_lines(data, accounts=starts_with("4")), "saldo") == [(-4.0,), (10.0,)]


def test_excluded_prefix_drops_missing_codes_too(spark):
    data = ledger(spark, [line(dga="05-1", debe=1), line(dga="03-1", debe=2), line(dga=None, debe=3)])
    picked = lines.expense_detail(data, details=excluding(starts_with("03")), years=more_than(2019))
    assert rows(picked, "gastos") == [(1.0,)]


BILLING = {"spent": "5-1", "billed": "4-1", "centers": one_of("70-11", "70-12", "70-36")}


@pytest.mark.parametrize("single_pass", [True, False])
def test_billed_without_spending_has_no_key_unless_asked(spark, single_pass):
    data = ledger(
        spark,
        [
            line(mes="01", pct="5-1", debe=100),
            line(mes="01", pct="4-1", haber=30),
            line(mes="02", pct="4-1", haber=5),
            line(mes="03", pct="4-1", haber=6, cc="70-12"),
            line(mes="04", pct="5-1", debe=7),
        ],
    )
    plain = balances.spent_vs_billed(data, **BILLING, single_pass=single_pass)
    assert rows(plain, "mes", "ano", "gastos_afectos", "facturado_neto", "gastos_por_facturar", "vessel", "cc") == [
        ("01", 2020, 100.0, -30.0, 70.0, "11 ABCD", "70-11"),
        ("04", 2020, 7.0, 0.0, 7.0, "11 ABCD", "70-11"),
        (None, None, 0.0, -11.0, -11.0, None, None),
    ]
    keyed = balances.spent_vs_billed(data, **BILLING, keyed=True, single_pass=single_pass)
    assert rows(keyed, "mes", "gastos_afectos", "facturado_neto", "vessel") == [
        ("01", 100.0, -30.0, "11 ABCD"),
        ("02", 0.0, -5.0, "11 ABCD"),
        ("03", 0.0, -6.0, "ONGNAME"),
        ("04", 7.0, 0.0, "11 ABCD"),
    ]


@pytest.mark.parametrize("keyed", [True, False])
def test_single_pass_equals_the_join_on_odd_keys(spark, keyed):
    """NULL months and descriptions, a cost centre described twice, and groups on one side only."""
    data = ledger(
        spark,
        [
            line(mes=None, pct="5-1", debe=1),
            line(mes=None, pct="4-1", haber=2),
            line(mes="05", pct="4-1", haber=3, cc="02"),
            line(mes="05", pct="5-1", debe=4, cc="02"),
            line(mes="06", pct="5-1", debe=5, cc="03"),
            line(mes="06", pct="4-1", haber=6, cc="03"),
            line(mes="07", pct="4-1", haber=7, cc="03"),
            line(mes="08", pct="5-1", debe=None, cc="70-11"),
        ],
        centers=[("70-11", "CC 11 ABCD"), ("02", None), ("03", "a SAMENAM"), ("03", "b SAMENAM"), ("03", "b SAMENAM")],
    )
    params = {"spent": "5-1", "billed": "4-1", "keyed": keyed}
    fast = rows(balances.spent_vs_billed(data, **params))
    assert fast == rows(balances.spent_vs_billed(data, **params, single_pass=False))
    assert len(fast) > 3


def test_equal_lines_count_once_in_the_union(spark):
    data = ledger(spark, [line(pct="5-1", debe=2), line(pct="5-1", debe=2), line(pct="4-1", debe=2)])
    report = lines.exempt_expense_union(data, accounts=["5-1", "4-1"])
    assert rows(report, "pctcod", "gastos") == [("4-1", 2.0), ("5-1", 2.0)]


def test_equal_lines_count_each_in_a_listing(spark):
    data = ledger(spark, [line(debe=2), line(debe=2)])
    assert rows(lines.expense_detail(data), "gastos") == [(2.0,), (2.0,)]


def test_same_tail_under_two_centers_stays_apart(spark):
    data = ledger(
        spark,
        [line(cc="70-11", dga="05-1", debe=1), line(cc="70-99", dga="05-1", debe=2)],
        centers=[("70-11", "X ABCDEFG"), ("70-99", "Y ABCDEFG")],
    )
    report = balances.import_costs(data, accounts="5-1", centers=starts_with("70"), details="05-1")
    assert rows(report, "cc", "vessel", "gastos") == [("70-11", "ABCDEFG", 1.0), ("70-99", "ABCDEFG", 2.0)]


def test_document_in_two_groups_appears_twice(spark):
    data = ledger(spark, [line(aux="101", debe=119), line(aux="102", debe=238)])
    report = lines.issued_documents_union(
        data, groups={"N": ("101", contains("north")), "S": (None, contains("acme"))}, vat_factor=1.19
    )
    assert rows(report, "vessel", "codaux", "monto_neto") == [
        ("N", "101", pytest.approx(100.0)),
        ("S", "101", pytest.approx(100.0)),
        ("S", "102", pytest.approx(200.0)),
    ]


def test_name_match_may_respect_case(spark):
    names = spark.createDataFrame([("Acme",), ("ACME",), (None,)], "n STRING")
    assert names.where(contains("acme")(F.col("n"))).count() == 2
    assert names.where(contains("acme", case_sensitive=True)(F.col("n"))).count() == 0


def test_documents_are_sorted_newest_first(spark):
    data = ledger(spark, [line(movfe=JAN, debe=1), line(movfe=MAR, debe=2)])
    report = lines.issued_documents(data, vessel="A", counterparties="101")
    assert [r["movfe"] for r in report.collect()] == [MAR, JAN]


def test_month_code_that_is_no_number_is_dropped_without_error(spark):
    data = ledger(spark, [line(mes="A1", pct="1-1", debe=1), line(mes="00", pct="1-1", debe=2),
                          line(mes="11", pct="1-1", debe=3)])
    report = lines.receivables(data, accounts="1-1", counterparties=["101"])
    assert rows(report, "mes", "gastos") == [("11", 3.0)]


def test_opening_voucher_is_left_out_of_the_intercompany_ledger(spark):
    data = ledger(
        spark,
        [line("00000000", pct="1-1", debe=1), line("1", pct="1-1", debe=2)],
        [header("00000000"), header("1")],
    )
    report = lines.intercompany_ledger(data, counterparties="101", accounts="1-1")
    assert rows(report, "cpbnum", "movdebe") == [("1", 2.0)]


def test_tail_of_a_padded_description(spark):
    names = spark.createDataFrame([("CC 11 ABCD   ",), ("AB",), (None,)], "s STRING")
    assert [r[0] for r in names.select(tail_name("s")).collect()] == ["11 ABCD", "AB", None]


def test_period_split(spark):
    periods = spark.createDataFrame([("202401",)], "p STRING")
    assert rows(periods.select(period_year("p"), period_month("p"))) == [("2024", "01")]


def test_missing_part_leaves_the_net_empty(spark):
    docs = [("F", 1, money(10), money(5), JAN, "101", "V"), ("F", 2, money(10), None, JAN, "101", "V"),
            ("X", 3, money(1), money(1), JAN, "101", "V"), ("N", 4, money(1), money(1), JAN, "101", "P")]
    report = sales.sales_documents(ledger(spark, sales_docs=docs))
    assert rows(report, "folio", "netos") == [(1, 15.0), (2, None)]


def test_product_without_the_attribute_is_kept(spark):
    product = ("P1", "Bolt", "g", "s", "u", "a", "v", "c", "x", JAN)
    data = ledger(
        spark,
        products=[product, ("SVAR9", *product[1:]), ("P2", *product[1:])],
        product_attributes=[("P1", 2, "other"), ("P2", 1, "heavy")],
    )
    report = sales.product_attribute(data, attribute=1, products=excluding(starts_with("SVAR")))
    assert rows(report, "codigo", "peso") == [("P1", None), ("P2", "heavy")]


def test_month_sales_of_an_unknown_product_are_kept(spark):
    data = ledger(spark, month_sales=[("202402", "F", "B", "NOPE", money(3))])
    assert rows(sales.product_month_sales(data), "year", "month", "codprod", "total", "desprod") == [
        ("2024", "02", "NOPE", 3.0, None)
    ]


def test_padded_codes_and_text_years_are_cleaned(spark):
    raw = ledger(spark, [line(debe=1)])
    raw = raw.with_tables(
        lines=raw.lines.withColumn("cccod", F.lit("70-11  ")).withColumn("cpbano", F.lit("2020")),
        headers=raw.headers.withColumn("cpbest", F.lit("V ")).withColumn("cpbano", F.lit("2020")),
    )
    cleaned = clean_ledger(raw)
    assert dict(cleaned.lines.dtypes)["cpbano"] == "int"
    assert rows(lines.payroll_lines(cleaned, accounts="5-1", centers="70-11"), "saldo") == [(1.0,)]
    # A description keeps its blanks.
    assert rows(cleaned.centers.where("codicc = '70-11'"), "desccc") == [("CC 11 ABCD   ",)]


def test_staged_tables_keep_companies_and_odd_years(spark, tmp_path):
    a = ledger(spark, [line(debe=1), line(cpbano=None, debe=2)])
    staged = stage_ledger(Ledger.combine({"001": a, "002": a}), str(tmp_path / "tables"))
    assert staged.lines.where("cpbano is null").count() == 2
    assert rows(lines.expense_detail(staged), "company", "gastos") == [("001", 1.0), ("002", 1.0)]


def test_companies_do_not_mix(spark):
    a = ledger(spark, [line("1", debe=1), line("2", debe=2)], [header("1"), header("2", est="P")])
    b = ledger(spark, [line("2", debe=4)], [header("2")])
    both = Ledger.combine({"a": a, "b": b})
    assert rows(balances.account_month_balance(both), "company", "gastos") == [("a", 1.0), ("b", 4.0)]
    chosen = lines.payroll_lines(both, accounts=by_company({"a": "9-9", "b": "5-1"}))
    assert rows(chosen, "company", "saldo") == [("b", 4.0)]


@pytest.mark.parametrize("single_pass", [True, False])
def test_keyless_billing_stays_with_its_company(spark, single_pass):
    a = ledger(spark, [line(pct="4-1", haber=1)])
    b = ledger(spark, [line(pct="4-1", haber=2), line(mes="02", pct="5-1", debe=3)])
    report = balances.spent_vs_billed(Ledger.combine({"a": a, "b": b}), spent="5-1", billed="4-1",
                                      single_pass=single_pass)
    assert rows(report, "company", "mes", "gastos_por_facturar") == [
        ("a", None, -1.0), ("b", "02", 3.0), ("b", None, -2.0),
    ]


def test_companies_with_other_codes_are_refused(spark):
    plain = ledger(spark)
    with pytest.raises(ValueError):
        Ledger.combine({"a": plain, "b": plain.with_tables(posted_state="P")})


def test_staged_journal_gives_the_same_reports(spark, tmp_path):
    a = ledger(spark, [line("1", debe=1), line("1", mes="02", pct="1-1", debe=2)])
    both = Ledger.combine({"001": a, "002": a})
    staged = stage_journal(both, str(tmp_path / "journal"))
    for report, params in (
        (balances.account_month_balance, {}),
        (balances.voucher_balance, {"accounts": "1-1"}),
        (lines.payroll_lines, {"accounts": "5-1"}),
    ):
        assert rows(report(staged, **params)) == rows(report(both, **params))
    assert {r[0] for r in rows(lines.expense_detail(staged), "company")} == {"001", "002"}


def test_read_takes_declared_columns_in_any_case(spark, tmp_path):
    source = frame(spark, [("70-11", "CC")], "CODICC STRING, DESCCC STRING").withColumn("OTHER", F.lit(1))
    source.write.parquet(str(tmp_path / "cwtccos"))
    data = Ledger.read(spark, str(tmp_path), {"centers": "cwtccos"})
    assert data.centers.columns == ["codicc", "desccc"]


def test_vouchers_whose_year_is_no_number_stay(spark, tmp_path):
    raw = ledger(spark, [line(debe=1), line(num="2", debe=2)], headers=[header(), header(num="2")])
    spelled = F.when(F.col("cpbnum") == "2", F.lit("FY20 ")).otherwise(F.lit("2020  "))
    raw = raw.with_tables(
        lines=raw.lines.withColumn("cpbano", spelled), headers=raw.headers.withColumn("cpbano", F.rtrim(spelled))
    )
    for cleaned in (clean_ledger(raw), stage_ledger(raw, str(tmp_path / "staged"))):
        found = balances.account_month_balance(cleaned)
        assert sorted(rows(found, "ano", "gastos"), key=str) == [(2020, 1.0), (None, 2.0)]
        assert rows(balances.account_month_balance(cleaned, years=2020), "gastos") == [(1.0,)]


def test_empty_tables_are_staged_with_their_columns(spark, tmp_path):
    raw = ledger(spark, [line(debe=1)])
    empty = raw.with_tables(lines=raw.lines.where("cpbano < 0"))
    staged = stage_ledger(empty, str(tmp_path / "staged"))
    assert staged.lines.columns == raw.lines.columns and rows(balances.account_month_balance(staged)) == []


def test_a_table_missing_in_one_company_is_named(spark):
    whole = ledger(spark, [line(debe=1)])
    part = Ledger(**{name: df for name, df in whole.tables().items() if name != "details"})
    with pytest.raises(ValueError, match="b.*details"):
        Ledger.combine({"a": whole, "b": part})
