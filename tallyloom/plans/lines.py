"""Reports that list journal lines."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.criteria import any_of, differs_from, meets
from tallyloom.functions.dates import month_of, year_of
from tallyloom.functions.money import money, net_credit, net_debit, shown, without_vat
from tallyloom.functions.text import tail_name
from tallyloom.operators.journal import (
    HEADER_MONTH,
    journal_lines,
    narrowed,
    with_numbered_month,
    without_opening,
)
from tallyloom.operators.lookups import look_up, with_account, with_center, with_detail, with_doc_type
from tallyloom.operators.sorting import newest_first
from tallyloom.operators.tagging import tag_groups
from tallyloom.sources.ledger import Ledger


def _voucher_lines(rows: DataFrame, ledger: Ledger, amount: Column, center_name: str) -> DataFrame:
    rows = with_detail(with_center(rows, ledger, center_name), ledger)
    return rows.select(
        *ledger.scope,
        "dgacod",
        F.col(HEADER_MONTH).alias("mes"),
        F.col("cpbano").alias("ano"),
        "cpbnum",
        "cpbtip",
        "cpbnui",
        "pctcod",
        F.col("movglosa").alias("glosa"),
        shown(amount).alias("saldo"),
        "cccod",
        center_name,
    )


def payroll_lines(
    ledger: Ledger,
    *,
    details: Any = None,
    accounts: Any = None,
    centers: Any = None,
    posted_only: bool = True,
) -> DataFrame:
    """Payroll lines, chosen by expense detail or by account, with their net debit.

    Some installations list unposted vouchers too: ``posted_only=False``.
    """
    rows = journal_lines(ledger, posted_only=posted_only, dgacod=details, pctcod=accounts, cccod=centers)
    return _voucher_lines(rows, ledger, net_debit(), "descripcioncc")


def income_lines(ledger: Ledger, *, accounts: Any, centers: Any = None, years: Any = None) -> DataFrame:
    """Posted lines of income accounts, credit positive."""
    rows = journal_lines(ledger, posted_only=True, pctcod=accounts, cccod=centers, cpbano=years)
    # Fixed value: existing consumers know the description column under this spelling.
    return _voucher_lines(rows, ledger, net_credit(), "descipcioncc")


def _expense_columns(detail: str = "dgacod") -> list[Column | str]:
    return [
        F.col("cpbmes").alias("mes"),
        F.col("cpbano").alias("ano"),
        shown(net_debit()).alias("gastos"),
        F.col("dgacod").alias(detail),
    ]


def expense_detail(
    ledger: Ledger, *, years: Any = None, centers: Any = None, details: Any = None
) -> DataFrame:
    """Every line with its expense detail, cost centre and account."""
    rows = journal_lines(ledger, cpbano=years, cccod=centers, dgacod=details)
    rows = with_account(with_center(with_detail(rows, ledger), ledger), ledger, "descripcion")
    return rows.select(
        *ledger.scope,
        *_expense_columns(),
        "descripciondetalle",
        F.col("movglosa").alias("glosa"),
        "cccod",
        "descripcioncc",
        F.col("pctcod").alias("codigo"),
        "descripcion",
    )


def expense_detail_basic(ledger: Ledger, *, centers: Any = None) -> DataFrame:
    """Expense detail without the account; with ``centers`` the expenses of one cost centre."""
    rows = journal_lines(ledger, cccod=centers)
    rows = with_center(with_detail(rows, ledger), ledger)
    return rows.select(
        *ledger.scope,
        *_expense_columns(),
        "descripciondetalle",
        F.col("movglosa").alias("glosa"),
        "cccod",
        "descripcioncc",
    )


def expense_no_detail(ledger: Ledger, *, years: Any = None) -> DataFrame:
    """Expenses that need no detail code, so lines without one are listed too."""
    rows = journal_lines(ledger, cpbano=years)
    rows = with_account(with_center(rows, ledger), ledger, "descripcion")
    return rows.select(
        *ledger.scope,
        *_expense_columns("detallegasto"),
        F.col("movglosa").alias("glosa"),
        "cccod",
        "descripcioncc",
        F.col("pctcod").alias("codigo"),
        "descripcion",
    )


def exempt_expense_union(ledger: Ledger, *, accounts: list[Any]) -> DataFrame:
    """Posted lines of several exempt accounts as a distinct union.

    The account is one of the columns, so the union of one branch per account is the distinct rows of a single scan
    over all of them. Lines alike in every listed column count once.
    """
    rows = journal_lines(ledger, posted_only=True, pctcod=any_of(*accounts))
    rows = with_center(with_detail(without_opening(rows, ledger), ledger, "desdet"), ledger, "desccc")
    return rows.select(
        *ledger.scope,
        "dgacod",
        F.col("cpbmes").alias("mes"),
        F.col("cpbano").alias("ano"),
        "cpbnum",
        "cpbnui",
        "desdet",
        "pctcod",
        "movglosa",
        shown(net_debit()).alias("gastos"),
        "cccod",
        tail_name("desccc").alias("vessel"),
    ).distinct()


def _documents(ledger: Ledger, groups: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """Posted lines of the tagged counterparties, outside the opening month.

    Which group a document belongs to depends on its counterparty alone. The few chosen counterparties are therefore
    tagged first and joined to the lines before the headers are, which leaves little to shuffle.
    """
    conditions = {}
    for vessel, (codes, names) in groups.items():
        parts = [
            meets(ledger.counterparties, column, spec, ledger.collation)
            for column, spec in (("codaux", codes), ("nomaux", names))
            if spec is not None
        ]
        conditions[vessel] = reduce(or_, parts)
    chosen = tag_groups(ledger.counterparties, conditions, "vessel")
    party = {"nomaux": "nomaux", "vessel": "vessel"}
    few = narrowed(ledger, lambda rows: look_up(rows, chosen, {"codaux": "codaux"}, party, scope=ledger.scope))
    return with_doc_type(without_opening(journal_lines(few, posted_only=True), ledger), ledger)


def _document_columns(ledger: Ledger, vat_factor: float | None) -> list[Column | str]:
    amount = net_debit()
    net = [] if vat_factor is None else [without_vat(amount, vat_factor).alias("monto_neto")]
    return [
        *ledger.scope,
        year_of("movfe").alias("ano"),
        month_of("movfe").alias("mes"),
        "vessel",
        F.col("ttdcod").alias("coddoc"),
        "numdoc",
        "codaux",
        "nomaux",
        "movfe",
        "cpbmes",
        "cpbano",
        shown(amount).alias("monto_facturado"),
        *net,
        "movglosa",
        "desdoc",
    ]


def issued_documents(ledger: Ledger, *, vessel: str, counterparties: Any) -> DataFrame:
    """Documents issued to one group of counterparties, newest first."""
    rows = _documents(ledger, {vessel: (counterparties, None)})
    return newest_first(rows.select(*_document_columns(ledger, None)), "movfe", ties=("numdoc", "codaux"))


def issued_documents_union(
    ledger: Ledger, *, groups: Mapping[str, tuple[Any, Any]], vat_factor: float = 1.19
) -> DataFrame:
    """Distinct union over tagged groups of counterparties, newest first, with the amount before tax.

    A group is a pair of criteria, on the counterparty code and on its name; either may be None. A document belongs
    to every group one of whose criteria it meets, and is listed once under each.
    """
    report = _documents(ledger, groups).select(*_document_columns(ledger, vat_factor)).distinct()
    return newest_first(report, "movfe", ties=("numdoc", "codaux", "vessel"))


def receivables(ledger: Ledger, *, accounts: Any, counterparties: Any) -> DataFrame:
    """Posted lines of receivable accounts for a list of counterparties, newest first."""
    rows = journal_lines(ledger, posted_only=True, pctcod=accounts, codaux=counterparties)
    report = with_numbered_month(rows).select(
        *ledger.scope,
        "cccod",
        "dgacod",
        F.col("cpbmes").alias("mes"),
        F.col("cpbano").alias("ano"),
        "movfe",
        "cpbnum",
        "pctcod",
        "codaux",
        "movglosa",
        shown(net_debit()).alias("gastos"),
    )
    return newest_first(report, "movfe", ties=("cpbnum", "codaux", "pctcod"))


def intercompany_ledger(
    ledger: Ledger, *, counterparties: Any, accounts: Any, years: Any = None, opening_number: Any = "00000000"
) -> DataFrame:
    """Posted lines with a counterparty on intercompany accounts, the opening voucher left out."""
    rows = journal_lines(
        ledger,
        posted_only=True,
        codaux=counterparties,
        pctcod=accounts,
        cpbano=years,
        cpbnum=differs_from(opening_number),
    )
    return with_doc_type(rows, ledger).select(
        *ledger.scope,
        "cpbano",
        "codaux",
        "pctcod",
        "ttdcod",
        "desdoc",
        "numdoc",
        "movfe",
        "movfv",
        "movtipdocref",
        "movnumdocref",
        "cpbnum",
        "cpbfec",
        shown(money("movdebe")).alias("movdebe"),
        shown(money("movhaber")).alias("movhaber"),
        "movglosa",
        "cpbest",
    )
