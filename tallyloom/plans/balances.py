"""Reports that sum journal lines."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.criteria import meets
from tallyloom.functions.money import net_debit, shown, total
from tallyloom.functions.text import tail_name
from tallyloom.operators.journal import HEADER_MONTH, journal_lines, without_opening
from tallyloom.operators.lookups import by_codes, with_account, with_center, with_detail
from tallyloom.operators.reconcile import outer_join_sums, single_pass_sums
from tallyloom.sources.ledger import Ledger


def account_month_balance(ledger: Ledger, *, years: Any = None) -> DataFrame:
    """Posted balance of each account and month, the opening month left out."""
    rows = without_opening(journal_lines(ledger, posted_only=True, cpbano=years), ledger)
    keys, spellings = by_codes(rows, "pctcod", "cpbmes")
    return (
        rows.groupBy(*ledger.scope, *keys, "cpbano")
        .agg(shown(total(net_debit())).alias("gastos"), *spellings)
        .select(
            *ledger.scope,
            F.col("cpbmes").alias("mes"),
            F.col("cpbano").alias("ano"),
            "gastos",
            F.col("pctcod").alias("codigo"),
        )
    )


def voucher_balance(ledger: Ledger, *, accounts: Any, counterparties: Any = None) -> DataFrame:
    """Posted balance per voucher, counterparty and description for chosen accounts.

    Vouchers of the opening month are left out by the header's month, while the month shown is the line's. The
    choice of accounts and counterparties concerns grouping columns, so it filters the lines before the sum.
    """
    rows = journal_lines(ledger, posted_only=True, pctcod=accounts, codaux=counterparties)
    rows = with_account(without_opening(rows, ledger, HEADER_MONTH), ledger)
    keys, spellings = by_codes(rows, "pctcod", "cpbnum", "cpbtip", "cpbnui", "codaux", "ttdcod", "cpbmes")
    return (
        rows.groupBy(*ledger.scope, *keys, "pcdesc", "cpbano", "movglosa")
        .agg(shown(total(net_debit())).alias("saldo"), *spellings)
        .select(
            *ledger.scope,
            F.col("pctcod").alias("pccodi"),
            "pcdesc",
            "cpbnum",
            "cpbtip",
            "cpbnui",
            "codaux",
            "ttdcod",
            F.col("cpbmes").alias("mes"),
            F.col("cpbano").alias("ano"),
            "saldo",
            "movglosa",
        )
    )


def spent_vs_billed(
    ledger: Ledger,
    *,
    spent: Any,
    billed: Any,
    centers: Any = None,
    keyed: bool = False,
    spent_name: str = "gastos_afectos",
    single_pass: bool = True,
) -> DataFrame:
    """Spending accounts against billing accounts by month, name in the cost-centre description, and cost centre.

    Groups that were only billed have no key of their own and end up in one row of NULL keys; ``keyed=True`` gives
    them their keys. ``single_pass=False`` computes the two sides apart and joins them; a collated ledger always takes one
    pass, in which both sides show a code in the same spelling.
    """
    rows = journal_lines(ledger, posted_only=True, cccod=centers)
    is_spent, is_billed = (meets(rows, "pctcod", spec, ledger.collation) for spec in (spent, billed))
    keys = ["cpbano", "cpbmes", "vessel", "cccod"]

    def side(rows: DataFrame, *measures) -> DataFrame:
        # Sums per code first, so that the dimension joins see a handful of rows per cost centre and month.
        codes, spellings = by_codes(rows, "cpbmes", "cccod", "dgacod")
        per_code = rows.groupBy(*ledger.scope, "cpbano", *codes).agg(*[m for m, _ in measures], *spellings)
        named = with_center(with_detail(per_code, ledger), ledger, "desccc")
        codes, spellings = by_codes(named, "cpbmes", "cccod")
        per_center = named.groupBy(*ledger.scope, "cpbano", *codes, "desccc").agg(*[m for _, m in measures], *spellings)
        return per_center.withColumn("vessel", tail_name("desccc"))

    def summed(name, condition):
        return total(F.when(condition, net_debit())).alias(name), F.sum(name).alias(name)

    def present(name, condition):
        return F.max(condition).alias(name), F.max(name).alias(name)

    if single_pass or ledger.collation is not None:
        groups = side(
            rows.where(is_spent | is_billed),
            summed("spent", is_spent),
            summed("billed", is_billed),
            present("on_left", is_spent),
            present("on_right", is_billed),
        )
        sums = single_pass_sums(groups, keys, "spent", "billed", scope=ledger.scope, keep_right_keys=keyed)
    else:
        g = side(rows.where(is_spent), summed("spent", is_spent))
        f = side(rows.where(is_billed), summed("billed", is_billed))
        sums = outer_join_sums(g, f, keys, "spent", "billed", scope=ledger.scope, keep_right_keys=keyed)
    spent_sum, billed_sum = (F.coalesce(F.col(c), F.lit(0)) for c in ("spent", "billed"))
    return sums.select(
        *ledger.scope,
        F.col("cpbmes").alias("mes"),
        F.col("cpbano").alias("ano"),
        shown(spent_sum).alias(spent_name),
        shown(billed_sum).alias("facturado_neto"),
        shown(spent_sum + billed_sum).alias("gastos_por_facturar"),
        "vessel",
        F.col("cccod").alias("cc"),
    ).orderBy("ano", "mes")


def import_costs(ledger: Ledger, *, accounts: Any, centers: Any, details: Any) -> DataFrame:
    """Import costs by month, cost centre and detail. Equal names under different cost centres stay apart."""
    rows = journal_lines(ledger, posted_only=True, pctcod=accounts, cccod=centers, dgacod=details)
    rows = without_opening(rows, ledger, HEADER_MONTH)
    codes, spellings = by_codes(rows, "cpbmes", "cccod", "dgacod")
    per_code = rows.groupBy(*ledger.scope, "cpbano", *codes).agg(total(net_debit()).alias("net"), *spellings)
    named = with_center(with_detail(per_code, ledger), ledger, "desccc")
    return (
        named.groupBy(*ledger.scope, "cpbano", *codes, "desccc")
        .agg(shown(F.sum("net")).alias("gastos"), *spellings)
        .select(
            *ledger.scope,
            F.col("cpbmes").alias("mes"),
            F.col("cpbano").alias("ano"),
            "gastos",
            tail_name("desccc").alias("vessel"),
            F.col("cccod").alias("cc"),
            "dgacod",
        )
        .orderBy(F.col("ano").desc(), F.col("mes").desc())
    )
