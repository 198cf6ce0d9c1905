"""Reports over the ERP replica.

Sums are taken per foreign key before any dimension is joined: the large table is combined on the map side and
shuffled once as partial sums, whatever the dimension sizes and however skewed the keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.criteria import keep, matches
from tallyloom.functions.dates import in_year, month_of, year_of
from tallyloom.functions.money import money, shown, total
from tallyloom.operators.lookups import look_up
from tallyloom.operators.sorting import newest_first
from tallyloom.sources.erp import Erp


def _invoices(erp: Erp, kind: Any, partner_name: str, company_name: str) -> DataFrame:
    rows = keep(erp.invoices, type=kind)
    rows = look_up(rows, erp.partners, {"partner_id": "id"}, {"name": partner_name})
    return look_up(rows, erp.companies, {"company_id": "id"}, {"name": company_name})


def _shown_invoice(erp: Erp) -> list[Column]:
    """Every invoice column, money as reports give it out."""
    return [
        shown(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in erp.invoices.schema.fields
    ]


def customer_invoices(erp: Erp, *, kind: Any = "out_invoice") -> DataFrame:
    """Named customer invoices with all their columns, latest first."""
    rows = _invoices(erp, kind, "client", "vessel").where(F.col("name").isNotNull())
    report = rows.select("client", "vessel", F.col("name").alias("codigo"), *_shown_invoice(erp))
    return newest_first(report, "date", "name", ties=("id",))


def supplier_bills(
    erp: Erp,
    *,
    kind: Any = "in_invoice",
    open_only: bool = False,
    partner_id: Any = None,
    cancelled_state: Any = None,
) -> DataFrame:
    """Supplier bills with all their columns, latest first.

    ``open_only`` keeps bills with a residual, ``partner_id`` those of one supplier, and ``cancelled_state`` drops
    bills in that state.
    """
    rows = keep(_invoices(erp, kind, "supplier", "company"), partner_id=partner_id)
    if cancelled_state is not None:
        rows = rows.where(F.col("state") != F.lit(cancelled_state))
    if open_only:
        rows = rows.where(F.col("residual_company_signed") != 0)
    report = rows.select(*_shown_invoice(erp), "supplier", "company")
    return newest_first(report, "date", "partner_id", "name", ties=("id",))


def product_movements(erp: Erp) -> DataFrame:
    """Purchases by partner, product, company, invoice date and line description, oldest last order first.

    The product id and the invoice date separate groups without being shown, so rows may look alike. Lines without a
    product are kept. Products are looked up before the sums: where that join deals out the lines by product, the
    groups need no exchange of their own. ``product`` numbers the products' rows, so that a group meets each of
    several rows of one product once and no line counts twice.
    """
    invoices = erp.invoices.select(F.col("id").alias("invoice_id"), "date_invoice")
    lines = erp.invoice_lines.select(
        "partner_id",
        "product_id",
        "company_id",
        "name",
        "invoice_id",
        F.when(F.col("id").isNotNull(), True).alias("counted"),
        money("price_subtotal_signed").alias("amount"),
        F.col("quantity").cast("decimal(18,4)").alias("quantity"),
        "write_date",
    )
    # Variants and templates meet first, so that the lines are dealt out for products once.
    templates = erp.product_templates.select(
        F.col("id").alias("product_tmpl_id"), F.col("id").alias("known_p_id"), F.col("name").alias("producto")
    )
    products = erp.product_variants.select(F.col("id").alias("product_id"), "product_tmpl_id").join(
        templates, "product_tmpl_id", "left"
    )
    products = products.drop("product_tmpl_id").withColumn("product", F.monotonically_increasing_id())
    groups = (
        lines.join(invoices, "invoice_id")
        .drop("invoice_id")
        .join(products, "product_id", "left")
        .groupBy("partner_id", "product_id", "company_id", "date_invoice", "name", "product", "known_p_id", "producto")
        .agg(
            F.count("counted").alias("orders"),
            shown(total(F.col("amount"))).alias("monto"),
            F.sum("quantity").cast("double").alias("cantidad"),
            F.max("write_date").alias("last_order"),
        )
        .drop("product_id", "product")
    )
    rows = look_up(groups, erp.partners, {"partner_id": "id"}, {"name": "partner_name"})
    rows = look_up(rows, erp.companies, {"company_id": "id"}, {"name": "company_name"})
    report = rows.select(
        F.col("partner_id").alias("id"),
        "partner_name",
        "orders",
        "producto",
        F.col("known_p_id").alias("p_id"),
        "monto",
        "cantidad",
        "last_order",
        "company_id",
        "company_name",
        year_of("date_invoice").alias("ano"),
        F.col("name").alias("producto_descripcion"),
    )
    return report.orderBy("last_order", "id", "p_id", "company_id", "producto_descripcion")


def _account_balance(erp: Erp, moves: DataFrame, *periods: tuple[str, Column]) -> DataFrame:
    names = [name for name, _ in periods]
    per_id = moves.groupBy("account_id", "company_id", *[column.alias(name) for name, column in periods]).agg(
        total(money("balance")).alias("saldo")
    )
    return named_account_balance(erp, per_id, names)


def named_account_balance(erp: Erp, per_id: DataFrame, periods: Sequence[str] = ()) -> DataFrame:
    """Sums ``saldo`` by ``account_id``, ``company_id`` and ``periods`` as the balance report gives them out."""
    named = look_up(per_id, erp.accounts, {"account_id": "id"}, {"code": "codigo", "name": "cuenta"})
    named = look_up(named, erp.companies, {"company_id": "id"}, {"name": "vessel"})
    # Several accounts may share code and name.
    summed = named.groupBy("codigo", "cuenta", "company_id", "vessel", *periods).agg(F.sum("saldo").alias("saldo"))
    return summed.select("vessel", "cuenta", shown(F.col("saldo")).alias("saldo"), "codigo", "company_id", *periods)


def company_account_balance(erp: Erp) -> DataFrame:
    """Balance of each account and company over all time."""
    return _account_balance(erp, erp.move_lines)


def company_account_month(erp: Erp) -> DataFrame:
    """Balance of each account and company by year and month."""
    return _account_balance(erp, erp.move_lines, ("ano", year_of("date")), ("mes", month_of("date")))


def income_statement_year(erp: Erp, *, year: int | None = None) -> DataFrame:
    """Balance of each account and company in one year, the current year by default."""
    return _account_balance(erp, erp.move_lines.where(in_year("date", year)))


def partner_residual(erp: Erp) -> DataFrame:
    """Open amount of each partner and company where it is not zero; cents that cancel sum to exactly zero."""
    return named_partner_residual(
        erp, erp.move_lines.groupBy("partner_id", "company_id").agg(total(money("amount_residual")).alias("saldo"))
    )


def named_partner_residual(erp: Erp, sums: DataFrame) -> DataFrame:
    """Sums ``saldo`` by ``partner_id`` and ``company_id``, where not zero, as the residual report gives them out."""
    rows = look_up(sums.where(F.col("saldo") != 0), erp.partners, {"partner_id": "id"}, {"name": "partner"})
    rows = look_up(rows, erp.companies, {"company_id": "id"}, {"name": "vessel"})
    return rows.select(shown(F.col("saldo")).alias("saldo"), "partner_id", "partner", "company_id", "vessel")


def cash_basis_balance(erp: Erp, *, accounts: Any) -> DataFrame:
    """Cash-basis balance by company, journal and account; lines without a known partner do not count."""
    moves = erp.move_lines.where(matches(F.col("account_id"), accounts))
    per_partner = moves.groupBy("company_id", "journal_id", "account_id", "partner_id").agg(
        total(money("balance_cash_basis")).alias("saldo")
    )
    known = look_up(per_partner, erp.partners, {"partner_id": "id"})
    sums = known.groupBy("company_id", "journal_id", "account_id").agg(F.sum("saldo").alias("saldo"))
    rows = look_up(sums, erp.companies, {"company_id": "id"}, {"name": "vessel"})
    return rows.select(
        shown(F.col("saldo")).alias("saldo"), "company_id", "vessel", "journal_id", "account_id"
    )
