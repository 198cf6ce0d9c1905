"""Reports over sales documents and products of the ledger database."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.criteria import keep
from tallyloom.functions.dates import month_of, since_year, year_of
from tallyloom.functions.money import money, shown
from tallyloom.functions.text import period_month, period_year
from tallyloom.operators.lookups import look_up, with_counterparty
from tallyloom.operators.sorting import newest_first
from tallyloom.sources.ledger import Ledger


def sales_documents(
    ledger: Ledger, *, kinds: Any = ("F", "N", "D"), from_year: int | None = None
) -> DataFrame:
    """Valid sales documents with their net amount; a missing taxed or exempt part leaves the net empty."""
    docs = keep(ledger.sales_docs, ledger.collation, tipo=kinds, estado=ledger.posted_state)
    if from_year is not None:
        docs = docs.where(since_year("fecha", from_year))
    return with_counterparty(docs, ledger).select(
        *ledger.scope,
        "tipo",
        "folio",
        shown(money("netoafecto") + money("netoexento")).alias("netos"),
        month_of("fecha").alias("mes"),
        year_of("fecha").alias("year"),
        "codaux",
        "nomaux",
    )


def product_month_sales(ledger: Ledger) -> DataFrame:
    """Monthly sales with product data where the product is known, latest month first."""
    names = ["desprod", "codgrupo", "codsubgr", "codumed", "ctaactivo", "ctaventas", "ctacosto", "fechaulmod"]
    rows = look_up(
        ledger.month_sales,
        ledger.products,
        {"codprod": "codprod"},
        {name: name for name in names},
        scope=ledger.scope,
        how="left",
    )
    report = rows.select(
        *ledger.scope,
        period_year("mes").alias("year"),
        period_month("mes").alias("month"),
        "tipo",
        "codbode",
        "codprod",
        "mes",
        shown(F.col("total")).alias("total"),
        *names,
    )
    return newest_first(report, "mes", ties=("codprod", "tipo", "codbode"))


def product_attribute(ledger: Ledger, *, attribute: int = 1, products: Any = None) -> DataFrame:
    """Products with the value of one attribute, empty for products without it."""
    values = ledger.product_attributes.where(F.col("codtat") == F.lit(attribute))
    rows = look_up(
        keep(ledger.products, ledger.collation, codprod=products),
        values,
        {"codprod": "codigo"},
        {"valor": "valor"},
        scope=ledger.scope,
        how="left",
    )
    return rows.select(
        *ledger.scope,
        F.col("codprod").alias("codigo"),
        # Fixed value: existing consumers know the column under this spelling.
        F.col("desprod").alias("desripcion"),
        F.col("codgrupo").alias("grupo"),
        F.col("codsubgr").alias("subgrupo"),
        F.col("valor").alias("peso"),
        "ctaactivo",
        "ctaventas",
        "ctagastos",
        "ctacosto",
    )
