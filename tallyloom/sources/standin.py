"""Ledger and ERP tables derived from the test tables, which hold orders and line items instead of vouchers.

All expressions are plain column expressions over the parquet scans, so column choice and filters on unchanged
columns reach the files. Status ``F`` stands for a posted voucher. Some codes have no dimension row on purpose:
detail ``NATION_25``, document type 5, company 25, products with a negative number.

The functions keep their plans per session and folder; no data is kept.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.money import money
from tallyloom.sources.erp import Erp
from tallyloom.sources.ledger import COMPANY, Ledger

POSTED = "F"


@lru_cache(maxsize=64)
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def account_code(part_key: Column) -> Column:
    """One of 60 codes such as ``4-1-03``."""
    group, sub, leaf = part_key % 5 + 1, part_key % 3 + 1, part_key % 20
    return F.concat_ws(
        "-", group.cast("string"), sub.cast("string"), F.lpad(leaf.cast("string"), 2, "0")
    )


def month_code(date: str) -> Column:
    """``00`` to ``11``, so that the opening month occurs."""
    return F.lpad((F.month(date) - 1).cast("string"), 2, "0")


def _signed() -> Column:
    return F.when(F.col("l_returnflag") == "R", -money("l_extendedprice")).otherwise(money("l_extendedprice"))


def _zero() -> Column:
    return F.lit(0).cast("decimal(18,2)")


def _voucher_key(number: str) -> list[Column]:
    key = F.col(number)
    return [(key % 7 + 1995).cast("int").alias("cpbano"), key.alias("cpbnum"), (key % 5).alias("areacod")]


@lru_cache(maxsize=8)
def ledger(spark: SparkSession, folder: str) -> Ledger:
    items, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    part, returned = table(spark, folder, "part"), F.col("l_returnflag") == "R"
    lines = items.select(
        *_voucher_key("l_orderkey"),
        month_code("l_shipdate").alias("cpbmes"),
        account_code(F.col("l_partkey")).alias("pctcod"),
        F.col("l_suppkey").alias("cccod"),
        F.concat(F.lit("NATION_"), (F.col("l_partkey") % 26).cast("string")).alias("dgacod"),
        F.floor(F.col("l_orderkey") / 10).alias("codaux"),
        (F.col("l_linenumber") % 6).alias("ttdcod"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("numdoc"),
        F.col("l_shipdate").alias("movfe"),
        (F.col("l_shipdate") + F.expr("interval 30 days")).alias("movfv"),
        F.col("l_returnflag").alias("movtipdocref"),
        F.col("l_orderkey").alias("movnumdocref"),
        F.when(returned, _zero()).otherwise(money("l_extendedprice")).alias("movdebe"),
        F.when(returned, money("l_extendedprice")).otherwise(_zero()).alias("movhaber"),
        F.concat("l_returnflag", "l_linestatus", F.lit(" "), F.col("l_quantity").cast("int").cast("string")).alias(
            "movglosa"
        ),
    )
    headers = orders.select(
        *_voucher_key("o_orderkey"),
        month_code("o_orderdate").alias("cpbmes"),
        F.col("o_orderpriority").alias("cpbtip"),
        F.col("o_custkey").alias("cpbnui"),
        F.col("o_orderstatus").alias("cpbest"),
        F.col("o_orderdate").alias("cpbfec"),
    )
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    product = F.when(F.col("l_linenumber") == 7, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    return Ledger(
        lines=lines,
        headers=headers,
        centers=table(spark, folder, "supplier").select(
            F.col("s_suppkey").alias("codicc"), F.col("s_name").alias("desccc")
        ),
        details=table(spark, folder, "nation").select(
            F.col("n_name").alias("coddet"),
            F.concat(F.lit("Detail "), F.col("n_nationkey").cast("string")).alias("desdet"),
        ),
        accounts=part.groupBy(account_code(F.col("p_partkey")).alias("pccodi")).agg(F.min("p_name").alias("pcdesc")),
        doc_types=table(spark, folder, "region").select(
            F.col("r_regionkey").alias("coddoc"), F.col("r_name").alias("desdoc")
        ),
        counterparties=table(spark, folder, "customer").select(
            F.col("c_custkey").alias("codaux"), F.col("c_name").alias("nomaux")
        ),
        sales_docs=orders.select(
            F.col("o_orderpriority").alias("tipo"),
            F.col("o_orderkey").alias("folio"),
            money("o_totalprice").alias("netoafecto"),
            F.when(F.col("o_custkey") % 10 != 0, (F.col("o_custkey") % 100).cast("decimal(18,2)")).alias("netoexento"),
            F.col("o_orderdate").alias("fecha"),
            F.col("o_custkey").alias("codaux"),
            F.col("o_orderstatus").alias("estado"),
        ),
        month_sales=items.groupBy(
            month.cast("string").alias("mes"),
            F.col("l_returnflag").alias("tipo"),
            F.col("l_linestatus").alias("codbode"),
            product.cast("string").alias("codprod"),
        ).agg(F.sum(money("l_extendedprice")).alias("total")),
        products=part.select(
            F.col("p_partkey").cast("string").alias("codprod"),
            F.col("p_name").alias("desprod"),
            F.col("p_brand").alias("codgrupo"),
            F.col("p_type").alias("codsubgr"),
            F.lower("p_type").alias("codumed"),
            account_code(F.col("p_partkey")).alias("ctaactivo"),
            account_code(F.col("p_partkey") + 1).alias("ctaventas"),
            account_code(F.col("p_partkey") + 2).alias("ctacosto"),
            account_code(F.col("p_partkey") + 3).alias("ctagastos"),
            F.expr("timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(p_size)").alias("fechaulmod"),
        ),
        product_attributes=part.select(
            F.col("p_partkey").cast("string").alias("codigo"),
            (F.col("p_size") % 3).alias("codtat"),
            F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("valor"),
        ),
        posted_state=POSTED,
    )


@lru_cache(maxsize=8)
def company_ledger(spark: SparkSession, folder: str) -> Ledger:
    """The same vouchers dealt out to four companies, which share the dimension tables."""
    single = ledger(spark, folder)
    company = F.concat(F.lit("CO"), (F.col("cpbnum") % 4).cast("string"))
    return single.with_tables(
        lines=single.lines.withColumn(COMPANY, company),
        headers=single.headers.withColumn(COMPANY, company),
        scope=(COMPANY,),
    )


def invoices(orders: DataFrame) -> DataFrame:
    named = F.col("o_orderpriority") != "4-NOT SPECIFIED"
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(named, F.concat(F.lit("DOC/"), F.col("o_orderkey"))).alias("name"),
        F.col("o_orderstatus").alias("type"),
        F.col("o_orderpriority").alias("state"),
        F.col("o_orderdate").alias("date"),
        (F.col("o_orderdate") + F.expr("interval 1 day")).alias("date_invoice"),
        F.col("o_custkey").alias("partner_id"),
        (F.col("o_orderkey") % 26).alias("company_id"),
        F.when(F.col("o_custkey") % 3 == 0, _zero()).otherwise(money("o_totalprice")).alias("residual_company_signed"),
        F.col("o_orderdate").alias("write_date"),
    )


@lru_cache(maxsize=8)
def erp(spark: SparkSession, folder: str) -> Erp:
    items, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    line_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    partner, company = F.floor(F.col("l_orderkey") / 10), F.col("l_orderkey") % 26
    return Erp(
        move_lines=items.select(
            line_id.alias("id"),
            F.col("l_partkey").alias("account_id"),
            company.alias("company_id"),
            F.when(F.col("l_linenumber") != 7, partner).alias("partner_id"),
            F.col("l_linenumber").cast("bigint").alias("journal_id"),
            _signed().alias("balance"),
            F.when(F.col("l_linestatus") == "O", _signed()).otherwise(_zero()).alias("amount_residual"),
            F.when(F.col("l_linestatus") == "F", _signed()).otherwise(_zero()).alias("balance_cash_basis"),
            F.col("l_shipdate").alias("date"),
            F.col("l_shipdate").alias("write_date"),
        ),
        accounts=part.select(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("code"), F.col("p_type").alias("name")
        ),
        companies=table(spark, folder, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name")
        ),
        partners=table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        invoices=invoices(table(spark, folder, "orders")),
        invoice_lines=items.select(
            line_id.alias("id"),
            F.concat_ws("/", "l_returnflag", "l_linestatus").alias("name"),
            partner.alias("partner_id"),
            F.when(F.col("l_linenumber") != 7, F.col("l_partkey")).alias("product_id"),
            F.col("l_orderkey").alias("invoice_id"),
            company.alias("company_id"),
            _signed().alias("price_subtotal_signed"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_shipdate").alias("write_date"),
        ),
        product_variants=part.select(
            F.col("p_partkey").alias("id"), (F.col("p_partkey") - F.col("p_partkey") % 2).alias("product_tmpl_id")
        ),
        product_templates=part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
    )
