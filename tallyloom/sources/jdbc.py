"""Scans of the source databases over JDBC, split into ranges so that executors read in parallel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources.erp import Erp
from tallyloom.sources.ledger import Ledger
from tallyloom.sources.schemas import ERP_TABLES, LEDGER_TABLES


def jdbc_options(
    url: str,
    source: str,
    *,
    split_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a table name or a query text.

    With ``split_column`` the scan becomes ``partitions`` range scans between ``lower`` and ``upper``; rows outside
    the range fall into the first and last of them, so no row is lost.
    """
    is_query = source.lstrip().lower().startswith(("select ", "with "))
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if split_column is None:
        options["query" if is_query else "dbtable"] = source
        return options
    if lower is None or upper is None:
        raise ValueError("a split scan needs lower and upper")
    # The "query" option does not combine with a split column; a derived table does.
    options["dbtable"] = f"({source}) q" if is_query else source
    options["partitionColumn"] = split_column
    options["lowerBound"], options["upperBound"] = str(lower), str(upper)
    options["numPartitions"] = str(partitions)
    return options


def scan(spark: SparkSession, url: str, source: str, **options) -> DataFrame:
    """One table or query of a database. Filters and column choice made on the result are sent to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, source, **options)).load()


def scan_tables(
    spark: SparkSession,
    url: str,
    names: Mapping[str, str],
    *,
    schema: str | None = None,
    splits: Mapping[str, Mapping[str, object]] | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Several tables with lower-case columns. ``splits`` gives split_column, lower, upper and partitions per table."""
    splits = splits or {}
    tables = {}
    for table, name in names.items():
        source = f"{schema}.{name}" if schema else name
        df = scan(spark, url, source, **{**options, **splits.get(table, {})})
        tables[table] = df.toDF(*[column.lower() for column in df.columns])
    return tables


def scan_ledger(spark: SparkSession, url: str, names: Mapping[str, str] = LEDGER_TABLES, **options) -> Ledger:
    return Ledger(**scan_tables(spark, url, names, **options))


def scan_erp(spark: SparkSession, url: str, names: Mapping[str, str] = ERP_TABLES, **options) -> Erp:
    return Erp(**scan_tables(spark, url, names, **options))
