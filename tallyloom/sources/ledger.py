"""The ledger: journal lines, voucher headers and their dimension tables, of one company or of several."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.schemas import KEY, LEDGER_COLUMNS, LEDGER_TABLES, column_names

if TYPE_CHECKING:
    from tallyloom.sources.collation import Collation

COMPANY = "company"


@dataclass(frozen=True)
class Ledger:
    """Tables of a ledger plus the two codes that depend on the installation.

    ``journal`` holds lines already joined to their headers (see ``operators.journal``). ``scope`` names the columns
    that separate companies inside one set of tables; it is empty for a single company. ``collation`` is how codes are
    compared, where the tables have keys for that (see ``sources.collation``); without one they are compared as written.
    """

    lines: DataFrame | None = None
    headers: DataFrame | None = None
    centers: DataFrame | None = None
    details: DataFrame | None = None
    accounts: DataFrame | None = None
    doc_types: DataFrame | None = None
    counterparties: DataFrame | None = None
    sales_docs: DataFrame | None = None
    month_sales: DataFrame | None = None
    products: DataFrame | None = None
    product_attributes: DataFrame | None = None
    journal: DataFrame | None = None
    posted_state: str = "V"
    opening_month: str = "00"
    scope: tuple[str, ...] = ()
    collation: Collation | None = None

    def tables(self) -> dict[str, DataFrame]:
        found = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in found.items() if isinstance(df, DataFrame)}

    def with_tables(self, **tables) -> Ledger:
        return replace(self, **tables)

    @classmethod
    def read(cls, spark: SparkSession, root: str, names: Mapping[str, str] = LEDGER_TABLES, **settings) -> Ledger:
        """Parquet tables under ``root``, named as in the source database unless ``names`` says otherwise."""
        tables = {
            table: read_declared(
                spark, f"{root}/{name}", LEDGER_COLUMNS[table], settings.get("scope", ()), settings.get("collation") is not None
            )
            for table, name in names.items()
        }
        return cls(**tables, **settings)

    @classmethod
    def combine(cls, companies: Mapping[str, Ledger]) -> Ledger:
        """Several companies as one ledger with a ``company`` column, so that a report runs once over all of them."""
        parts = {name: ledger.tables() for name, ledger in companies.items()}
        first = next(iter(companies.values()))
        known = set.union(*(set(tables) for tables in parts.values()))
        lacking = {name: sorted(known - set(tables)) for name, tables in parts.items() if known - set(tables)}
        if lacking:
            raise ValueError(f"companies lack tables that others have: {lacking}")
        settings = {(ledger.posted_state, ledger.opening_month, ledger.collation) for ledger in companies.values()}
        if len(settings) > 1:
            raise ValueError("companies with different state or opening-month codes or collations cannot be combined")
        combined = {
            table: reduce(
                DataFrame.unionByName,
                [tables[table].withColumn(COMPANY, F.lit(name)) for name, tables in parts.items()],
            )
            for table in known
        }
        return replace(
            cls(posted_state=first.posted_state, opening_month=first.opening_month, scope=(COMPANY,), collation=first.collation),
            **combined,
        )


def read_declared(spark: SparkSession, path: str, ddl: str, extra: tuple[str, ...] = (), keys: bool = False) -> DataFrame:
    """A parquet table reduced to its declared columns, in lower case, and ``keys`` if it has been staged with them; a missing
    column fails the analysis.

    ``extra`` columns (the company) are kept where the table has them, so that companies may share a dimension.
    """
    df = spark.read.parquet(path)
    present = {name.lower() for name in df.columns}
    wanted = [name for name in extra if name in present] + column_names(ddl)
    wanted += sorted(name for name in present if keys and name.endswith(KEY))
    return df.select(*[F.col(name).alias(name) for name in wanted])
