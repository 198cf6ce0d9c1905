"""Tables of the replicated ERP database. ``id`` is the primary key of every table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources.schemas import ERP_COLUMNS, ERP_TABLES, column_names


@dataclass(frozen=True)
class Erp:
    move_lines: DataFrame | None = None
    accounts: DataFrame | None = None
    companies: DataFrame | None = None
    partners: DataFrame | None = None
    invoices: DataFrame | None = None
    invoice_lines: DataFrame | None = None
    product_variants: DataFrame | None = None
    product_templates: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, root: str, names: Mapping[str, str] = ERP_TABLES) -> Erp:
        """Parquet tables under ``root``. All their columns are kept, because some reports show whole rows."""
        tables = {table: spark.read.parquet(f"{root}/{name}") for table, name in names.items()}
        for table, df in tables.items():
            missing = set(column_names(ERP_COLUMNS[table])) - {name.lower() for name in df.columns}
            if missing:
                raise ValueError(f"{table} lacks {sorted(missing)}")
        return cls(**tables)
