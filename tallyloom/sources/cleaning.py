"""One-time cleaning of raw ledger tables, so that reports can compare codes plainly and push filters down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.money import MONEY
from tallyloom.operators.pointer import Versions
from tallyloom.session import sized_shuffles
from tallyloom.sources.ledger import Ledger
from tallyloom.sources.collation import Collation, collate_ledger
from tallyloom.sources.schemas import DESCRIPTIONS, LEDGER_COLUMNS, LEDGER_TABLES, YEAR_KEY


def clean_table(df: DataFrame, table: str) -> DataFrame:
    """Codes without trailing blanks, years as numbers, money as decimals.

    The source databases ignore trailing blanks when they compare strings and compare year strings with numbers. A year
    that is no number is NULL where a report compares or shows years; ``YEAR_KEY`` keeps it for the join of lines and
    headers, so that its vouchers stay.
    """
    declared = {part.split()[0]: part.split()[1] for part in LEDGER_COLUMNS[table].split(", ")}

    def cleaned(field: T.StructField):
        name, column = field.name.lower(), F.col(field.name)
        if declared.get(name) == "INT" and isinstance(field.dataType, T.StringType):
            column = column.try_cast("int")
        elif declared.get(name, "").startswith("DECIMAL"):
            column = column.cast(MONEY)
        elif isinstance(field.dataType, T.StringType) and name not in DESCRIPTIONS:
            column = F.rtrim(column)
        return column.alias(name)

    columns = [cleaned(field) for field in df.schema.fields]
    years = [f.name for f in df.schema.fields if f.name.lower() == "cpbano" and isinstance(f.dataType, T.StringType)]
    if years and table in ("lines", "headers"):
        number = F.col(years[0]).try_cast("int").cast("string")
        columns.append(F.coalesce(number, F.rtrim(F.col(years[0]))).alias(YEAR_KEY))
    return df.select(*columns)


def clean_ledger(raw: Ledger) -> Ledger:
    return raw.with_tables(
        **{name: clean_table(df, name) for name, df in raw.tables().items() if name in LEDGER_COLUMNS}
    )


def stage_ledger(raw: Ledger, root: str, collation: Collation | None = None) -> Ledger:
    """Clean every table and write it once, so that reports read files instead of asking the database each time.

    With a ``collation`` the files also hold the keys by which codes are compared under it.

    Lines and headers are written by year and rebalanced, which splits a year that holds most of the rows. The tables of
    a run lie together in a new folder, and the run before stays readable until the one after.
    """
    tidy = clean_ledger(raw)
    if collation is not None:
        tidy = collate_ledger(tidy, collation)
    cleaned = {name: df for name, df in tidy.tables().items() if name in LEDGER_TABLES}
    spark = next(iter(cleaned.values())).sparkSession
    versions = Versions(spark, root)
    folder = versions.new()
    for name, df in cleaned.items():
        if name in ("lines", "headers"):
            writer = df.hint("rebalance", "cpbano").write.partitionBy("cpbano")
        else:
            writer = df.write
        with sized_shuffles(df):
            writer.parquet(f"{folder}/{LEDGER_TABLES[name]}")
    versions.switch(folder)
    # With the columns that were written, so that an empty table, which leaves no file, is read as such.
    staged = {
        name: spark.read.schema(df.schema).parquet(f"{folder}/{LEDGER_TABLES[name]}").select(*df.columns)
        for name, df in cleaned.items()
    }
    return Ledger(
        **staged, posted_state=raw.posted_state, opening_month=raw.opening_month, scope=raw.scope, collation=collation
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes NULL; every other value stays."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.when(~F.isnan(n), F.col(n)).alias(n) if n in floating else F.col(n) for n in df.columns]
    )
