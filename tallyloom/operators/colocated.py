"""Lines and headers stored together: both in the same buckets of the voucher key, so that a join of them shuffles nothing.

A bucket is joined by one task, so vouchers with very many lines are kept apart: their lines lie in a table of their own and meet
their few headers in an ordinary join, which adaptive execution can split. There can be no more of them than all lines divided by
the lines that make a voucher hot.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.journal import header_columns, joined, voucher_keys
from tallyloom.operators.pointer import Versions
from tallyloom.session import scanned_bytes, sized_shuffles
from tallyloom.sources.ledger import Ledger

BUCKET_BYTES = 256 << 20
HOT_LINES = 1_000_000
LAYOUT = "buckets INT"


def bucketed(spark: SparkSession, path: str, schema: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """The files under ``path`` as a table whose buckets Spark knows; only its description is in the session's catalog."""
    name = f"tallyloom_{uuid4().hex}"
    columns = schema.limit(0)._jdf.schema().toDDL()
    named = ", ".join(f"`{key}`" for key in keys)
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by ({named}) sorted by ({named}) "
        f"into {buckets} buckets location '{path}'"
    )
    return spark.table(name)


def write_bucketed(rows: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """One file a bucket, sorted by key, so that a year's lines lie together in each of them as well."""
    name = f"tallyloom_{uuid4().hex}"
    dealt = rows.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    rows.sparkSession.sql(f"drop table {name}")  # the description; the files stay


def stage_colocated(ledger: Ledger, root: str, buckets: int | None = None, hot_lines: int = HOT_LINES) -> Ledger:
    """Write lines and headers in equal buckets and return a ledger whose journal is their join without a shuffle.

    Buckets are as many as the lines fill with ``BUCKET_BYTES``, unless they are given; vouchers with more than ``hot_lines`` lines are
    kept apart. Staging again writes beside what is there, which stays readable.
    """
    spark, keys = ledger.lines.sparkSession, voucher_keys(ledger)
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-scanned_bytes(ledger.lines) // BUCKET_BYTES))
    versions = Versions(spark, root)
    folder = versions.new()
    headers = header_columns(ledger, keys)
    with sized_shuffles(ledger.lines):
        counted = ledger.lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines")).where(F.col("n_lines") > hot_lines)
        counted.select(*keys).write.parquet(f"{folder}/hot")
        hot = spark.read.schema(counted.select(*keys).schema).parquet(f"{folder}/hot")
        for name, rows in (("lines", ledger.lines), ("headers", headers)):
            # A line whose key is incomplete meets no header, here as in any join.
            write_bucketed(rows.join(hot, keys, "left_anti").select(*rows.columns), f"{folder}/{name}", keys, buckets)
            rows.join(hot, keys, "left_semi").select(*rows.columns).write.parquet(f"{folder}/hot-{name}")
    spark.range(1, numPartitions=1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{folder}/layout")
    versions.switch(folder)
    return _opened(ledger, folder)


def colocated_ledger(ledger: Ledger, root: str) -> Ledger:
    """``ledger`` with the journal of what was last staged at ``root``."""
    folder = Versions(ledger.lines.sparkSession, root).current()
    if folder is None:
        raise LookupError(f"nothing has been staged at {root}")
    return _opened(ledger, folder)


def _opened(ledger: Ledger, folder: str) -> Ledger:
    spark, keys = ledger.lines.sparkSession, voucher_keys(ledger)
    buckets = spark.read.schema(LAYOUT).parquet(f"{folder}/layout").head()["buckets"]
    schemas = {"lines": ledger.lines, "headers": header_columns(ledger, keys)}
    cold = {name: bucketed(spark, f"{folder}/{name}", df, keys, buckets) for name, df in schemas.items()}
    hot = {name: spark.read.schema(df.schema).parquet(f"{folder}/hot-{name}") for name, df in schemas.items()}
    parts = [joined(side["lines"], side["headers"], keys) for side in (cold, hot)]
    return ledger.with_tables(journal=parts[0].unionByName(parts[1]))
