"""Run log: one row when a report starts and one when it ends.

Each report's rows lie in a folder of its own. Runs are numbered; rows of ``FOLD_EVERY`` runs share a folder, and once they are
over they are put together with all earlier ones in one file.
"""

from __future__ import annotations

from datetime import datetime
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.dates import wall_clock
from tallyloom.operators.changes import latest_per_key
from tallyloom.session import remove_folder

RUN_LOG_SCHEMA = (
    "report STRING, run_id STRING, seq BIGINT, started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, status STRING, "
    "row_count BIGINT, message STRING, path STRING, schema_json STRING"
)
FOLD_EVERY = 10


def report_folder(log_path: str, report: str) -> str:
    return f"{log_path}/{quote(report, safe='')}"


def append_run(spark: SparkSession, log_path: str, **values: str | int | datetime | None) -> None:
    fields = [part.split() for part in RUN_LOG_SCHEMA.split(", ")]
    row = spark.range(1, numPartitions=1).select(
        *[
            (wall_clock(values[name]) if isinstance(values.get(name), datetime) else F.lit(values.get(name)))
            .cast(kind)
            .alias(name)
            for name, kind in fields
        ]
    )
    row.write.mode("append").parquet(f"{report_folder(log_path, values['report'])}/runs-{values['seq'] // FOLD_EVERY}")


def fold_runs(spark: SparkSession, log_path: str, report: str, seq: int) -> None:
    """With the first run of a new folder, put all rows before it into one file."""
    part = seq // FOLD_EVERY
    if seq % FOLD_EVERY or not part:
        return
    folder = report_folder(log_path, report)
    rows = read_log(spark, log_path, report).where(F.col("seq") < seq)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/folded-{part}")
    for old in (f"runs-{part - 1}", f"folded-{part - 1}"):
        remove_folder(spark, f"{folder}/{old}")


def read_log(spark: SparkSession, log_path: str, report: str | None = None) -> DataFrame:
    """The rows of one report, or of all. A fold that died half-way has left rows twice, which count once."""
    path = log_path if report is None else report_folder(log_path, report)
    try:
        files = spark.read.schema(RUN_LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], RUN_LOG_SCHEMA)
        raise
    return files.distinct()


def latest_runs(log: DataFrame, report: str = "report", newest: tuple[str, ...] = ("seq", "finished_at")) -> DataFrame:
    """The latest run of each report. A run that never ended shows a start and no end."""
    return latest_per_key(log, [report], newest)


def latest_finished(log: DataFrame) -> DataFrame:
    """The finished run with the highest number, whatever the clock said."""
    return latest_runs(log.where(F.col("status") == "ok"))
