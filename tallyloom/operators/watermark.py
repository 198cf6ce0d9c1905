"""The cutoff up to which a replication has read its source."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.dates import utc_now, wall_clock

STATE = "seq BIGINT, cutoff TIMESTAMP_NTZ, recorded_at TIMESTAMP_NTZ"


class Watermark:
    """Each advance is one row with the next number, written over the older of two sides.

    The highest number counts, whatever the clock says; a job that dies while writing keeps the old value, and two files
    are all there ever are.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def state(self) -> DataFrame:
        """The current row: ``seq``, ``cutoff``, ``recorded_at``; none before the first advance."""
        sides = []
        for side in "ab":
            try:
                sides.append(self.spark.read.schema(STATE).parquet(f"{self.path}/{side}"))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
        rows = sides[0].union(sides[1]) if len(sides) == 2 else sides[0] if sides else self.spark.createDataFrame([], STATE)
        latest = rows.agg(F.max(F.struct("seq", "cutoff", "recorded_at")).alias("latest")).where("latest is not null")
        return latest.select("latest.*")

    def read(self) -> datetime | None:
        """The current cutoff, or None before the first run."""
        row = self.state().first()
        return row["cutoff"] if row is not None else None

    def advance(self, cutoff: datetime) -> None:
        row = self.state().first()
        seq = 1 + (row["seq"] if row is not None else 0)
        self.spark.range(1, numPartitions=1).select(
            F.lit(seq).cast("long").alias("seq"),
            wall_clock(cutoff).alias("cutoff"),
            wall_clock(utc_now()).alias("recorded_at"),
        ).write.mode("overwrite").parquet(f"{self.path}/{'ab'[seq % 2]}")
