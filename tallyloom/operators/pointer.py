"""Which folder holds the current version of something that is written anew each time."""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import remove_folder

STATE = "seq BIGINT, current STRING, previous STRING"


class Versions:
    """Folders under ``root``, one for each version, and the number of the current one.

    A new version is written beside the others and then named as current, in a file that takes turns between two
    places. A run that fails leaves the current version as it was, and a reader of it stays undisturbed by the next one;
    what is older is removed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _row(self) -> Row | None:
        sides: list[DataFrame] = []
        for side in "ab":
            try:
                sides.append(self.spark.read.schema(STATE).parquet(f"{self.root}/current-{side}"))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
        rows = [row for side in sides for row in side.collect()]  # one row each
        return max(rows, key=lambda row: row["seq"], default=None)

    def current(self) -> str | None:
        row = self._row()
        return f"{self.root}/{row['current']}" if row is not None else None

    def new(self) -> str:
        """A folder to write the next version to."""
        return f"{self.root}/version-{uuid4().hex}"

    def switch(self, path: str) -> None:
        """Name ``path``, which ``new`` has given, as current."""
        row = self._row()
        seq = 1 + (row["seq"] if row is not None else 0)
        self.spark.range(1, numPartitions=1).select(
            F.lit(seq).cast("long").alias("seq"),
            F.lit(path.rpartition("/")[2]).alias("current"),
            F.lit(row["current"] if row is not None else None).cast("string").alias("previous"),
        ).write.mode("overwrite").parquet(f"{self.root}/current-{'ab'[seq % 2]}")
        if row is not None and row["previous"] is not None:
            remove_folder(self.spark, f"{self.root}/{row['previous']}")
