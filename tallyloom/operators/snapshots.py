"""Full-refresh report output.

Each report has two directories. A run overwrites the one that is not current, and the run log then names it as
current. A failed run leaves the current snapshot in place, readers of it stay undisturbed until the run after next,
and storage does not grow with the number of runs. An empty result is a snapshot with its columns and no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.dates import utc_now
from tallyloom.operators.runlog import append_run, fold_runs, latest_finished, read_log


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], datetime] = utc_now):
        self.spark = spark
        self.root = root.rstrip("/")
        self.clock = clock

    @property
    def log_path(self) -> str:
        return f"{self.root}/run_log"

    def log(self) -> DataFrame:
        return read_log(self.spark, self.log_path)

    def write(
        self,
        report: str,
        result: DataFrame | Callable[[], DataFrame],
        partition_by: Sequence[str] = (),
        order_by: Sequence[str | Column] = (),
    ) -> int:
        """Write a result as the new snapshot of ``report`` and return its row count.

        A callable is evaluated inside the logged run, so that an error while building the report is logged too.
        Partitioned output is rebalanced, which splits a company that holds most of the rows. That undoes the result's
        own order, whose sort Spark then leaves out; with ``order_by`` the rows of each file are sorted afterwards.
        Runs are numbered, and the highest number that has finished is current. A report has one writer at a time.
        """
        before = read_log(self.spark, self.log_path, report).agg(F.max("seq")).first()[0]
        seq = 0 if before is None else before + 1
        run = {"report": report, "run_id": uuid4().hex, "seq": seq, "started_at": self.clock()}
        fold_runs(self.spark, self.log_path, report, seq)
        append_run(self.spark, self.log_path, **run, status="started")
        try:
            df = result() if callable(result) else result
            path = self._spare_path(report)
            if partition_by:
                dealt = df.hint("rebalance", *partition_by)
                if order_by:
                    dealt = dealt.sortWithinPartitions(*partition_by, *order_by)
                dealt.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
            else:
                (df.orderBy(*order_by) if order_by else df).write.mode("overwrite").parquet(path)
            # Counted from the footers of the files just written; an observed metric is lost when the optimizer
            # replaces an empty result.
            rows = self.spark.read.schema(df.schema).parquet(path).count()
        except Exception as error:
            append_run(
                self.spark,
                self.log_path,
                **run,
                finished_at=self.clock(),
                status="failed",
                message=f"{type(error).__name__}: {error}",
            )
            raise
        append_run(
            self.spark,
            self.log_path,
            **run,
            finished_at=self.clock(),
            status="ok",
            row_count=rows,
            path=path,
            schema_json=df.schema.json(),
        )
        return rows

    def _current(self, report: str) -> Row | None:
        return latest_finished(read_log(self.spark, self.log_path, report)).select("path", "schema_json").first()

    def _spare_path(self, report: str) -> str:
        first, second = (f"{self.root}/reports/{report}/{side}" for side in ("a", "b"))
        current = self._current(report)
        return second if current is not None and current["path"] == first else first

    def read(self, report: str) -> DataFrame:
        """The current snapshot of a report."""
        current = self._current(report)
        if current is None:
            raise LookupError(f"no finished run of {report}")
        schema = T.StructType.fromJson(json.loads(current["schema_json"]))
        return self.spark.read.schema(schema).parquet(current["path"]).select(*schema.fieldNames())
