"""Exports with malformed rows: those go to a quarantine beside the load, and too many of them stop it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.pointer import Versions
from tallyloom.sources.newest import newest_export

RAW, FILE, BAD = "_raw", "_file", "_bad"


class MalformedExport(ValueError):
    """An export has more malformed rows than allowed; the load before it is still the current one."""


@dataclass(frozen=True)
class Checked:
    """A load: its rows, and the malformed ones as ``_raw`` lines with the ``_file`` they come from."""

    rows: DataFrame
    malformed: DataFrame
    n_rows: int
    n_malformed: int


class CheckedLoads:
    """Loads of CSV or JSON exports with a declared schema, under ``root``, one after another.

    A row is malformed if a value isn't of its column's type or, in CSV, if it has more or fewer fields than the schema; other
    readers make NULL of the first and lose fields of the second. CSV headers must name the columns of the schema in its
    order. The export is parsed once and written as Parquet, malformed rows in a partition of their own. If they are over
    ``most_malformed`` of all rows, ``MalformedExport`` is raised and the load before stays current.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str | T.StructType, most_malformed: float = 0.0):
        self.spark = spark
        self.versions = Versions(spark, root)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.most_malformed = most_malformed
        if {RAW, FILE, BAD} & set(self.schema.names):
            raise ValueError(f"{RAW}, {FILE} and {BAD} are reserved names")

    def load(self, folder: str, file_format: str = "csv", pattern: str = "*", **options) -> Checked:
        """Load the newest export of ``folder`` and make it current."""
        if file_format not in ("csv", "json"):
            raise ValueError(f"rows of {file_format} can't be malformed; use load_newest")
        if file_format == "csv":
            options = {"header": "true", "enforceSchema": "false", **options}
        # A corrupt row that is NULL in a column declared NOT NULL must still be readable.
        fields = [T.StructField(f.name, f.dataType) for f in self.schema.fields]
        parsed = (
            self.spark.read.format(file_format)
            .options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW)
            .schema(T.StructType([*fields, T.StructField(RAW, T.StringType())]))
            .load(newest_export(self.spark, folder, pattern))
        )
        path = self.versions.new()
        landed = parsed.withColumns({FILE: F.col("_metadata.file_path"), BAD: F.col(RAW).isNotNull()})
        landed.write.partitionBy(BAD).parquet(path)
        done = self._read(path)
        if done.n_malformed > self.most_malformed * (done.n_rows + done.n_malformed):
            raise MalformedExport(f"{done.n_malformed} of {done.n_rows + done.n_malformed} rows are malformed; they are in {path}")
        self.versions.switch(path)
        return done

    def _read(self, path: str) -> Checked:
        fields = [T.StructField(f.name, f.dataType) for f in self.schema.fields]
        fields += [T.StructField(RAW, T.StringType()), T.StructField(FILE, T.StringType()), T.StructField(BAD, T.BooleanType())]
        landed = self.spark.read.schema(T.StructType(fields)).parquet(path)
        rows = landed.where(~F.col(BAD)).select(*self.schema.names)
        malformed = landed.where(F.col(BAD)).select(RAW, FILE)
        return Checked(rows, malformed, rows.count(), malformed.count())

    def current(self) -> Checked:
        """The last load that was not refused."""
        path = self.versions.current()
        if path is None:
            raise LookupError(f"nothing has been loaded to {self.versions.root} yet")
        return self._read(path)
