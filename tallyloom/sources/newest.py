"""The newest export in a folder. An export is a file, or a directory of part files as Spark writes it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import exists


def newest_export(spark: SparkSession, folder: str, pattern: str = "*") -> str:
    """Path of the finished export modified last; equal times are settled by name.

    The binary source lists files without opening them as long as the content column is not asked for, and they are
    ordered on the executors. An export that is a directory is finished once it holds ``_SUCCESS``, which Spark
    writes last; until then the one before it counts.
    """
    folder = folder.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    below = re.sub(r"^[a-z0-9]+:/+", "/", folder, flags=re.IGNORECASE)
    name = F.regexp_extract("path", re.escape(below) + "/([^/]+)", 1)
    exports = files.groupBy(name.alias("name")).agg(
        F.max("modificationTime").alias("at"), F.bool_or(~F.endswith("path", F.concat(F.lit("/"), name))).alias("in_parts")
    )
    for export in exports.orderBy(F.desc("at"), F.desc("name")).toLocalIterator():
        path = f"{folder}/{export['name']}"
        if not export["in_parts"] or exists(spark, f"{path}/_SUCCESS"):
            return path
    raise FileNotFoundError(f"no finished export matching {pattern} in {folder}")


def load_newest(
    spark: SparkSession, folder: str, file_format: str = "csv", pattern: str = "*", schema: str | None = None, **options
) -> DataFrame:
    """All rows of the newest export (CSV, JSON or parquet). Older exports are not read."""
    if file_format == "csv":
        options = {"header": "true", **options}
    reader = spark.read.format(file_format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(newest_export(spark, folder, pattern))
