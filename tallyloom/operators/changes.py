"""Changed rows since a cutoff, and their merge into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.dates import wall_clock

WRITE_DATE = "write_date"
UNORDERED = (T.MapType, T.VariantType)
# Bitmaps of ids, 4 KB for 32,768 neighbouring ids each, are sent to all executors up to this size in all.
MOST_BITMAPS = 64 << 20
BITMAP_BYTES = 4096


def changed_rows(table: DataFrame, cutoff: datetime | str | None, column: str = WRITE_DATE) -> DataFrame:
    """All columns of the rows written strictly after ``cutoff``; every row when there is no cutoff yet."""
    if cutoff is None:
        return table
    return table.where(F.col(column) > wall_clock(cutoff))


def latest_per_key(rows: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]) -> DataFrame:
    """The newest row of each key. Rows that are equal there are settled by all their other columns, so the same rows
    give the same result however they are partitioned.

    A key with very many versions is cut to one row per map task before the shuffle (group limit on row_number).
    """
    rest = [f.name for f in rows.schema.fields if f.name not in {*keys, *newest} and not isinstance(f.dataType, UNORDERED)]
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in [*newest, *rest]]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def upsert_merge(
    base: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    write_date: str = WRITE_DATE,
    ties: Sequence[str] = (),
) -> DataFrame:
    """``base`` with the rows of ``delta`` put in by key: the newer write date wins, and at equal dates the delta.

    ``base`` holds each key once. Only the delta is reduced to its newest versions; the two are then joined on the
    key, one shuffle with at most one row per key and side, rather than ranking the union of both. Applying the same
    delta twice, or an older one after a newer one, changes nothing. A column that only one of them has is NULL in the
    rows of the other.
    """
    columns = [*base.columns, *(c for c in delta.columns if c not in base.columns)]
    base, delta = (
        df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in columns])
        for df, other in ((base, delta), (delta, base))
    )
    newest = latest_per_key(delta, keys, [write_date, *ties])
    old = base.select(*keys, F.struct(*columns).alias("old"))
    new = newest.select(*keys, F.struct(*columns).alias("new"))
    joined = old.join(new, list(keys), "full_outer")
    old_date, new_date = F.col(f"old.{write_date}"), F.col(f"new.{write_date}")
    old_wins = F.col("new").isNull() | (
        F.col("old").isNotNull() & F.coalesce(old_date > new_date, old_date.isNotNull() & new_date.isNull())
    )
    picked = joined.select(F.when(old_wins, F.col("old")).otherwise(F.col("new")).alias("row"))
    return picked.select("row.*")


@dataclass(frozen=True)
class Brought:
    """The ids that a batch brings, as bitmaps: all of them, and those ``contested`` by several rows or a newer row of the table.

    A row whose id the batch doesn't bring stays as it is, and so does one of the batch whose id is not contested; only
    contested rows are compared as whole rows. What is shuffled to find that out is an id and a write date per row.
    """

    bitmaps: DataFrame
    key: str
    contested: int

    @classmethod
    def of(cls, base: DataFrame | None, delta: DataFrame, key: str, path: str, write_date: str = WRITE_DATE) -> Brought | None:
        """Bitmaps kept under ``path``; None where they would be too large, or columns differ in type."""
        spark, sides = delta.sparkSession, [delta] if base is None else [base, delta]
        if any(write_date not in side.columns for side in sides):
            return None
        if base is not None and any(base.schema[c].dataType != delta.schema[c].dataType for c in delta.columns if c in base.columns):
            return None
        number = F.col(key).cast("long")
        dated = [
            side.select(
                F.bitmap_bucket_number(number).alias("bucket"),
                F.bitmap_bit_position(number).alias("bit"),
                *[(F.col(write_date) if side is own else F.lit(None).cast(side.schema[write_date].dataType)).alias(name) for name, own in (("old", base), ("new", delta))],
                F.lit(side is delta).alias("brought"),
            )
            for side in sides
        ]
        rows = dated[0] if base is None else dated[0].union(dated[1])
        # Dealt out by bucket, so that an id's rows and a bucket's ids meet after one shuffle.
        ids = rows.repartition("bucket").groupBy("bucket", "bit").agg(
            F.count_if("brought").alias("n"), F.max("old").alias("old"), F.max("new").alias("new")
        )
        contested = (F.col("n") > 1) | F.coalesce(F.col("old") > F.col("new"), F.col("old").isNotNull() & F.col("new").isNull())
        ids = ids.where("n > 0").withColumn("contested", contested)
        some = F.count_if("contested")
        bitmaps = ids.groupBy("bucket").agg(
            F.bitmap_construct_agg("bit").alias("brought"),
            F.when(some > 0, F.bitmap_construct_agg(F.when(F.col("contested"), F.col("bit")))).alias("contested"),
            some.alias("n_contested"),
        )
        bitmaps.write.parquet(path)
        bitmaps = spark.read.parquet(path)
        filled, contests, total = bitmaps.agg(F.count("*"), F.count("contested"), F.sum("n_contested")).first()
        return cls(bitmaps, key, total or 0) if (filled + contests) * BITMAP_BYTES <= MOST_BITMAPS else None

    @classmethod
    def read(cls, spark: SparkSession, paths: Sequence[str], key: str) -> Brought | None:
        """The ids of several batches together; None where their bitmaps are too large."""
        kept = spark.read.parquet(*paths)
        if kept.count() * BITMAP_BYTES > MOST_BITMAPS:
            return None
        return cls(kept.groupBy("bucket").agg(F.bitmap_or_agg("brought").alias("brought")), key, 0)

    def of_batch(self, rows: DataFrame) -> DataFrame:
        """The rows whose ids the batch brings."""
        return self._where(rows, "brought", True)

    def _where(self, rows: DataFrame, bitmap: str, held: bool) -> DataFrame:
        """The rows whose ids the bitmap holds, or the others, where they are."""
        number = F.col(self.key).cast("long")
        maps = F.broadcast(self.bitmaps.where(F.col(bitmap).isNotNull()).select(F.col("bucket").alias("__bucket"), F.col(bitmap).alias("__bits")))
        bit = F.bitmap_bit_position(number)
        byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        found = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
        joined = rows.join(maps, F.bitmap_bucket_number(number) == F.col("__bucket"), "left")
        return joined.where(found if held else ~found).select(*rows.columns)

    def merge(self, base: DataFrame | None, delta: DataFrame, ties: Sequence[str] = (), write_date: str = WRITE_DATE) -> DataFrame:
        """What ``upsert_merge`` gives, or ``latest_per_key`` of the batch where there is no ``base``."""
        parts = [] if base is None else [self._where(base, "brought", False)]
        if not self.contested:
            parts.append(delta)
        else:
            parts.append(self._where(delta, "contested", False))
            rows = self._where(delta, "contested", True)
            if base is None:
                parts.append(latest_per_key(rows, [self.key], [write_date, *ties]))
            else:
                parts.append(upsert_merge(self._where(base, "contested", True), rows, [self.key], write_date, ties))
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part, allowMissingColumns=True)
        return merged
