"""Repair of replicated tables where reading by write date has missed something.

Rows deleted in the source, and rows that commit late with a write date before the watermark, never come with a batch of changes. A
repair finds them by digests: both sides sum up, range by range of the key, a hash of each row, in no order. Ranges whose digests
differ are compared again in narrower ranges, and only the rows of the narrowest differing ones are read from the source. They
replace what the replica holds there, whatever its write dates say.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.plans.replicate import FEW_SLOTS, SLOT, Replica
from tallyloom.session import run_folder, sized_shuffles
from tallyloom.sources.cleaning import nan_to_null

# Ranges that touch are one interval; up to so many intervals are stated as a filter, which reaches files and databases.
FEW_INTERVALS = 50
# The ranges of one level are cut into so many for the next.
PARTS = 32


@dataclass(frozen=True)
class Repaired:
    """What a repair has found: slots and ranges that differed, and the rows that were fetched for them."""

    slots: int
    ranges: int
    fetched: int


def row_hashes(columns: list[str]) -> list[Column]:
    """Two hashes of a row that tell NULL from a missing value beside it."""
    nulls = F.array(*[F.col(c).isNull() for c in columns])
    return [F.xxhash64(F.lit(seed), nulls, *columns) for seed in (1, 2)]


def range_digests(rows: DataFrame, key: str, width: int) -> DataFrame:
    """``range`` (key divided by ``width``), ``n`` rows, and two sums over hashes of the whole rows that no order changes."""
    one, two = row_hashes(rows.columns)
    return (
        rows.groupBy(F.floor(F.col(key) / F.lit(width)).cast("long").alias("range"))
        .agg(F.count(F.lit(1)).alias("n"), F.bit_xor(one).alias("mixed"), F.sum(two.cast("decimal(38,0)")).alias("total"))
    )


def differing_ranges(ours: DataFrame, theirs: DataFrame, key: str, width: int) -> DataFrame:
    """The ranges that don't hold the same rows on both sides; both have the same columns."""
    left, right = (range_digests(rows, key, width).alias(name) for rows, name in ((ours, "o"), (theirs, "t")))
    same = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("n", "mixed", "total")])
    joined = left.join(right, F.col("o.range") == F.col("t.range"), "full_outer")
    return joined.where(~same).select(F.coalesce("o.range", "t.range").alias("range"))


def intervals(ranges: list[int], width: int) -> Iterator[tuple[int, int]]:
    """The [from, to) key intervals of ranges, joined where they touch."""
    start = last = None
    for r in sorted(ranges):
        if last is not None and r == last + 1:
            last = r
            continue
        if start is not None:
            yield start * width, (last + 1) * width
        start = last = r
    if start is not None:
        yield start * width, (last + 1) * width


def within(rows: DataFrame, key: str, width: int, ranges: DataFrame) -> DataFrame:
    """The rows whose key lies in one of ``ranges``; a few intervals become a filter on the key, more a join."""
    some = [r[0] for r in ranges.limit(FEW_SLOTS * PARTS + 1).collect()]
    if len(some) <= FEW_SLOTS * PARTS:
        spans = list(intervals(some, width))
        if not spans:
            return rows.limit(0)
        if len(spans) <= FEW_INTERVALS:
            return rows.where(reduce(or_, [(F.col(key) >= F.lit(a)) & (F.col(key) < F.lit(b)) for a, b in spans]))
    wanted = ranges.select(F.col("range").alias("__range")).distinct()
    return rows.join(wanted, F.floor(F.col(key) / F.lit(width)).cast("long") == F.col("__range"), "left_semi")


def aligned(rows: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """``rows`` with exactly these columns, those it lacks as NULL."""
    return rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def repair(replica: Replica, table: str, source: DataFrame, parts: int = PARTS) -> Repaired:
    """Make a replicated table equal to ``source`` again, reading rows only where the two differ.

    ``source`` is the whole table as it is now. Its keys and a hash of each row are read once for the first digests, rows only
    in differing ranges (``parts`` to a slot). What the source holds counts, write dates do not. A replica that was written
    meanwhile is refused as in a merge, and the repair may be repeated. A repair that finds nothing writes nothing.
    """
    spark, key = replica.spark, replica.key
    seq, schema = replica.last(table)
    if schema is None:
        raise LookupError(f"{table} has not been replicated yet")
    theirs = nan_to_null(source)
    if not theirs.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"a row of {table} has no {key}")
    fields = schema.fields + [f for f in theirs.schema.fields if f.name not in schema.names]
    ours, theirs = (aligned(rows, fields) for rows in (replica.read(table), theirs))
    width = replica.layout(table)
    narrow = max(1, width // parts)
    scratch = run_folder(spark)

    found = f"{scratch}/slots"
    with sized_shuffles(theirs):
        differing_ranges(ours, theirs, key, width).write.parquet(found)
    slots = spark.read.parquet(found)
    n_slots, n_ranges, n_rows, last = 0, 0, 0, None
    while True:
        batch = slots if last is None else slots.where(F.col("range") > last)
        some = [r[0] for r in batch.orderBy("range").limit(FEW_SLOTS).collect()]
        if not some:
            return Repaired(n_slots, n_ranges, n_rows)
        last = some[-1]
        chosen = spark.createDataFrame([(s,) for s in some], "range long")
        held = aligned(replica.read_slots(table, some), fields)
        step = f"{scratch}/batch-{n_slots}"
        differing_ranges(held, within(theirs, key, width, chosen), key, narrow).write.parquet(f"{step}/ranges")
        ranges = spark.read.parquet(f"{step}/ranges")
        # Landed once, so that what is counted, written and committed is one and the same.
        within(theirs, key, narrow, ranges).write.parquet(f"{step}/rows")
        fetched = spark.read.schema(theirs.schema).parquet(f"{step}/rows")
        stale = ranges.select(F.col("range").alias("__range"))
        kept = held.join(stale, F.floor(F.col(key) / F.lit(narrow)).cast("long") == F.col("__range"), "left_anti")
        rows = kept.unionByName(fetched).withColumn(SLOT, F.floor(F.col(key) / F.lit(width)).cast("long"))
        # A range may reach into the slot beside it where slots aren't a multiple of ranges.
        seq = replica.replace(table, some, rows.where(F.col(SLOT).isin(some)), seq)
        n_slots, n_ranges, n_rows = n_slots + len(some), n_ranges + ranges.count(), n_rows + fetched.count()
