"""Incremental replication of keyed tables by write date."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.dates import utc_now
from tallyloom.operators.changes import WRITE_DATE, Brought, changed_rows, latest_per_key, upsert_merge
from tallyloom.operators.watermark import Watermark
from tallyloom.session import exists, remove_folder, scanned_bytes, sized_shuffles
from tallyloom.sources.cleaning import nan_to_null
from tallyloom.sources.erp import Erp
from tallyloom.sources.schemas import ERP_TABLES

SLOT, VERSION = "slot", "version"
COMMITS = "slot BIGINT, version STRING, replaced STRING, schema STRING, seq BIGINT"
LAYOUT = "key STRING, slot_rows BIGINT"
COMPRESSION = "zstd"
SLOT_ROWS = 1_000_000
# Up to so many slots are named in a filter; more are found by a join with the table of commits.
FEW_SLOTS = 1_000
# A merge that scans more compares ids and write dates first, so that rows which need no comparing stay where they are.
LARGE_MERGE = 16 << 20
# Rows that stay where they are may leave a slot in so many files on average; beyond that they are brought together.
SLOT_FILES = 8
# Every so many commits one states all slots, and those before it go.
FOLD_EVERY = 20


class ConcurrentWrite(RuntimeError):
    """Another writer has committed meanwhile; the merge that raises this has changed nothing and may be repeated."""


class Replica:
    """Replicated tables as parquet under ``root``, each split into slots of ``slot_rows`` neighbouring ids.

    Slots are as many as the ids need, so each stays as small as the first. Source systems number rows upwards and
    mostly change recent ones, so a batch touches few slots, and a merge rewrites only those.

    A merge writes a new version of each touched slot into a folder of its own and then commits all of them in one
    numbered file. A job that dies at any moment leaves the table as it was. Of two writers that start from the same
    commit the second fails. The version before the current one stays for readers; older ones are removed.

    Key and ``slot_rows`` are kept with the table. Opening it without ``slot_rows`` follows them, another value is refused.
    """

    def __init__(self, spark: SparkSession, root: str, slot_rows: int | None = None, key: str = "id"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.slot_rows = slot_rows
        self.key = key

    def path(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def _there(self, path: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def layout(self, table: str) -> int:
        """The rows of a slot, as the table was created with."""
        path = f"{self.root}/layout/{table}"
        stored = self._there(path, LAYOUT)
        row = stored.first() if stored is not None else None
        if row is None:
            row = {"key": self.key, "slot_rows": self.slot_rows or SLOT_ROWS}
            self.spark.range(1, numPartitions=1).select(
                F.lit(row["key"]).alias("key"), F.lit(row["slot_rows"]).cast("long").alias("slot_rows")
            ).write.mode("overwrite").parquet(path)
        if row["key"] != self.key or self.slot_rows not in (None, row["slot_rows"]):
            raise ValueError(
                f"{table} was created with key {row['key']} and {row['slot_rows']} rows a slot, not {self.key} and {self.slot_rows}"
            )
        return row["slot_rows"]

    def _commits(self, table: str) -> DataFrame | None:
        return self._there(f"{self.root}/commits/{table}", COMMITS)

    def last(self, table: str) -> tuple[int, T.StructType | None]:
        """The number of the last commit and the table's columns."""
        commits = self._commits(table)
        row = commits.agg(F.max(F.struct("seq", "schema")).alias("last")).first()["last"] if commits is not None else None
        return (row["seq"], T.StructType.fromJson(json.loads(row["schema"]))) if row is not None else (0, None)

    def _state(self, table: str) -> DataFrame:
        """Each slot's current version and the one it has replaced."""
        return (
            self._commits(table)
            .where(F.col(SLOT).isNotNull())
            .groupBy(SLOT)
            .agg(F.max_by(F.struct(VERSION, "replaced"), "seq").alias("now"))
            .select(SLOT, "now.version", "now.replaced")
        )

    def _rows(self, table: str, schema: T.StructType, state: DataFrame, few: list[Row] | None) -> DataFrame:
        """The rows of the given slots. A few are named by partition, so that nothing else is read."""
        fields = schema.fields + [T.StructField(SLOT, T.LongType()), T.StructField(VERSION, T.StringType())]
        if few is not None and not few:
            return self.spark.createDataFrame([], T.StructType(fields[:-1]))
        files = self.spark.read.schema(T.StructType(fields)).parquet(self.path(table))
        if few is None:
            return files.join(state.select(SLOT, VERSION), [SLOT, VERSION]).select(*schema.names, SLOT)
        slots = defaultdict(list)
        for row in few:
            slots[row[VERSION]].append(row[SLOT])
        chosen = reduce(or_, [(F.col(VERSION) == v) & F.col(SLOT).isin(own) for v, own in slots.items()])
        return files.where(chosen).drop(VERSION)

    def versions(self, table: str) -> DataFrame:
        """``slot``, its current ``version`` and the one before, ``replaced``, which stays until the next merge of the slot."""
        return self._state(table)

    def rows_of(self, table: str, versions: DataFrame) -> DataFrame:
        """The rows of the given versions (``slot``, ``version``), current or replaced, with the table's columns of today."""
        _, schema = self.last(table)
        some = versions.limit(FEW_SLOTS + 1).collect()
        return self._rows(table, schema, versions, some if len(some) <= FEW_SLOTS else None).select(*schema.names)

    def read(self, table: str) -> DataFrame:
        """The whole table. A replicated source without rows is an empty table with its columns."""
        _, schema = self.last(table)
        if schema is None:
            raise LookupError(f"{table} has not been replicated yet")
        state = self._state(table)
        some = state.limit(FEW_SLOTS + 1).collect()
        return self._rows(table, schema, state, some if len(some) <= FEW_SLOTS else None).select(*schema.names)

    def read_slots(self, table: str, slots: Sequence[int]) -> DataFrame:
        """The rows of up to ``FEW_SLOTS`` slots, and nothing else of the table."""
        _, schema = self.last(table)
        state = self._state(table).where(F.col(SLOT).isin(list(slots)))
        return self._rows(table, schema, state, state.collect()).select(*schema.names)

    def brought(self, table: str, versions: DataFrame) -> Brought | None:
        """The ids that the merges which made these versions brought; the other rows of a slot are those of the version before.

        None if one of the versions was made in another way, or if they are too many.
        """
        names = [row[0] for row in versions.select(VERSION).distinct().limit(FEW_SLOTS + 1).collect()]
        paths = [self._brought_path(table, name) for name in names]
        if len(paths) > FEW_SLOTS or not all(exists(self.spark, f"{path}/_SUCCESS") for path in paths):
            return None
        return Brought.read(self.spark, paths, self.key)

    def _brought_path(self, table: str, version: str) -> str:
        return f"{self.root}/brought/{table}/{version}"

    def replace(
        self,
        table: str,
        slots: Sequence[int],
        rows: DataFrame,
        seq: int,
        dealt: bool = False,
        check: Callable[[], None] | None = None,
    ) -> int:
        """Up to ``FEW_SLOTS`` slots hold ``rows`` (with their ``slot``) from now on, whatever they held; gives the commit's number.

        ``seq`` is the commit that the rows were made from, 0 for a new table; if there has been another since, ``ConcurrentWrite`` is
        raised. Rows that lie by slot already are ``dealt``; ``check`` is called when they have been written, before the commit.
        """
        version = uuid4().hex
        replaced = self._state(table).where(F.col(SLOT).isin(list(slots))) if seq else None
        self._write(table, rows, version, dealt)
        if check is not None:
            check()
        columns = T.StructType([f for f in rows.schema.fields if f.name != SLOT])
        new = self.spark.createDataFrame([(slot,) for slot in slots], f"{SLOT} BIGINT")
        self._commit(table, seq, new, version, columns, replaced)
        return seq + 1

    def _write(self, table: str, rows: DataFrame, version: str, dealt: bool = False) -> None:
        """``dealt`` rows lie by slot as they are, others are brought together and rebalanced."""
        with sized_shuffles(rows):
            named = rows.withColumn(VERSION, F.lit(version))
            (
                (named if dealt else named.hint("rebalance", SLOT))
                .write.mode("append")
                .option("compression", COMPRESSION)
                .partitionBy(SLOT, VERSION)
                .parquet(self.path(table))
            )

    def _scattered(self, *parts: DataFrame) -> bool:
        """Whether tasks that write the rows of these scans as they come would leave slots in too many files."""
        pairs = [rows.select(SLOT, F.spark_partition_id().alias("task")).distinct().withColumn("part", F.lit(n)) for n, rows in enumerate(parts)]
        found = reduce(DataFrame.union, pairs).agg(F.count(SLOT), F.count_distinct(SLOT)).first()
        return found[0] > SLOT_FILES * found[1]

    def _merged(self, base: DataFrame | None, rows: DataFrame, ties: Sequence[str], kept: str) -> tuple[DataFrame, bool]:
        """The rows of touched slots with a batch put in, and whether they lie by slot.

        Rows of a large merge that have nothing to be compared with are passed on as their files are read. Which ids
        it brought is ``kept`` with the version.
        """
        parts = [rows] if base is None else [base, rows]
        if sum(map(scanned_bytes, parts)) > LARGE_MERGE:
            with sized_shuffles(rows if base is None else base.select(self.key).union(rows.select(self.key))):
                brought = Brought.of(base, rows, self.key, kept)
            if brought is not None:
                merged = brought.merge(base, rows, ties)
                return merged, not self._scattered(*parts)
        if base is None:
            return latest_per_key(rows, [self.key], [WRITE_DATE, *ties]), False
        return upsert_merge(base, rows, [self.key], ties=ties), False

    def merge(self, table: str, delta: DataFrame, ties: Sequence[str] = ()) -> None:
        """Put the rows of ``delta`` into the table by key; repeating a merge changes nothing.

        Touched slots are read, merged and written as whole partitions, a large slot as several files. ``delta`` is read
        several times, so it must be a fixed batch. A batch with a NULL key is refused as a whole, as is a key that is no integer.
        """
        if not isinstance(delta.schema[self.key].dataType, T.IntegralType):
            raise TypeError(f"the key {self.key} of {table} must be an integer, not {delta.schema[self.key].dataType.simpleString()}")
        rows = delta.withColumn(SLOT, F.floor(F.col(self.key) / F.lit(self.layout(table))).cast("long"))
        ordered = rows.select(SLOT).distinct().orderBy(F.col(SLOT).asc_nulls_first())
        touched = [row[0] for row in ordered.limit(FEW_SLOTS + 1).collect()]
        if touched and touched[0] is None:
            raise ValueError(f"a changed row of {table} has no {self.key}")
        seq, schema = self.last(table)
        if not touched and schema is not None and set(delta.columns) <= set(schema.names):
            return
        version = uuid4().hex
        columns = T.StructType((schema.fields if schema else []) + [f for f in delta.schema.fields if not schema or f.name not in schema.names])
        replaced = None
        if schema is None:
            merged, dealt = self._merged(None, rows, ties, self._brought_path(table, version)) if touched else (rows, False)
        else:
            state = self._state(table)
            if len(touched) <= FEW_SLOTS:
                replaced = state.where(F.col(SLOT).isin(touched))
                few = replaced.collect()
            else:
                replaced, few = state.join(rows.select(SLOT).distinct(), SLOT), None
            merged, dealt = self._merged(self._rows(table, schema, replaced, few), rows, ties, self._brought_path(table, version))
        if touched:
            self._write(table, merged, version, dealt)
        if len(touched) <= FEW_SLOTS:
            new = self.spark.createDataFrame([(slot,) for slot in touched or [None]], f"{SLOT} BIGINT")
        else:
            new = rows.select(SLOT).distinct()
        self._commit(table, seq, new, version, columns, replaced)

    def _commit(
        self, table: str, seq: int, slots: DataFrame, version: str, columns: T.StructType, replaced: DataFrame | None
    ) -> None:
        new = slots.withColumn(VERSION, F.lit(version))
        if replaced is None:
            new = new.withColumn("replaced", F.lit(None).cast("string"))
            old = []
        else:
            before = replaced.select(SLOT, F.col(VERSION).alias("replaced"))
            new = new.join(before, SLOT, "left").select(SLOT, VERSION, "replaced")
            old = replaced.where("replaced is not null").select(SLOT, "replaced").collect()
        folding = (seq + 1) % FOLD_EVERY == 0 and seq > 0
        if folding:
            new = new.union(self._state(table).join(slots.select(SLOT), SLOT, "left_anti"))
        path = f"{self.root}/commits/{table}/seq={seq + 1}"
        stated = new.withColumn("schema", F.lit(columns.json())).coalesce(1)
        for attempt in range(2):
            try:
                stated.write.mode("errorifexists").parquet(path)
                break
            except AnalysisException as error:
                if error.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                if attempt or self.last(table)[0] > seq:
                    raise ConcurrentWrite(f"{table} has been written by someone else since commit {seq}") from error
                remove_folder(self.spark, path)  # what a writer left that died while it committed
        for row in old:
            remove_folder(self.spark, f"{self.path(table)}/{SLOT}={row[SLOT]}/{VERSION}={row['replaced']}")
        gone = {row["replaced"] for row in old}
        if gone:
            named = self._state(table).select(F.explode(F.array(VERSION, "replaced")).alias(VERSION)).distinct()
            for name in gone - {row[0] for row in named.collect()}:
                remove_folder(self.spark, self._brought_path(table, name))
        if folding:
            for n in range(max(1, seq + 1 - 2 * FOLD_EVERY), seq + 1):
                remove_folder(self.spark, f"{self.root}/commits/{table}/seq={n}")


def replicated_erp(replica: Replica, names: Mapping[str, str] = ERP_TABLES) -> Erp:
    """The replicated tables as input of the ERP reports."""
    return Erp(**{table: replica.read(name) for table, name in names.items()})


def replicate(
    replica: Replica,
    sources: Mapping[str, DataFrame],
    watermark: Watermark,
    *,
    now: datetime | None = None,
) -> datetime:
    """Copy the rows changed since the watermark of every source table, then advance the watermark.

    The new cutoff is taken before anything is read, so rows written meanwhile come again next time, which the merge
    makes harmless. Changes are first landed as files: the merge then works on a fixed batch and never asks the
    source twice; the next run replaces them. If any table fails, the error goes to the caller and the watermark
    stays, so the next run repeats.
    Rows deleted in the source are not seen, because only write dates are read; ``plans.repair`` finds them.
    """
    cutoff = now or utc_now()
    since = watermark.read()
    landing = f"{replica.root}/landing"
    for table, source in sources.items():
        changed = nan_to_null(changed_rows(source, since))
        changed.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{landing}/{table}")
    for table, source in sources.items():
        replica.merge(table, replica.spark.read.schema(source.schema).parquet(f"{landing}/{table}"))
    watermark.advance(cutoff)
    return cutoff
