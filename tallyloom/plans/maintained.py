"""Sums kept up to date with a replicated table.

A merge replaces some slots of a table and leaves their previous versions in place until the next one. The sums of a group change
by what its rows sum up to in the new versions of those slots, less what they do in the old ones; where a merge has kept which ids it
brought, only rows with these are summed, as the others are the same in both. So a refresh reads the slots that have changed, twice, and the stored sums of groups that changed, but neither the rest of the table nor of the sums. Groups
whose last row has gone are removed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.plans.replicate import COMPRESSION, FEW_SLOTS, SLOT, VERSION, ConcurrentWrite, Replica
from tallyloom.session import run_folder, sized_shuffles

# Rows of this slot state which versions of the table's slots the sums are made from, and in ``ROWS`` the number of parts.
STATED = -1
OF_SLOT, OF_VERSION, ROWS = "of_slot", "of_version", "n_rows"
PLACE = "__place"
EXACT = "decimal(38,{})"


@dataclass(frozen=True)
class Refreshed:
    """What a refresh has done: slots of the table whose versions differed, groups that changed, and whether it started anew."""

    slots: int
    groups: int
    anew: bool


class MaintainedSums:
    """Sums of a replicated table by group: ``keys`` and ``sums`` are columns over its rows, by name.

    Sums are exact, so only integers and decimals are taken; a sum over nothing but NULL is NULL, and NULL is a key like any other.
    Groups lie in ``parts`` parts by a hash of their keys, each rewritten as a whole when one of its groups changes. The versions that
    the sums are made from are committed with them in one file: a refresh that dies changes nothing, and one that runs
    twice counts nothing twice. Sums that have missed a version are made anew from the whole table.
    """

    def __init__(self, replica: Replica, table: str, name: str, keys: Mapping[str, Column], sums: Mapping[str, Column], parts: int = 256):
        if not 0 < parts < FEW_SLOTS:
            raise ValueError(f"parts must lie between 1 and {FEW_SLOTS - 1}")
        taken = {SLOT, VERSION, OF_SLOT, OF_VERSION, ROWS, *(f"n_{s}" for s in sums)} & {*keys, *sums}
        if taken:
            raise ValueError(f"reserved names: {sorted(taken)}")
        self.replica, self.table, self.name = replica, table, name
        self.keys, self.sums, self.parts = dict(keys), dict(sums), parts
        self.store = Replica(replica.spark, f"{replica.root}/sums")

    def _totals(self) -> list[str]:
        return [ROWS, *(c for s in self.sums for c in (s, f"n_{s}"))]

    def _measured(self, rows: DataFrame, sign: int) -> DataFrame:
        """Each row as the group it adds to, and what it adds."""
        values = rows.select(*[c.alias(n) for n, c in {**self.keys, **self.sums}.items()])
        added = [F.lit(sign).cast("long").alias(ROWS)]
        for name in self.sums:
            kind = values.schema[name].dataType
            if not isinstance(kind, (T.IntegralType, T.DecimalType)):
                raise TypeError(f"{name} must be an integer or a decimal, not {kind.simpleString()}")
            exact = EXACT.format(kind.scale if isinstance(kind, T.DecimalType) else 0)
            value = F.coalesce(F.col(name), F.lit(0)).cast(exact)
            added.append((value if sign > 0 else -value).alias(name))
            added.append(F.when(F.col(name).isNull(), 0).otherwise(sign).cast("long").alias(f"n_{name}"))
        return values.select(*self.keys, *added)

    def _summed(self, rows: DataFrame, *lying_by: str) -> DataFrame:
        """One row a group, with the type that single rows have."""
        totals = [F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in self._totals()]
        return rows.groupBy(*lying_by, *self.keys).agg(*totals)

    def _in_parts(self, groups: DataFrame) -> DataFrame:
        return groups.withColumn(SLOT, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("long"))

    def refresh(self) -> Refreshed:
        """Bring the sums up to the table's last commit. ``ConcurrentWrite`` if the table or the sums were written meanwhile."""
        spark, scratch = self.replica.spark, run_folder(self.replica.spark)
        at, schema = self.replica.last(self.table)
        if schema is None:
            raise LookupError(f"{self.table} has not been replicated yet")
        self.replica.versions(self.table).write.parquet(f"{scratch}/now")
        now = spark.read.parquet(f"{scratch}/now")
        seq, kept = self.store.last(self.name)
        known = self._known(kept)
        moved = now.join(known, F.col(SLOT) == F.col(OF_SLOT), "left").where(~F.col(VERSION).eqNullSafe(F.col(OF_VERSION)))
        moved.write.parquet(f"{scratch}/moved")
        moved = spark.read.parquet(f"{scratch}/moved")
        missed = F.col(OF_VERSION).isNotNull() & ~F.col("replaced").eqNullSafe(F.col(OF_VERSION))
        anew = kept is None or not moved.where(missed).isEmpty()
        n_slots = moved.count()
        if not anew and not n_slots:
            return Refreshed(0, 0, False)

        changes = self.replica.rows_of(self.table, (now if anew else moved).select(SLOT, VERSION))
        if anew:
            changes = self._measured(changes, 1)
        else:
            before = moved.where(F.col(OF_VERSION).isNotNull()).select(SLOT, F.col(OF_VERSION).alias(VERSION))
            before = self.replica.rows_of(self.table, before)
            # Rows whose ids no merge has brought are the same in both versions.
            brought = self.replica.brought(self.table, moved)
            if brought is not None:
                changes, before = brought.of_batch(changes), brought.of_batch(before)
            changes = self._measured(changes, 1).union(self._measured(before, -1))

        def unchanged() -> None:
            # Old versions go only after a commit, so without one all of them were still there when they were read.
            if self.replica.last(self.table)[0] != at:
                raise ConcurrentWrite(f"{self.table} has been written while its sums were refreshed")

        with sized_shuffles(changes) as wanted:
            summed = self._summed(changes)
            some = reduce(or_, [F.col(c) != 0 for c in self._totals()])
            summed = self._in_parts(summed.where(some))
            if anew:
                touched, groups = list(range(self.parts)), summed.where(F.col(ROWS) > 0).hint("rebalance", SLOT)
            else:
                summed.write.option("compression", COMPRESSION).parquet(f"{scratch}/changes")
        if not anew:
            changes = spark.read.parquet(f"{scratch}/changes")
            unchanged()
            touched = [row[0] for row in changes.select(SLOT).distinct().collect()]  # at most ``parts``
            held = self.store.read_slots(self.name, touched) if touched else None
            groups = changes.hint("rebalance", SLOT)
            if held is not None:
                both = held.select(*changes.drop(SLOT).columns).unionByName(changes.drop(SLOT))
                # Either side holds a group once, so nothing is to be combined before parts are brought together.
                place = F.pmod(F.xxhash64(*self.keys), F.lit(self.parts * -(-wanted // self.parts))).cast("int")
                both = both.withColumn(PLACE, place).repartition(PLACE)
                groups = self._in_parts(self._summed(both, PLACE).drop(PLACE))
            groups = groups.where(F.col(ROWS) > 0)
        stated = now.select(
            F.lit(STATED).cast("long").alias(SLOT),
            F.col(SLOT).alias(OF_SLOT),
            F.col(VERSION).alias(OF_VERSION),
            F.lit(self.parts).cast("long").alias(ROWS),
        )
        groups = groups.unionByName(stated, allowMissingColumns=True)
        self.store.replace(self.name, [STATED, *touched], groups, seq, True, unchanged)
        return Refreshed(n_slots, self.read().count() if anew else changes.count(), anew)

    def _known(self, kept: T.StructType | None) -> DataFrame:
        """Which versions the stored sums are made from. Sums of another kind under the same name are refused."""
        nothing = self.replica.spark.createDataFrame([], f"{OF_SLOT} long, {OF_VERSION} string")
        if kept is None:
            return nothing
        if set(kept.names) != {*self.keys, *self._totals(), OF_SLOT, OF_VERSION}:
            raise ValueError(f"{self.name} holds other sums: {kept.names}")
        stated = self.store.read_slots(self.name, [STATED])
        if not stated.where(F.col(ROWS) != self.parts).isEmpty():
            raise ValueError(f"{self.name} was created with another number of parts")
        return stated.select(OF_SLOT, OF_VERSION)

    def read(self) -> DataFrame:
        """One row a group: the keys, ``n_rows`` and the sums as of the last refresh."""
        groups = self.store.read(self.name).where(F.col(OF_SLOT).isNull())
        sums = [F.when(F.col(f"n_{s}") > 0, F.col(s)).alias(s) for s in self.sums]
        return groups.select(*self.keys, ROWS, *sums)
