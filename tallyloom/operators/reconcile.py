"""Spent against billed: a full outer join of two aggregates of the same journal, and the sums over it.

The two aggregates differ only in their accounts, so one pass computes both, with a flag saying which side each
group has. The join is then arithmetic on those flags, which reads and shuffles the journal once instead of twice.
``outer_join_sums`` is the plain join, for two aggregates that come from different inputs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wide enough for any sum of money, repeated or not.
WIDE = "decimal(38,2)"


def outer_join_sums(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_sum: str,
    right_sum: str,
    *,
    scope: Sequence[str] = (),
    keep_right_keys: bool = False,
) -> DataFrame:
    """Full outer join on ``scope`` and ``keys``, grouped by the left keys, or by the keys of either side.

    Grouping by the left keys alone gathers all right-only rows of a company in one group of NULL keys.
    """
    g, f = left.alias("g"), right.alias("f")
    every = [*scope, *keys]
    joined = g.join(f, reduce(and_, [F.col(f"g.{k}") == F.col(f"f.{k}") for k in every]), "full_outer")
    either = every if keep_right_keys else scope
    group = [
        (F.coalesce(F.col(f"g.{k}"), F.col(f"f.{k}")) if k in either else F.col(f"g.{k}")).alias(k) for k in every
    ]
    return joined.groupBy(*group).agg(
        F.sum(F.col(f"g.{left_sum}")).alias(left_sum), F.sum(F.col(f"f.{right_sum}")).alias(right_sum)
    )


def single_pass_sums(
    groups: DataFrame,
    keys: Sequence[str],
    left_sum: str,
    right_sum: str,
    *,
    scope: Sequence[str] = (),
    keep_right_keys: bool = False,
) -> DataFrame:
    """Same result as ``outer_join_sums`` from rows that carry both sums.

    ``groups`` has one row per group of either side, with ``left_sum``, ``right_sum`` and the flags ``on_left`` and
    ``on_right``. Several groups of a side may share the join keys; the join then repeats each of them once per match.
    """
    by_key = groups.groupBy(*scope, *keys).agg(
        F.sum(left_sum).alias(left_sum),
        F.sum(right_sum).alias(right_sum),
        F.count_if("on_left").alias("lefts"),
        F.count_if("on_right").alias("rights"),
    )
    # A NULL key equals nothing, so such groups meet no partner.
    joinable = reduce(and_, [F.col(k).isNotNull() for k in keys])
    meets = joinable & (F.col("lefts") > 0) & (F.col("rights") > 0)
    left = (F.col(left_sum) * F.when(meets, F.col("rights")).otherwise(1)).cast(WIDE)
    right = (F.col(right_sum) * F.when(meets, F.col("lefts")).otherwise(1)).cast(WIDE)
    if keep_right_keys:
        return by_key.select(*scope, *keys, left.alias(left_sum), right.alias(right_sum))

    def entry(present, key_of, left_value, right_value):
        return F.when(
            present,
            F.struct(*[key_of(k).alias(k) for k in keys], left_value.alias(left_sum), right_value.alias(right_sum)),
        )

    types = {f.name: f.dataType for f in by_key.schema.fields}
    no_key = lambda k: F.lit(None).cast(types[k])
    no_left = F.lit(None).cast(WIDE)
    entries = F.array_compact(
        F.array(
            entry(F.col("lefts") > 0, F.col, left, F.when(meets, right)),
            entry((F.col("rights") > 0) & ~meets, no_key, no_left, right),
        )
    )
    rows = by_key.select(*scope, F.explode(entries).alias("entry")).select(*scope, "entry.*")
    return rows.groupBy(*scope, *keys).agg(F.sum(left_sum).alias(left_sum), F.sum(right_sum).alias(right_sum))
