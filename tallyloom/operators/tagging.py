"""Union of several differently filtered copies of one input, each with a literal tag, in a single scan."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_groups(rows: DataFrame, groups: Mapping[str, Column], tag: str) -> DataFrame:
    """One row per matching group, so a row that matches two groups appears under both tags."""
    wanted = rows.where(reduce(or_, groups.values()))
    tags = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in groups.items()]))
    return wanted.withColumn(tag, F.explode(tags))
