"""Selection criteria that callers pass for accounts, cost centres, details and counterparties.

A criterion takes a column and returns a boolean column. A plain value means equality, a list means membership.
A NULL code satisfies no criterion, negated ones included.

In a collated ledger a criterion meets the key of a code (see ``sources.collation``), and its values are turned into keys as
well; a criterion of the caller's own that is a plain function meets the code as it is written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_, or_
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.schemas import KEY

if TYPE_CHECKING:
    from tallyloom.sources.collation import Collation


@dataclass(frozen=True)
class Criterion:
    """A test of a column; the collation is that of the column's values, None where they are as written."""

    test: Callable[[Column, Collation | None], Column]

    def __call__(self, column: Column, collation: Collation | None = None) -> Column:
        return self.test(column, collation)


def key_of(value: Any, collation: Collation | None) -> Column:
    """A value to compare with; folded to a constant when the query is planned."""
    return collation.key(F.lit(value)) if collation is not None and isinstance(value, str) else F.lit(value)


def one_of(*values: Any) -> Criterion:
    return Criterion(lambda column, collation: column.isin(*[key_of(v, collation) for v in values]))


def starts_with(*prefixes: str) -> Criterion:
    def test(column: Column, collation: Collation | None) -> Column:
        parts = [F.lit(p) if collation is None else collation.part(F.lit(p)) for p in prefixes]
        return reduce(or_, [column.startswith(p) for p in parts])

    return Criterion(test)


@dataclass(frozen=True)
class Listed:
    """Membership in a table; see ``listed``."""

    frame: DataFrame
    pairs: Mapping[str, str]
    negated: bool = False


def listed(frame: DataFrame, column: str, **also: str) -> Listed:
    """Codes that are listed in ``column`` of a table, which may be of any size.

    Further columns of the rows may be tied to columns of the list: ``listed(chosen, "code", cpbano="year")`` takes a code in the
    years it is listed for. It becomes a semi join, so that Spark can prune partitions and rows by the list at run time. It
    can't be part of ``any_of``; put all codes into one table instead.
    """
    return Listed(frame, {"": column, **also})


def contains(*parts: str, case_sensitive: bool = False) -> Criterion:
    """Substring match; case is ignored by default, as in the databases the ledgers come from."""
    if case_sensitive:
        return Criterion(lambda column, collation: reduce(or_, [column.contains(p) for p in parts]))
    return Criterion(lambda column, collation: reduce(or_, [F.lower(column).contains(p.lower()) for p in parts]))


def differs_from(value: Any) -> Criterion:
    return Criterion(lambda column, collation: column != key_of(value, collation))


def at_least(value: Any) -> Criterion:
    return Criterion(lambda column, collation: column >= key_of(value, collation))


def more_than(value: Any) -> Criterion:
    return Criterion(lambda column, collation: column > key_of(value, collation))


def any_of(*specs: Any) -> Criterion:
    return Criterion(lambda column, collation: reduce(or_, [matches(column, s, collation) for s in specs]))


def excluding(spec: Any) -> Criterion | Listed:
    if isinstance(spec, Listed):
        return replace(spec, negated=not spec.negated)
    return Criterion(lambda column, collation: ~matches(column, spec, collation))


def by_company(specs: Mapping[str, Any], company: str = "company") -> Criterion:
    """A different criterion for each company of a combined ledger; other companies match nothing."""
    return Criterion(
        lambda column, collation: reduce(
            or_, [(F.col(company) == F.lit(name)) & matches(column, spec, collation) for name, spec in specs.items()]
        )
    )


def matches(column: Column, spec: Any, collation: Collation | None = None) -> Column:
    if isinstance(spec, Listed):
        raise TypeError("a listed criterion is a join; it can't be part of another criterion")
    if isinstance(spec, Criterion):
        return spec(column, collation)
    if callable(spec):
        return spec(column)
    if isinstance(spec, (list, tuple, set, frozenset)):
        return one_of(*spec)(column, collation)
    return column == key_of(spec, collation)


def key_name(df: DataFrame, name: str) -> str:
    """The column by which ``name`` is compared: its key, where the rows have one."""
    return f"{name}{KEY}" if f"{name}{KEY}" in df.columns else name


def meets(df: DataFrame, name: str, spec: Any, collation: Collation | None = None) -> Column:
    """Whether a column of ``df`` meets a criterion, by its key if the ledger is collated."""
    key = key_name(df, name) if collation is not None else name
    plain_function = callable(spec) and not isinstance(spec, Criterion)
    if key == name or plain_function:
        return matches(F.col(name), spec)
    return matches(F.col(key), spec, collation)


def keep(df: DataFrame, collation: Collation | None = None, **specs: Any) -> DataFrame:
    """Rows whose named columns meet their criteria; None means no condition."""
    for name, spec in specs.items():
        if isinstance(spec, Listed):
            df = in_list(df, name, spec, collation)
        elif spec is not None:
            df = df.where(meets(df, name, spec, collation))
    return df


def in_list(df: DataFrame, name: str, spec: Listed, collation: Collation | None = None) -> DataFrame:
    """The rows that a list names, or those with a code that it doesn't name."""
    tests, picked = [], []
    for i, (row_column, column) in enumerate(spec.pairs.items()):
        plain = row_column or name
        own = key_name(df, plain) if collation is not None else plain
        value = F.col(column) if own == plain else collation.key(F.col(column))
        picked.append(value.alias(f"__listed{i}"))
        tests.append(F.col(own) == F.col(f"__listed{i}"))
        if spec.negated:
            df = df.where(F.col(own).isNotNull())
    return df.join(spec.frame.select(*picked), reduce(and_, tests), "left_anti" if spec.negated else "left_semi")
