"""Filters (ids L1-L15)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railloom.functions.coerce import strip
from railloom.functions.text import contains_pattern
from railloom.operators.columns import SOURCE_ORDER, present


def known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which all the columns have a value; NaN is none.

    One small predicate per column. A single predicate over many columns, which is what ``dropna`` makes,
    is copied by the optimizer for every later renaming of each of its columns: 2^columns copies.
    """
    kinds = dict(df.dtypes)
    checks = [F.col(f"`{c}`").isNotNull() for c in columns]
    checks += [~F.isnan(F.col(f"`{c}`")) for c in columns if kinds[c] in ("double", "float")]
    return df.where(reduce(and_, checks)) if checks else df


def require(df: DataFrame, mandatory: Sequence[str]) -> DataFrame:
    """L1: drop rows with NULL in any mandatory column that exists."""
    return known(df, present(df, mandatory))


def require_all(df: DataFrame) -> DataFrame:
    """L2: drop rows with NULL in any column."""
    return known(df, [c for c in df.columns if c != SOURCE_ORDER])


def filled_entries(row: Column) -> Column:
    """L3 on a map<column, text>: blank texts are missing values, the column without a name goes."""
    return F.map_filter(row, lambda name, value: (name != "") & (value != ""))


def drop_empty_rows(df: DataFrame, row: str) -> DataFrame:
    """L3: keep rows whose map has at least one filled entry, and only those entries."""
    return df.withColumn(row, filled_entries(F.col(row))).where(F.size(row) > 0)


def any_rule(rules: Sequence[Mapping[str, object]]) -> Column:
    """L4: OR over rules, AND over the equalities inside a rule."""
    return reduce(or_, [reduce(and_, [F.col(c) == F.lit(v) for c, v in r.items()]) for r in rules])


def keep_rules(df: DataFrame, rules: Sequence[Mapping[str, object]] | None) -> DataFrame:
    """L4: keep rows that satisfy any rule; a rule over an unknown column is an error."""
    if not rules:
        return df
    unknown = {c for r in rules for c in r} - set(df.columns)
    if unknown:
        raise ValueError(f"keep rule names unknown columns: {sorted(unknown)}")
    return df.where(any_rule(rules))


def differs(c: Column, value: object) -> Column:
    """Not equal, and NULL counts as different."""
    return ~c.eqNullSafe(F.lit(value))


def not_blank(c: Column) -> Column:
    """Neither NULL nor only whitespace."""
    return F.coalesce(strip(c) != "", F.lit(False))


def contains(c: Column, term: str | None) -> Column | None:
    """Case-insensitive 'contains'; no term means no filter."""
    return c.ilike(contains_pattern(term)) if term else None


def either(*conditions: Column | None) -> Column | None:
    """OR over the active conditions."""
    active = [c for c in conditions if c is not None]
    return reduce(or_, active) if active else None


def equals(c: Column, value: object | None) -> Column | None:
    """Equality with a tri-state value; None means no filter."""
    return None if value is None else c == F.lit(value)


def equals_id(c: Column, value: int | None) -> Column | None:
    """Equality with an id; 0 and None mean no filter."""
    return c == F.lit(value) if value else None


def at_least(c: Column, bound: float | None) -> Column | None:
    """Inclusive lower bound; NULL values fail it."""
    return None if bound is None else c >= F.lit(bound)


def at_most(c: Column, bound: float | None) -> Column | None:
    """Inclusive upper bound; NULL values fail it."""
    return None if bound is None else c <= F.lit(bound)


def holds_id(c: Column, value: int | None) -> Column | None:
    """The id is in the array."""
    return None if value is None else F.array_contains(c, F.lit(value))


def where_all(df: DataFrame, *conditions: Column | None) -> DataFrame:
    """AND of the active conditions; absent ones (None) do not filter."""
    active = [c for c in conditions if c is not None]
    return df.where(reduce(and_, active)) if active else df


def by_key(df: DataFrame, key: str, value: object) -> DataFrame:
    """Point lookup, 0 or 1 row. The equality reaches the parquet scan."""
    return df.where(F.col(key) == F.lit(value)).limit(1)
