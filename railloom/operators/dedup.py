"""One row per key under an explicit total order (ids W1-W3, J4, A7).

``row_number() == 1`` is planned with a per-task group limit before the shuffle: every map task sends at
most one row per key, so a key that holds a third of all rows costs one row per task, not a third of the
data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANK = "_rank_in_key"


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return not isinstance(t, (T.MapType, T.VariantType))


def tie_breakers(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The remaining columns as a last resort order, so that the surviving row is always the same."""
    return [
        F.col(f"`{f.name}`").asc_nulls_first()
        for f in df.schema.fields
        if f.name not in keys and _orderable(f.dataType)
    ]


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = (), total: bool = False) -> DataFrame:
    """First row per key (NULL is a key of its own).

    An order that is ``total`` by itself, such as a number of the rows, needs no other columns to break ties.
    """
    order = [*order_by] if total else [*order_by, *tie_breakers(df, keys)]
    if not order:
        return df.dropDuplicates(list(keys))  # nothing but the key: its rows are all equal
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) == 1).drop(RANK)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], period: Column, order_by: Sequence[Column] = ()
) -> DataFrame:
    """The row with the greatest period per key; a missing period comes last."""
    return keep_first(df, keys, [period.desc_nulls_last(), *order_by])


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], total: bool = False) -> DataFrame:
    """Last row per key, what a lookup table keeps when keys repeat."""
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in order_by], total)


def filter_then_dedup(
    df: DataFrame, condition: Column, keys: Sequence[str], order_by: Sequence[Column] = ()
) -> DataFrame:
    """J4 default: a rejected first row gives way to the next valid one of its key."""
    return keep_first(df.where(condition), keys, order_by)


def dedup_then_filter(
    df: DataFrame, condition: Column, keys: Sequence[str], order_by: Sequence[Column] = ()
) -> DataFrame:
    """J4 variant: the first row of a key decides; when it is rejected, the whole key is gone."""
    return keep_first(df, keys, order_by).where(condition)
