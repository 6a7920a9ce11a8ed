"""Column plumbing: projection, optional columns, names (ids P1-P4, P6, C4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railloom.functions.coerce import strip

# Position of a row in its landed source: which load, which file, which block, which record.
SOURCE_ORDER = "_source_order"


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist (and the source position when there is one)."""
    return df.select(*[F.col(f"`{c}`") for c in present(df, [*wanted, SOURCE_ORDER])])


def optional(df: DataFrame, name: str, to: str, default: object = None) -> Column:
    """The column when it exists, else a typed default."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(default).cast(to)


def trimmed_names(df: DataFrame) -> DataFrame:
    """Column names without outer whitespace."""
    return df.toDF(*[c.strip() for c in df.columns])


def snake_names(df: DataFrame) -> DataFrame:
    """Column names trimmed, lower-cased, spaces to underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def strip_strings(df: DataFrame) -> DataFrame:
    """C4: strip every text column."""
    return df.withColumns(
        {
            f.name: strip(F.col(f"`{f.name}`"))
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)
        }
    )


def source_order(df: DataFrame) -> list[Column]:
    """Sort key 'as found in the source' when the table carries one."""
    return [F.col(SOURCE_ORDER)] if SOURCE_ORDER in df.columns else []


def without_source_order(df: DataFrame) -> DataFrame:
    return df.drop(SOURCE_ORDER)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order columns into a fixed schema; a missing column becomes a typed NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
