"""Counts and invariants (ids A8, A10, key and foreign-key checks)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railloom.operators.predicates import any_rule


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column."""
    return df.select(column).distinct()


def rule_counts(df: DataFrame, rules: Sequence[Mapping[str, object]]) -> DataFrame:
    """A10: matches per keep rule and in total, one pass."""
    each = [F.count_if(any_rule([r])).alias(f"rule_{i}") for i, r in enumerate(rules)]
    return df.agg(*each, F.count_if(any_rule(rules)).alias("any_rule"), F.count(F.lit(1)).alias("n_rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_or_fail(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; a key that occurs twice (NULL equals NULL) fails the job that reads them.

    Rows are sorted once, after the shuffle, and a repeated key fails at its second row.
    """
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1)))
    return df.withColumn("_at", at).where(_once(F.col("_at"), keys)).select(*[F.col(f"`{c}`") for c in df.columns])


def _once(n: Column, keys: Sequence[str]) -> Column:
    name = F.concat(F.lit("repeated key "), F.to_json(F.struct(*keys)))
    return F.when(n > 1, F.raise_error(name).cast("boolean")).otherwise(F.lit(True))


def fail_if_repeated(df: DataFrame, keys: Sequence[str]) -> None:
    """Fails at once if a key occurs twice; only the keys are moved, so ``df`` should be staged."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counted.where(_once(F.col("_n"), keys)).agg(F.count(F.lit(1))).collect()


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Non-null foreign keys without a parent; empty when the reference holds."""
    keys = child.select(F.col(fk).alias(pk)).where(F.col(pk).isNotNull()).distinct()
    return keys.join(parent.select(pk), pk, "left_anti")


def unsorted_links(df: DataFrame, array_col: str) -> DataFrame:
    """Rows whose id array is NULL, unsorted or repeats an id."""
    a = F.col(array_col)
    return df.where(a.isNull() | (a != F.array_sort(F.array_distinct(a))))
