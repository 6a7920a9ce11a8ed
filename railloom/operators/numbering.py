"""Dense surrogate ids without a single-task window (id W4).

Rows are staged together with (partition, position in partition). The sizes of the partitions, one number per
partition, give each partition its first id. For ids in an order the rows are first partitioned by range; rows that
have a place already, such as their number in the source, find their range by arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railloom.operators.columns import SOURCE_ORDER
from railloom.operators.merge import null_safe_match
from railloom.operators.quality import fail_if_repeated, unique_or_fail
from railloom.operators.staging import stage

PART, POSITION, OFFSET = "_part", "_position", "_offset"
#: Places in a range at most.
RANGE_ROWS = 500_000
POSITION_BITS = (1 << 33) - 1  # low bits of monotonically_increasing_id: record number in its partition


def dense_ids(
    df: DataFrame,
    order_by: Sequence[str | Column],
    id_col: str,
    start: int = 1,
    id_type: str = "int",
) -> DataFrame:
    """Number the rows start, start+1, ... in the given order, which must be total."""
    placed = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return positional_ids(placed, id_col, start, id_type)


def positional_ids(df: DataFrame, id_col: str, start: int = 1, id_type: str = "int") -> DataFrame:
    """Number the rows as they lie, partition by partition, without a sort; staging pins their places."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_BITS))
    staged = stage(df.withColumn(PART, F.spark_partition_id()).withColumn(POSITION, place), f"ids-{id_col}")
    # one row per partition, never one per record
    sizes = sorted((r[PART], r["n"]) for r in staged.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect())
    firsts = accumulate([start] + [n for _, n in sizes])
    offset = _of_part({p: first for (p, _), first in zip(sizes, firsts)})
    return staged.select((offset + F.col(POSITION)).cast(id_type).alias(id_col), *[F.col(f"`{c}`") for c in df.columns])


def _of_part(offsets: dict[int, int]) -> Column:
    """The offset of the partition or range of a row: a constant array, so that the numbered rows are a plain scan whose size is known."""
    known = [offsets.get(p, 0) for p in range(max(offsets, default=0) + 1)]
    return F.get(F.array(*[F.lit(o).cast("long") for o in known]), F.col(PART))


def ids_by_place(df: DataFrame, place: str, places: int, id_col: str, start: int = 1, id_type: str = "int") -> DataFrame:
    """Number the rows in the order of ``place``, a distinct number from 1 to ``places`` that some of them lack.

    The range of a row follows from its place, so nothing is sampled and the rows are computed once.
    """
    few = min(places // 50_000, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = max(1, few, -(-places // RANGE_ROWS))  # so the sort of a range does not grow with the table
    width = -(-max(1, places) // ranges)
    at = F.floor((F.col(place) - 1) / width).cast("int").alias(PART)
    dealt = df.select("*", at).repartition(ranges, PART).sortWithinPartitions(PART, place)
    staged = stage(dealt.withColumn(POSITION, F.monotonically_increasing_id()), f"ids-{id_col}")
    # one row per range: its first position, and how many rows it has
    found = staged.groupBy(PART).agg(F.min(POSITION).alias("low"), F.count(F.lit(1)).alias("n")).collect()
    sizes = sorted((r[PART], r["low"], r["n"]) for r in found)
    firsts = accumulate([start] + [n for _, _, n in sizes])
    offset = _of_part({p: first - low for (p, low, _), first in zip(sizes, firsts)})
    return staged.select((offset + F.col(POSITION)).cast(id_type).alias(id_col), *[F.col(f"`{c}`") for c in df.columns])


def _in_order(df: DataFrame, id_col: str, keep: bool) -> DataFrame:
    """Rows numbered by source position, whose fields are compared one by one: that is the order of the whole, and faster."""
    kind = df.schema[SOURCE_ORDER].dataType
    fields = [F.col(SOURCE_ORDER)[f] for f in kind.fieldNames()] if isinstance(kind, T.StructType) else []
    order = [*fields, F.col(SOURCE_ORDER)]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return positional_ids(placed if keep else placed.drop(SOURCE_ORDER), id_col, id_type="long")


def source_ids(df: DataFrame, id_col: str, keep: bool = True) -> DataFrame:
    """Number the rows from 1 in the order of their source position; without one in the order of all columns.

    Rows of a file block carry consecutive line numbers, so the sizes of the blocks give each its first id, without a
    sort. Where lines are missing, or positions are of another form, the rows are sorted. The position is left out of
    the numbered rows unless it is to be kept.
    """
    if SOURCE_ORDER not in df.columns:
        return dense_ids(df, [f"`{c}`" for c in df.columns], id_col, id_type="long")
    place = F.col(SOURCE_ORDER)
    block = ["load", "file", "block"]
    if not {*block, "line"} <= {*df.schema[SOURCE_ORDER].dataType.names}:
        return _in_order(df, id_col, keep)
    staged = stage(df, f"source-{id_col}")
    ends = [F.min(place["line"]).alias("low"), F.max(place["line"]).alias("high"), F.count(F.lit(1)).alias("n")]
    # one row per file block
    found = sorted(tuple(r) for r in staged.groupBy(*[place[b].alias(b) for b in block]).agg(*ends).collect())
    if any(high - low + 1 != n for *_, low, high, n in found):
        return _in_order(staged, id_col, keep)
    firsts = accumulate([1] + [n for *_, n in found])
    shift = df.sparkSession.createDataFrame(
        [(*at, first - low) for (*at, low, _, _), first in zip(found, firsts)], f"_load int, _file string, _block long, {OFFSET} long"
    )
    same = [place[b] == F.col(f"_{b}") for b in block]
    numbered = staged.join(F.broadcast(shift), same)
    names = [c for c in df.columns if keep or c != SOURCE_ORDER]
    return numbered.select((F.col(OFFSET) + place["line"]).alias(id_col), *[F.col(f"`{c}`") for c in names])


def fill_ids(
    df: DataFrame, id_col: str, order_by: Sequence[str], last: int = 0, id_type: str = "int"
) -> DataFrame:
    """Keep the ids that are there; rows without one are numbered after ``last``."""
    missing = F.col(id_col).isNull()
    fresh = dense_ids(df.where(missing).drop(id_col), order_by, id_col, last + 1, id_type)
    return df.where(~missing).withColumn(id_col, F.col(id_col).cast(id_type)).unionByName(fresh)


def last_id(df: DataFrame | None, id_col: str) -> int:
    return 0 if df is None else df.agg(F.max(id_col).alias("last")).head()["last"] or 0


def keyed_ids(
    incoming: DataFrame,
    existing: DataFrame | None,
    natural_key: Sequence[str],
    id_col: str,
    id_type: str = "int",
    last: int | None = None,
) -> DataFrame:
    """Give every incoming row the id its natural key already has, and new keys the ids after the last.

    NULL equals NULL in the natural key; one that either side repeats fails the load. Re-running a load
    therefore changes no id.
    """
    last = last_id(existing, id_col) if last is None else last
    if existing is None:
        return dense_ids(unique_or_fail(incoming, natural_key), list(natural_key), id_col, last + 1, id_type)
    known = unique_or_fail(existing.select(id_col, *natural_key), natural_key)
    known = known.select(id_col, *[F.col(c).alias(f"_known_{c}") for c in natural_key])
    matched = incoming.join(known, null_safe_match(natural_key, "_known_"), "left").select(id_col, *incoming.columns)
    staged = stage(matched, f"matched-{id_col}")
    fail_if_repeated(staged, natural_key)  # the key alone is moved for that
    return fill_ids(staged, id_col, list(natural_key), last, id_type)
