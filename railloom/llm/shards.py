"""A uniform shuffle into shards of exact size, by a communication matrix with hypergeometric entries.

How many rows of each input partition go to each shard is drawn first: row after row of the matrix is a draw without
replacement from the places that are left, so the shard sizes are exact and every assignment is equally likely. Each
partition is then permuted by itself and cut at the drawn counts, the rows are exchanged, and every shard is permuted
again.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railloom.operators.staging import stage


def draw(rng: random.Random, good: int, bad: int, n: int) -> int:
    """How many of n draws without replacement from good + bad are good: exact, by inversion from the mode."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))

    def up(k: int) -> float:
        return (good - k) * (n - k) / ((k + 1) * (bad - n + k + 1))

    # probabilities relative to the mode, outwards until they vanish
    weights, k, w = {mode: 1.0}, mode, 1.0
    while k < high and w > 1e-18:
        w *= up(k)
        k += 1
        weights[k] = w
    k, w = mode, 1.0
    while k > low and w > 1e-18:
        k -= 1
        w /= up(k)
        weights[k] = w
    left = rng.random() * sum(weights.values())
    for k, w in weights.items():
        left -= w
        if left <= 0:
            return k
    return mode


def matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows: partitions with ``counts`` rows each; columns: shards with ``sizes`` places; both sums are met exactly."""
    rng, left = random.Random(seed), list(sizes)
    rows = []
    for count in counts:
        row, pool = [], sum(left)
        for places in left:
            k = draw(rng, places, pool - places, count)
            row.append(k)
            count, pool = count - k, pool - places
        left = [a - b for a, b in zip(left, row, strict=True)]
        rows.append(row)
    return rows


def even(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def shuffle(df: DataFrame, shards: int, seed: int) -> DataFrame:
    """All rows and columns of ``df`` plus ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... within its shard).

    Shard sizes differ by one row at most, whatever the rows hold: nulls, repeated rows and a value that a third of
    all rows share are rows like any other, as rows are permuted by their place and not by what they hold. The result
    depends on the seed and on how the input is partitioned. An empty table gives an empty one. A column called ``shard`` or ``slot`` is replaced. The rows are written once to
    the scratch folder, so that lost tasks read what was drawn for. The driver holds partitions x shards counts.
    """
    spark = df.sparkSession
    own = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    body = df.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    mixed = (
        body.withColumn("part", F.spark_partition_id())
        .withColumn("key", F.xxhash64(F.lit(seed), "part", _within_partition()))
        .sortWithinPartitions("key")
        .withColumn("rank", _within_partition())
        .drop("key")
    )
    mixed = stage(mixed, "shard-in", "zstd")
    counts = {r["part"]: r["n"] for r in mixed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = sorted(counts)
    drawn = matrix([counts[p] for p in parts], even(sum(counts.values()), shards), seed)
    cuts = [(p, _running(row)) for p, row in zip(parts, drawn, strict=True)]
    table = spark.createDataFrame(cuts, T.StructType([T.StructField("part", T.IntegerType()), T.StructField("ends", T.ArrayType(T.LongType()))]))
    shard = sum([(F.col("rank") >= F.col("ends")[s]).cast("int") for s in range(shards - 1)], F.lit(0))
    sent = (
        mixed.join(F.broadcast(table), "part")  # partitions x shards numbers, which the driver holds anyway
        .select("row", shard.alias("shard"), F.xxhash64(F.lit(seed + 1), "part", "rank").alias("key"))
        .repartitionByRange(_partitions(spark), "shard", "key")
        .sortWithinPartitions("shard", "key")
        .withColumn("part", F.spark_partition_id())
        .withColumn("rank", _within_partition())
    )
    sent = stage(sent.drop("key"), "shard-out", "zstd")
    blocks = sent.groupBy("part", "shard").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    starts, filled = [], [0] * shards
    for b in sorted(blocks, key=lambda b: (b["shard"], b["part"])):
        starts.append((b["part"], b["shard"], filled[b["shard"]] - b["first"]))
        filled[b["shard"]] += b["n"]
    kinds = [("part", T.IntegerType()), ("shard", T.IntegerType()), ("shift", T.LongType())]
    shifts = spark.createDataFrame(starts, T.StructType([T.StructField(n, t) for n, t in kinds]))
    return sent.join(F.broadcast(shifts), ["part", "shard"]).select("row.*", "shard", (F.col("rank") + F.col("shift")).alias("slot"))


def _within_partition() -> Column:
    """0, 1, ... in the order the rows of a partition have: the low bits of Spark's id."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def _running(row: list[int]) -> list[int]:
    ends, total = [], 0
    for k in row:
        total += k
        ends.append(total)
    return ends


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_shards(df: DataFrame, path: str, shards: int, seed: int) -> None:
    """The shuffled rows as files under ``path``/shard=N, in slot order within each file."""
    placed = shuffle(df, shards, seed)
    placed.repartitionByRange(_partitions(df.sparkSession), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
