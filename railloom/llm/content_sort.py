"""Exact duplicates by sorting content: range partitioning, an external sort and comparisons of neighbours.

The normalised texts are dealt by ranges whose splitters Spark samples from (first characters, fingerprint), sorted
within their range, and rows whose whole texts equal their neighbour's form one group. A text that makes up a large
share of all rows is cut into pieces first, so that no range grows with the largest group; the pieces' heads, a
bounded number, are then combined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railloom.operators.staging import stage

#: Characters that do not count: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
SPLITTER_CHARS = 24
#: A text with more than one in HOT_SHARE of all rows is cut into PIECES; there are fewer than HOT_SHARE such texts.
HOT_SHARE, PIECES = 1000, 256


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when nothing but white space differs; null counts as empty, and all empty texts are one group.
    The row with the most code points in its original text stays, then the smallest id (null last). Of rows that
    agree in both, one stays. An empty table gives none; other columns are ignored, whatever their names.
    """
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.char_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("points"),
        normalised(F.col(f"`{text}`")).alias("norm"),
    )
    share = rows.groupBy(F.xxhash64("norm").alias("print")).agg(F.count(F.lit(1)).alias("n"))
    # fewer than HOT_SHARE rows by construction, so the broadcast has a fixed bound
    hot = share.where(F.col("n") * HOT_SHARE > df.count()).select("print", F.lit(True).alias("hot"))

    piece = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "points"), F.lit(PIECES))).otherwise(F.lit(0))
    dealt = (
        rows.withColumn("print", F.xxhash64("norm"))
        .join(F.broadcast(hot), "print", "left")
        .select("doc_id", "points", "norm", "print", "hot", F.substring("norm", 1, SPLITTER_CHARS).alias("start"), piece.alias("piece"))
        .repartitionByRange("start", "print", "piece")
    )
    equal = Window.partitionBy("start", "print", "piece", "norm")
    first = equal.orderBy(F.col("points").desc(), F.col("doc_id").asc_nulls_last())
    local = dealt.select(
        "doc_id",
        "points",
        "hot",
        "piece",
        F.row_number().over(first).alias("place"),
        F.first("doc_id").over(first).alias("head_id"),
        F.first("points").over(first).alias("head_points"),
        F.count(F.lit(1)).over(equal).alias("size"),
        F.sha2("norm", 256).alias("text_sha256"),
    )
    local = stage(local, "content-sort")
    heads = local.where("hot AND place = 1")
    best = F.min(F.struct(-F.col("head_points"), F.col("head_id").isNull(), F.col("head_id"), F.col("piece")))
    whole = heads.groupBy("text_sha256").agg(best.alias("best"), F.sum("size").alias("whole_size"))
    found = local.join(F.broadcast(whole), "text_sha256", "left")
    cut = F.col("best").isNotNull()
    return found.select(
        "doc_id",
        F.when(cut, F.col("best.head_id")).otherwise(F.col("head_id")).alias("keep_id"),
        F.when(cut, F.col("whole_size")).otherwise(F.col("size")).alias("group_size"),
        ((F.col("place") == 1) & (~cut | (F.col("best.piece") == F.col("piece")))).alias("kept"),
        "text_sha256",
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, all columns; of rows that repeat both id and content, one."""
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    # one hash of id (null too) and content finds the rows again; join and window share its partitioning
    rows = df.select(_row_key(F.col(f"`{id_col}`").cast("long"), F.sha2(normalised(F.col(f"`{text}`")), 256)).alias("key"), own.alias("row"))
    kept = exact_groups(df, id_col, text).where("kept").select(_row_key(F.col("doc_id"), F.col("text_sha256")).alias("key"))
    again = F.row_number().over(Window.partitionBy("key").orderBy(F.char_length(F.col("row")[text]).desc(), F.col("row")[text]))
    return rows.join(kept, "key", "left_semi").withColumn("_n", again).where("_n = 1").select("row.*")


def _row_key(id_: Column, sha: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(id_.cast("string"), F.lit("none")), sha)
