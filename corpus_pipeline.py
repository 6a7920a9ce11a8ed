"""The corpus pipeline: documents that are readable, unique, free of benchmark passages, and encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; what it returns is written and
read again. All stages but the last return the columns of the documents. Null texts count as empty throughout; other
columns of the documents go along whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railloom.llm import bpe, content_sort, decontaminate, langid, set_join
from railloom.llm.queries import bpe_digests
from railloom.operators.staging import stage

#: A document stays if its language has this much more than an even share of all; what has no letters has none. Short
#: clean texts fit several languages almost alike, so this only sifts out what fits all of them badly.
ABOVE_EVEN = 1.2


def _whole(docs: DataFrame) -> DataFrame:
    """The rows as one column beside their text, so that an operator's columns cannot clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))


def _rows(decided: DataFrame, keep: Column) -> DataFrame:
    return decided.where(keep).select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those in which no learned language stands out."""
    model = langid.learn(docs)
    found = langid.identify(_whole(docs), model, keep=("row",))
    least = ABOVE_EVEN / len(model.languages) if len(model.languages) > 1 else 0.0
    return _rows(found, (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= least))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that differ in white space alone the longest stays, then the smallest id."""
    return content_sort.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 80 % common shingles connect, one text of the smallest id stays; where none has an id,
    one text stays. Rows with equal id and text stay or go together."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    rows = set_join.keyed(whole)
    groups = set_join.keyed_components(rows.drop("row"))
    later = groups.where("component_id != coalesce(doc_id, key)").select("key")
    # where several texts have the smallest id, as ids may repeat, the one with the smallest key stays
    alike = groups.where("component_id = coalesce(doc_id, key) AND (doc_id IS NULL OR doc_id != key)").select("group", "key").distinct()
    chosen = alike.groupBy("group").agg(F.min("key").alias("chosen"))
    others = alike.join(chosen, "group").where("key != chosen").select("key")
    dropped = later.union(others).select(F.col("key").alias("_dropped")).distinct()
    return rows.join(dropped, F.col("_key_of_row") == F.col("_dropped"), "left_anti").select("row.*")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    found = decontaminate.find(_whole(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=("row",))
    return _rows(found, F.size("matches") == 0)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return bpe_digests(bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("benchmark passages", benchmark_passages),
    ("encoded", encoded),
]

#: The stages of language, links and passages are beyond SQL; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
