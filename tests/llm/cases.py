"""Documents with every odd case: nulls in any column, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, ids string, decoded string, score string,"
    " lang_pred string, shard string, slot string, matches string, kept string, row string, features string"
)
ENGLISH = "the quick brown fox jumps over the lazy dog and runs away from the angry bear in the wood near the river"
FRENCH = "le vif renard brun saute par dessus le chien paresseux et court loin de la forêt où il est né en été"
LONG = " ".join(f"word{n % 977} tail{n % 13}" for n in range(30_000))
TEXTS: list[tuple[int | None, str | None, str | None]] = [
    (1, ENGLISH, "en"),
    (2, FRENCH, "fr"),
    (3, ENGLISH, "en"),
    (4, ENGLISH.replace(" ", "  "), None),
    (5, "", "en"),
    (6, None, None),
    (7, " \n\t ", "fr"),
    (8, "12 34 !?", "en"),
    (9, LONG, "en"),
    (10, LONG + " end", "en"),
    (11, "<|endoftext|> it's  we'll\n\n 日本語 😀 \x1c x", "en"),
    (12, "A A A A A A A A A A A A " * 40, "en"),
    (13, ENGLISH + "\n" + FRENCH, "fr"),
    (None, "no id " + ENGLISH, "en"),
    (3, ENGLISH, "en"),
]


def documents(spark: SparkSession, texts=TEXTS) -> DataFrame:
    rows = [(i, t, lang, None, None, "a", "b", "c", "d", "e", "f", "g", "h", "i", "j") for i, t, lang in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
