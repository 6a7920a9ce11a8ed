"""Readers over landed files; every value arrives as text (ids S1, S3, S5-S9).

Each reader adds the position of the row in its source, so that 'first' later means first in the file
however the file is split.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railloom.operators.columns import SOURCE_ORDER
from railloom.operators.predicates import drop_empty_rows
from railloom.operators.staging import stage

# Cell texts that a data-frame CSV reader takes as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: Columns that a table out of objects may have.
MOST_COLUMNS = 2000

# The separators tried for a table of unknown dialect, in this order.
SEPARATORS = (";", ",", "\t")
SNIFFED_SEPARATORS = (",", ";", "\t", "|")

#: Lines of a file that its dialect is found from, and headers that the files of one folder may have.
SAMPLE_LINES = 20
MOST_DIALECTS = 100


def _position(file: Column, block: Column, line: Column, item: Column) -> Column:
    return F.struct(
        F.lit(0).alias("load"),
        file.alias("file"),
        block.cast("long").alias("block"),
        line.cast("long").alias("line"),
        item.cast("int").alias("item"),
    ).alias(SOURCE_ORDER)


def _scan_position() -> Column:
    # rows of one file block are read by one task, in order, so the running id orders them
    return _position(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
        F.lit(0),
    )


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], sep: str, multi_line: bool = False
) -> DataFrame:
    """Text table with a header; a byte-order mark is removed; missing-value texts become NULL."""
    raw = spark.read.csv(
        path, sep=sep, header=True, inferSchema=False, quote='"', escape='"', multiLine=multi_line
    )
    cells = [
        F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in raw.columns
    ]
    return raw.select(*cells, _scan_position())


def read_cube(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated statistical cube."""
    return read_delimited(spark, path, "\t")


@dataclass(frozen=True)
class Dialect:
    """Files with one header and, per separator, how many of the sampled lines have as many columns as it."""

    header: str
    agreeing: dict[str, int]
    lines: int
    files: tuple[str, ...]


def _first_lines(text: DataFrame) -> DataFrame:
    """The first SAMPLE_LINES of each file, with their number ``n``; lines are told by their distance from the first, unsorted.

    One task reads the first block of a file, so the ids of its lines are consecutive.
    """
    begins = text.groupBy("file").agg(F.min("line").alias("begin"))  # one row per file
    return text.join(F.broadcast(begins), "file").withColumn("n", F.col("line") - F.col("begin") + 1).where(F.col("n") <= SAMPLE_LINES)


def dialects(spark: SparkSession, path: str) -> list[Dialect]:
    """The dialects among the files under ``path``, from the first SAMPLE_LINES lines with text of each file.

    Text between quotes is no separator. The driver gets one row per header and agreement, with the names of its files.
    """
    widths = F.array(*[F.size(F.split(F.regexp_replace("value", '"[^"]*"', ""), f"\\Q{sep}\\E", -1)) for sep in SNIFFED_SEPARATORS])
    text = _located_text(spark, path, whole=False).where((F.col("block") == 0) & (F.trim("value") != ""))
    numbered = _first_lines(text.withColumn("line", F.monotonically_increasing_id()))  # lines with text follow each other
    order = Window.partitionBy("file").orderBy("line")
    sample = numbered.withColumn("widths", widths).withColumn("first", F.first("widths").over(order))
    agreeing = F.array(*[F.count_if(F.col("widths")[i] == F.col("first")[i]) for i in range(len(SNIFFED_SEPARATORS))])
    per_file = sample.groupBy("file").agg(
        F.min_by("value", "n").alias("header"), agreeing.alias("agreeing"), F.count(F.lit(1)).alias("lines")
    )
    found = per_file.groupBy("header", "agreeing", "lines").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    if not found:
        raise ValueError(f"empty source: {path}")
    return sorted(
        (
            Dialect(r["header"].lstrip("\ufeff"), dict(zip(SNIFFED_SEPARATORS, r["agreeing"], strict=True)), r["lines"], tuple(r["files"]))
            for r in found
        ),
        key=lambda d: d.files,
    )


def header_width(line: str, sep: str) -> int:
    return len(next(csv.reader([line], delimiter=sep)))


def pick_separator(line: str, steady: Collection[str] = SEPARATORS) -> str:
    """First separator that gives more than three columns, of those that are steady over the lines if any is."""
    wide = [sep for sep in SEPARATORS if header_width(line, sep) > 3]
    if not wide:
        raise ValueError("no separator splits the header into more than three columns")
    return next((sep for sep in wide if sep in steady), wide[0])


def sniff_separator(line: str, agreeing: Mapping[str, int] | None = None) -> str:
    """The separator that splits the header into most columns, over the lines that agree with the header."""
    lines = agreeing or {}
    return max(SNIFFED_SEPARATORS, key=lambda sep: lines.get(sep, 1) * (header_width(line, sep) - 1))


def _read_dialects(spark: SparkSession, path: str, choose: Callable[[Dialect], str]) -> DataFrame:
    """Every file by its own separator and header; columns meet by name, those that a file lacks are NULL in it."""
    groups: dict[tuple[str, str], list[str]] = {}
    for dialect in dialects(spark, path):
        groups.setdefault((choose(dialect), dialect.header), []).extend(dialect.files)
    if len(groups) == 1:
        return read_delimited(spark, path, next(iter(groups))[0])
    if len(groups) > MOST_DIALECTS:
        raise ValueError(f"{path} has files of {len(groups)} headers, {MOST_DIALECTS} at most are read together")
    parts = [read_delimited(spark, [unquote(f) for f in files], sep) for (sep, _), files in groups.items()]
    names = [c for c in dict.fromkeys(c for part in parts for c in part.columns) if c != SOURCE_ORDER]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts).select(*[F.col(f"`{c}`") for c in [*names, SOURCE_ORDER]])


def read_unknown_dialect(spark: SparkSession, path: str) -> DataFrame:
    """Table whose separator is one of three; the files of a folder may differ in separator and header."""

    def choose(found: Dialect) -> str:
        return pick_separator(found.header, [sep for sep, n in found.agreeing.items() if 2 * n > found.lines])

    return _read_dialects(spark, path, choose)


def read_sniffed(spark: SparkSession, path: str) -> DataFrame:
    """Table whose separator is detected; the files of a folder may differ in separator and header."""
    return _read_dialects(spark, path, lambda found: sniff_separator(found.header, found.agreeing))


def _located_text(spark: SparkSession, path: str | Sequence[str], whole: bool) -> DataFrame:
    return spark.read.text(path, wholetext=whole).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def _as_columns(rows: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Maps to one column per name; blanks are NULL and rows without any value go (L3)."""
    names = column_names(rows) if columns is None else columns
    return drop_empty_rows(rows, "row").select(
        *[F.try_element_at("row", F.lit(c)).alias(c) for c in names if c],
        _position(F.col("file"), F.col("block"), F.col("line"), F.col("item")),
    )


def _block_starts(rows: DataFrame, change: Column) -> DataFrame:
    """Per file and block the sum of ``change`` over all blocks before it in the file."""
    sums = rows.groupBy("file", "block").agg(F.sum(change).alias("n")).collect()  # one row per file block
    starts, file, total = [], None, 0
    for name, block, n in sorted(tuple(r) for r in sums):
        total = total if name == file else 0
        file = name
        starts.append((name, block, total))
        total += n
    return F.broadcast(rows.sparkSession.createDataFrame(starts, "file string, block long, start long"))


def _running(rows: DataFrame, change: Column, name: str, inclusive: bool) -> DataFrame:
    """``name``: the sum of ``change`` from the start of the file, by a running sum in each block and one number per block."""
    until = Window.currentRow if inclusive else -1
    over = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, until)
    here = F.coalesce(F.sum(change).over(over), F.lit(0))
    return rows.join(_block_starts(rows, change), ["file", "block"]).withColumn(name, F.col("start") + here).drop("start")


def keyed_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """S3: the entries of files that are one object each: ``file``, ``block``, ``line`` and ``text``, an object of its own.

    Files are split at closing braces, so a large one is read by many tasks. Whether a brace stands inside a text follows
    from the number of quotes before it, and how deep it is from the braces before it; both are carried over from block
    to block. Pieces of one entry are put together again. What stands behind the last whole entry, as in a file that
    breaks off, is an entry whose text cannot be parsed.
    """
    whole = spark.read.option("lineSep", "}").text(path)
    pieces = whole.select(
        F.when(F.col("_metadata.file_block_start") == 0, F.ltrim("value", F.lit("\ufeff"))).otherwise(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        (F.octet_length("value") + 1).alias("bytes"),
        F.col("_metadata.file_size").alias("size"),
        F.length(F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), '[^"]', "")).alias("quotes"),
    )
    pieces = stage(pieces, "pieces")
    # a file that does not end with a brace has a last piece without one
    sized = pieces.groupBy("file").agg(F.sum("bytes").alias("bytes"), F.max("size").alias("size"), F.max(F.struct("block", "line")).alias("last"))
    open_end = sized.where("bytes > size").select("file", F.col("last.block").alias("block"), F.col("last.line").alias("line"), F.lit(True).alias("open_end"))
    pieces = _running(pieces.drop("bytes", "size"), F.col("quotes"), "before", False).join(F.broadcast(open_end), ["file", "block", "line"], "left")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    outside = F.regexp_replace(F.when(F.col("before") % 2 == 1, F.concat(F.lit('"'), plain)).otherwise(plain), '"[^"]*("|$)', "")
    closes = ((F.col("before") + F.col("quotes")) % 2 == 0) & F.col("open_end").isNull()
    marked = stage(
        pieces.select("file", "block", "line", "value", closes.alias("closes"), F.length(F.regexp_replace(outside, r"[^{]", "")).alias("opens")), "braces"
    )
    deep = _running(marked, F.col("opens") - F.col("closes").cast("int"), "depth", True)
    ended = stage(deep.withColumn("ends", (F.col("closes") & (F.col("depth") == 1)).cast("int")).drop("opens", "depth"), "ends")
    numbered = _running(ended, F.col("ends"), "entry", False)
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    entries = numbered.groupBy("file", "entry").agg(parts.alias("parts"), F.max("ends").alias("ended"), F.max("closes").alias("closed"))
    body = F.regexp_replace(F.array_join("parts.value", "}"), r"^\s*[{,]", "")
    text = F.when(F.col("ended") == 1, F.concat(F.lit("{"), body, F.lit("}}"))).otherwise(body)
    whole_entries = entries.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["line"].alias("line"), "ended", text.alias("text"))
    # behind the last entry of a whole file are the outer brace, blanks, and entries that are null
    return whole_entries.where((F.col("ended") == 1) | ~F.col("text").rlike(r'^\s*(?:"(?:[^"\\]|\\.)*"\s*:\s*null\s*,?\s*)*[}\s]*$')).drop("ended")


def keyed_rows(spark: SparkSession, path: str | Sequence[str], per_line: bool = False) -> DataFrame:
    """S3: one row per entry: its place, ``row`` (map of its columns, NULL if the text is no object of objects) and ``text``.

    Staged, so that what is found in it is parsed once.
    """
    texts = _located_text(spark, path, False).withColumnRenamed("value", "text") if per_line else keyed_records(spark, path)
    parsed = texts.where(~F.col("text").rlike(r"^\s*$")).withColumn("entries", F.from_json("text", "map<string,map<string,string>>"))
    bad = F.when(F.col("entries").isNull(), F.col("text")).alias("text")
    # one pass, in which a text that cannot be parsed has one row without an entry
    rows = parsed.select("file", "block", "line", F.posexplode_outer("entries").alias("item", "key", "row"), bad).where("row IS NOT NULL OR text IS NOT NULL")
    return stage(rows.withColumn("item", F.coalesce("item", F.lit(0))), "keyed")


def line_rows(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """S3 for volume: as keyed_rows, of files with one row object per line."""
    located = _located_text(spark, path, False).withColumnRenamed("value", "text").where(~F.col("text").rlike(r"^\s*$"))
    row = F.from_json("text", "map<string,string>")
    parsed = located.select("file", "block", "line", F.lit(0).alias("item"), F.lit(None).cast("string").alias("key"), row.alias("row"), "text")
    return stage(parsed.withColumn("text", F.when(F.col("row").isNull(), F.col("text"))), "lines")


def bad_records(rows: DataFrame) -> DataFrame:
    """Entries that could not be parsed, with file and position."""
    return rows.where("row IS NULL").select("file", "block", "line", "text")


def sound_records(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """L3: one column per name out of what keyed_rows or line_rows give."""
    return _as_columns(rows.where("row IS NOT NULL"), columns)


def read_keyed_json(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    per_line: bool = False,
) -> DataFrame:
    """S3, L3: objects of objects. Outer keys are dropped, inner objects are rows, columns are the union.

    A file is one object, or with ``per_line`` every line is one; either splits. Without ``columns`` the names are found
    in a pass over the parsed rows, MOST_COLUMNS of them at most. Entries that cannot be parsed are left out.
    """
    return sound_records(keyed_rows(spark, path, per_line), columns)


def read_json_lines(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """S3, L3 for volume: one row object per line; every value as text. Lines that cannot be parsed are left out."""
    return sound_records(line_rows(spark, path), columns)


def column_names(rows: DataFrame) -> list[str]:
    """Distinct names over all rows, in the order of their first position inside an object.

    Names are merged on the executors, and as many reach the driver as a table may have; more of them fail the read.
    """
    found = (
        rows.select(F.posexplode(F.map_keys("row")).alias("at", "name"))
        .groupBy("name")
        .agg(F.min("at").alias("at"))
        .limit(MOST_COLUMNS + 1)
        .collect()
    )
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"the objects have more than {MOST_COLUMNS} different names: is a key used as a value?")
    return [r["name"] for r in sorted(found, key=lambda r: (r["at"], r["name"]))]


def read_pages(spark: SparkSession, path: str | Sequence[str], per_line: bool = False) -> DataFrame:
    """Pages of ``{total_count, results: [...]}``, as landed; one per file, or one per line.

    Spark finds the schema of files that are one object each in a single task; here it is found from their texts, by many.
    """
    if per_line:
        return spark.read.json(path)
    texts = spark.read.text(path, wholetext=True).select(F.ltrim("value", F.lit("\ufeff")))
    schema = spark.read.json(texts.rdd.map(lambda page: page[0])).schema
    if "results" not in schema.names:  # no text of UTF-8
        return spark.read.json(path, multiLine=True)
    return spark.read.schema(schema).json(path, multiLine=True)


def records_of(pages: DataFrame) -> DataFrame:
    """The records of all pages."""
    return pages.select(F.explode("results").alias("r")).select("r.*")


def missing_records(pages: DataFrame) -> DataFrame:
    """Announced minus landed records; 0 when the paging ran to its end."""
    return pages.agg(
        (F.coalesce(F.max("total_count"), F.lit(0)) - F.coalesce(F.sum(F.size("results")), F.lit(0))).alias(
            "missing"
        )
    )


def complete_records(pages: DataFrame) -> DataFrame:
    """The records of all pages; paging that stopped before the announced total is an error."""
    missing = missing_records(pages).head()["missing"]
    if missing > 0:
        raise ValueError(f"{missing} announced records were not landed")
    return records_of(pages)


def first_csv_resource(manifests: DataFrame, key: str = "id") -> DataFrame:
    """Per manifest, the url of its first CSV resource (format in any case)."""
    listed = manifests.select(key, F.posexplode("resources").alias("at", "r"))
    found = listed.where(F.lower("r.format") == "csv")
    return found.groupBy(key).agg(F.min_by("r.url", "at").alias("url"))
