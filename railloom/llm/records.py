"""Length-delimited binary records of token ids, with masked checksums and an offset index beside them.

A record is framed as

    length of the payload   uint64
    masked crc32 of it      uint32
    payload                 doc_id int64, has_id uint8, width uint8, count uint32, count ids of ``width`` bytes
    masked crc32 of it      uint32
    line feed               one byte

all little-endian. ``width`` is 2 while every id of the record is below 65,536, else 4. Files are numbered in
ascending order of the ids of their documents, and so are the records in a file. The index has one row per record:
file, record, doc_id, offset and length of the payload, n_tokens and start (tokens of all documents before it).
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railloom.llm.batches import BATCH_BYTES, arrow_map, ragged, slices
from railloom.llm.bpe import vocabulary_of

HEAD, META = struct.Struct("<QI"), struct.Struct("<qBBI")
MASK_SHIFT, MASK_ADD = 15, 0xA282EAD8
TABLE_CHUNKS, TABLE_WORDS = 200_000, 300_000
#: Text that a record file is meant to hold at most; a file is read as one binary value.
FILE_BYTES = 64 << 20
ARROW = {"int": pa.int32(), "long": pa.int64(), "array<int>": pa.list_(pa.int32())}

#: Fixed value: the pre-tokenizer pattern of the public lower-case word vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What the vocabulary file says of normalisation and words, as split() and WORDS do them.
WORD_RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False},
        ],
    },
}
#: Control characters that str.split() takes for white space and Unicode does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")


def masked(data: bytes) -> int:
    """crc32, rotated and shifted, so that a checksum of checksums stays useful."""
    crc = zlib.crc32(data)
    return (((crc >> MASK_SHIFT) | (crc << (32 - MASK_SHIFT))) + MASK_ADD) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    payload = META.pack(doc_id or 0, doc_id is not None, width, len(ids)) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes | pa.Buffer, at: int = 0) -> Iterator[tuple[int | None, np.ndarray, int, int]]:
    """(doc_id, ids, offset of the payload, its length) of every record from ``at`` on; damage raises ValueError."""
    data = memoryview(data)
    while at < len(data):
        if at + HEAD.size > len(data):
            raise ValueError(f"record at byte {at} is cut off")
        length, check = HEAD.unpack_from(data, at)
        if check != masked(data[at : at + 8]) or at + HEAD.size + length + 5 > len(data):
            raise ValueError(f"record at byte {at} has a damaged length")
        begin = at + HEAD.size
        payload = data[begin : begin + length]
        if struct.unpack_from("<I", data, begin + length)[0] != masked(payload):
            raise ValueError(f"record at byte {at} has a damaged payload")
        doc_id, known, width, count = META.unpack_from(payload)
        yield (doc_id if known else None), np.frombuffer(payload, f"<u{width}", count, META.size), begin, length
        at = begin + length + 5


class WordTokenizer:
    """The tokenizers library on distinct words: lower case, NFC, words by the pattern, ids kept per chunk of text.

    White space never takes part in a token, so a text is cut there and a chunk is encoded once per task. A vocabulary
    file with other rules raises ValueError.
    """

    def __init__(self, path: str, limit: int = TABLE_CHUNKS):
        from tokenizers import Tokenizer

        vocabulary_of(path, WORD_RULES, "</w>")
        library = Tokenizer.from_file(path)
        self.tokens_of, self.limit = library.model.tokenize, limit
        self.special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = regex.compile(WORDS).findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        self.symbol = [chr(256 + others.index(b)) if b in others else chr(b) for b in range(256)]
        self.words_met: dict[str, bytes] = {}
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def word(self, word: str) -> bytes:
        ids = self.words_met.get(word)
        if ids is None:
            text = word if word.isascii() and word.isalnum() else "".join(map(self.symbol.__getitem__, word.encode()))
            ids = self.words_met[word] = array("i", [t.id for t in self.tokens_of(text)]).tobytes()
        return ids

    def learn(self, chunks: set[str]) -> None:
        if len(self.rows) + len(chunks) > self.limit:
            self.clear()
        if len(self.words_met) > TABLE_WORDS:
            self.words_met = {}
        new = list(chunks.difference(self.rows))
        blobs = [self.word(c) if c.isalpha() else b"".join(map(self.word, self.words(c))) for c in new]
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.counts = np.concatenate([self.counts, sizes])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(blobs), np.int32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts back to back and how many each text has."""
        chunks: list[str] = []
        per_text: list[int] = []
        marks: list[tuple[int, int, int]] = []
        for n, text in enumerate(texts):
            before, at = len(chunks), 0
            for m in self.cut.finditer(text) if self.cut else ():
                chunks += split(text[at : m.start()])
                marks.append((len(chunks), self.special[m.group()], n))
                at = m.end()
            chunks += split(text[at:] if at else text)
            per_text.append(len(chunks) - before)
        self.learn(set(chunks))
        chosen = np.fromiter(map(self.rows.__getitem__, chunks), np.int64, len(chunks))
        counts = self.counts[chosen]
        ids = self.ids[ragged(self.starts[chosen], counts)]
        ends = np.r_[0, np.cumsum(counts)]
        edges = np.r_[0, np.cumsum(per_text)].astype(np.int64)
        totals = ends[edges[1:]] - ends[edges[:-1]]
        if marks:
            ids = np.insert(ids, ends[[k for k, _, _ in marks]], [i for _, i, _ in marks])
            totals = totals + np.bincount([n for _, _, n in marks], minlength=len(texts))
        return ids, totals


def split(text: str) -> list[str]:
    """Chunks without white space, normalised; a capital sigma has one lower case, wherever it stands."""
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    return re.split(r"[^\S\x1c-\x1f]+", text) if _NOT_SPACE.search(text) else text.split()


@lru_cache(maxsize=2)
def tokenizer_of(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def write(
    df: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text: str = "text", files: int | None = None
) -> None:
    """Encode all texts, append ``end_id`` to each and write the record files and the index under ``path``.

    Rows are dealt by ranges of ``id_col`` (a null id comes first; equal ids follow each other in any order, if need be
    over several files), so no task holds more than a range and nothing is gathered. Unless ``files`` says how many
    there are, a file has FILE_BYTES of text on average at most, so that its size does not grow with the table. A null text counts as empty: its record has the end id alone. An
    empty table gives an empty index. Other columns are not written. A file that a lost task left half written is
    never committed.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    n = files
    if not n:
        size = rows.agg(F.sum(F.octet_length("text").cast("long"))).head()[0] or 0
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    ordered = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first())

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = tokenizer.encode(part.column("text").to_pylist())
                ends = np.cumsum(counts)
                framed = [
                    frame(doc_id, np.r_[ids[e - c : e], end_id])
                    for doc_id, c, e in zip(part.column("doc_id").to_pylist(), counts, ends, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(framed, pa.binary())], ["value"])

    # the writer of lines copies bytes as they are; the line feed it adds ends the frame
    framed = arrow_map(ordered, records, "value binary")
    framed.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(f"{path}/data")
    _index(spark, path).write.parquet(f"{path}/index")


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    number = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^part-(\d+)", 1).cast("int")
    return files.select(number.alias("file"), "content")


def _index(spark: SparkSession, path: str) -> DataFrame:
    schema = "file int, record long, doc_id long, offset long, length long, n_tokens long, start_in_file long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                found = [(d, at, size, len(ids)) for d, ids, at, size in unframe(content.as_buffer())]
                counts = np.array([f[3] for f in found], np.int64)
                columns = [
                    pa.array([file] * len(found), pa.int32()),
                    pa.array(range(len(found)), pa.int64()),
                    *[pa.array([f[i] for f in found], pa.int64()) for i in range(3)],
                    pa.array(counts),
                    pa.array(np.cumsum(counts) - counts),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema_names(schema))

    return arrow_map(_files(spark, path), work, schema)


def schema_names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index with ``start``: tokens of all documents before the record.

    The running sum goes over one row per file, of which there is one per FILE_BYTES of text.
    """
    index = spark.read.parquet(f"{path}/index")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    firsts = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return index.join(firsts, "file").withColumn("start", F.col("base") + F.col("start_in_file")).drop("base", "start_in_file")


def scan(spark: SparkSession, path: str, made: dict[str, str], of: Callable[[np.ndarray], tuple]) -> DataFrame:
    """file, record and doc_id of all records and what ``of`` makes of their ids (``made``: name -> SQL type).

    Every checksum is verified; damage fails the job.
    """
    schema = ", ".join(["file int, record long, doc_id long", *[f"{name} {kind}" for name, kind in made.items()]])
    names, kinds = schema_names(schema), [pa.int32(), pa.int64(), pa.int64(), *[ARROW[k] for k in made.values()]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                held: list[tuple] = []
                size = 0
                for record, (doc_id, ids, _, _) in enumerate(unframe(content.as_buffer())):
                    held.append((file, record, doc_id, *of(ids)))
                    size += len(ids)
                    if size > 1 << 19:
                        yield table_of(held)
                        held, size = [], 0
                yield table_of(held)

    def table_of(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(*held, strict=True) if held else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return arrow_map(_files(spark, path), work, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records from the files: file, record, doc_id and ids."""
    return scan(spark, path, {"ids": "array<int>"}, lambda ids: (ids.astype(np.int32),))


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """Records in a random order that the seed fixes: place, file, record, doc_id and payload.

    Every file is read once and cut into its records in one pass, so what is shuffled are the payloads alone. Every
    checksum is verified; damage fails the job.
    """
    schema = "file int, record long, doc_id long, payload binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                data = content.as_buffer()
                held: list[tuple] = []
                size = 0
                for record, (doc_id, _, at, length) in enumerate(unframe(data)):
                    held.append((file, record, doc_id, data.slice(at, length).to_pybytes()))
                    size += length
                    if size > BATCH_BYTES:
                        yield payloads(held)
                        held, size = [], 0
                yield payloads(held)

    def payloads(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(*held, strict=True) if held else [()] * 4
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema_names(schema))

    cut = arrow_map(_files(spark, path), work, schema)
    return cut.select(F.xxhash64(F.lit(seed), "file", "record").alias("place"), *schema_names(schema)).orderBy("place", "file", "record")
