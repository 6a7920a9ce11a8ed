"""Arrow batches inside Spark tasks: carried columns, slices bounded in bytes, flat views of texts and lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20


def carried(df: DataFrame, keep: list[str], made: list[str]) -> list[str]:
    """Columns that go along; one that has the name of a made column gives way to it."""
    taken = {m.lower() for m in made}
    return [c for c in dict.fromkeys(keep) if c.lower() not in taken]


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with batches of BATCH_BYTES: 10,000 long texts would not fit a worker. Sets this on the session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    made: dict[str, str],
    work: Callable[[pa.Array], list[pa.Array]],
    end: Callable[[], None] = lambda: None,
) -> DataFrame:
    """Columns ``keep`` plus ``made`` (name -> SQL type), from work(texts) over slices of a few megabytes.

    A null text reaches ``work`` as an empty one. ``end`` runs when a task is through, to free what it holds.
    """
    kept = carried(df, keep, list(made))
    types = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in kept] + [f"`{c}` {t}" for c, t in made.items()])
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text_of_row"))
    names = kept + list(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text_of_row"):
                out = work(part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *out], names=names)
        end()

    return arrow_map(source, run, schema)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of about ``limit`` bytes of text; a longer single row is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text array and the n + 1 offsets of its rows."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + length) of all rows."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)


def int_lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def texts_from(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Text array from flat valid UTF-8 bytes."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def packed(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``packed``, the compressed text, for joins that move whole texts. No text may be null."""
    types = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["packed binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            blobs = pa.array([press(t.as_buffer()) for t in batch.column(text)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], blobs], [*keep, "packed"])

    return arrow_map(df.select(*keep, text), run, schema)


def unpacked(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with the bytes of the texts as last column, ``text``."""
    unpack = zstandard.ZstdDecompressor().decompress
    names = [n for n in batch.schema.names if n != "packed"]
    blobs = batch.column("packed")
    at, texts, size = 0, [], 0
    for row in range(len(batch)):
        texts.append(unpack(blobs[row].as_py()))
        size += len(texts[-1])
        if size >= limit or row + 1 == len(batch):
            part = batch.slice(at, len(texts))
            yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(texts, pa.binary())], [*names, "text"])
            at, texts, size = row + 1, [], 0
