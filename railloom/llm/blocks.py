"""Documents in blocks: what a block needs of a corpus-wide table is joined once per distinct key, not per document.

A block is one row: the kept columns of its documents, a compressed payload that says how the documents use the keys,
and the distinct keys. Blocks are staged, so their numbers are settled; a table with a value per key is then joined to
the exploded keys and folded back to one list per block, whose length is bounded by the text of the block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from railloom.llm.batches import arrow_map, carried, slices
from railloom.operators.staging import stage

BLOCK_BYTES = 16 << 20
_TEXT, _ROW = "_text_of_row", "_row"


class Gatherer(Protocol):
    """Collects the documents of one block."""

    def add(self, texts: list[str], more: list[pa.Array]) -> None:
        """Takes texts (null: empty) and the columns asked for beside them."""

    def close(self) -> list:
        """Values of the block's own columns; the next block begins empty."""


def build(
    df: DataFrame, text: str, keep: list[str], made: list[str], more: list[str], columns: str, gatherer: Callable[[], Gatherer], block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Staged blocks: ``block``, ``rows`` (the columns ``keep`` of each document) and ``columns``."""
    kept = carried(df, keep, made)
    row = F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(0).alias("_")) if not kept else F.struct(*[F.col(f"`{c}`") for c in kept])
    source = df.select(row.alias(_ROW), *[F.col(f"`{m}`") for m in more], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(_TEXT))
    own = StructType.fromDDL(columns)
    schema = StructType([*StructType.fromDDL("block string"), StructField("rows", ArrayType(source.schema[_ROW].dataType)), *own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        gather, rows, size, number = gatherer(), [], 0, 0

        def flush() -> pa.RecordBatch:
            found = pa.concat_arrays(rows)
            folded = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found)
            name = pa.array([f"{task.partitionId()}-{number}"])
            return pa.RecordBatch.from_arrays([name, folded, *[pa.array([v]) if not isinstance(v, pa.Array) else v for v in gather.close()]], names=schema.names)

        for batch in batches:
            for part in slices(batch, _TEXT):
                texts = part.column(_TEXT)
                gather.add(texts.to_pylist(), [part.column(m) for m in more])
                rows.append(part.column(_ROW))
                size += texts.nbytes
                if size >= block_bytes:
                    yield flush()
                    gather, rows, size, number = gatherer(), [], 0, number + 1
        if rows:
            yield flush()

    return stage(arrow_map(source, run, schema), "blocks")


def keys_of(blocks: DataFrame, keys: str = "keys") -> DataFrame:
    """``block``, ``pos`` and ``key`` of every distinct key of a block."""
    return blocks.select("block", F.posexplode(keys).alias("pos", "key"))


def with_values(blocks: DataFrame, table: DataFrame) -> DataFrame:
    """The blocks with ``found``: position and values of those of their keys that ``table`` (one row a ``key``) has."""
    values = [F.col(f"`{c}`") for c in table.columns if c != "key"]
    found = keys_of(blocks).join(table, "key").groupBy("block").agg(F.collect_list(F.struct("pos", *values)).alias("found"))
    return blocks.drop("keys").join(found, "block", "left")


def resolve(blocks: DataFrame, made: dict[str, str], work: Callable[[dict], list[pa.Array]]) -> DataFrame:
    """One row per document again: its kept columns and ``made`` (name -> SQL type), from work(block)."""
    kept = [f for f in blocks.schema["rows"].dataType.elementType if f.name != "_"]
    schema = StructType([*kept, *StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in made.items()))])
    others = [c for c in blocks.columns if c not in ("block", "rows")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                rows = batch.column("rows").slice(n, 1).flatten()
                block = {c: batch.column(c).slice(n, 1) for c in others}
                columns = [rows.field(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, *work(block)], names=schema.names)

    return arrow_map(blocks, run, schema)


def aligned(found: pa.Array, n_keys: int, names: dict[str, type]) -> list[np.ndarray]:
    """Values of ``found`` by position of the key; 0 where the table lacks the key."""
    out = [np.zeros(n_keys, kind) for kind in names.values()]
    flat = found.flatten()
    if len(flat):
        pos = flat.field("pos").to_numpy(zero_copy_only=False)
        for values, name in zip(out, names, strict=True):
            values[pos] = flat.field(name).to_numpy(zero_copy_only=False)
    return out


def press(*arrays: np.ndarray, tail: bytes = b"") -> bytes:
    """Integer arrays, and bytes behind them, in one compressed payload."""
    head = np.array([len(arrays), *[len(a) for a in arrays]], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=6).compress(head + b"".join(np.ascontiguousarray(a, np.int32).tobytes() for a in arrays) + tail)


def unpress(payload: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8)
    at = 8 * (n + 1)
    out = []
    for size in sizes:
        out.append(np.frombuffer(raw, np.int32, int(size), at))
        at += 4 * int(size)
    return out, raw[at:]
