"""Removal of repeated passages by prefix-free parsing: phrases, their dictionary, and its suffix array.

The rolling hash of 64-grams sets triggers: of all 64-grams in a string of 200 bytes the one with the least hash. A
phrase is a run of neighbouring strings with the same trigger, taken with the 199 bytes that the last of them reaches
on, so no string crosses phrases and equal strings lie in phrases with equal triggers. The parse is counted, never
sorted as a whole:

* a phrase whose trigger occurs once in the corpus has no string that repeats;
* where all phrases of a trigger are equal and occur twice or more, all their strings repeat;
* for the rest, the dictionary of distinct phrases is put in suffix order (prefix doubling to a depth of 200 bytes),
  and the strings of equal rank add up how often their phrases occur in the parse.

The dictionary is ordered in blocks, one per trigger. A trigger with more distinct phrases than a block holds is cut by
something that equal strings share: they have the trigger at the same offset, so the offsets are halved, and the strings
of one half have a longer stretch of bytes in common (the trigger and what surrounds it within all of them), which is
the trigger of the next round. Equal halves are counted as one. After eight rounds at most the stretch is a whole
string, whose equal copies are one row, so every block is final, whatever the frequency of a passage.

What is carried to the documents are the strings that occur once; every other byte position starts a repeated one.
Because phrases overlap by all but one byte of a string, suffixes of the parse beyond a phrase never decide a
comparison, and the order of the parse needs no array of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.llm.batches import arrow_map, flat_bytes, packed, slices
from railloom.operators.staging import stage

SPAN = 200
TRIGGER = 64
BLOCK_BYTES = 2 << 20
#: Distinct phrases of one trigger that a block of the dictionary holds (about BLOCK_BYTES); beyond it offsets are halved.
BLOCK_PHRASES = 6_000
LENGTH_BITS = 12  # of a place: first start << LENGTH_BITS | number of strings - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2^bits of each."""
    up, down = _BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))
    ups, downs = np.ones(1, np.uint64), np.ones(1, np.uint64)
    with np.errstate(over="ignore"):
        for _ in range(bits):
            ups, downs = np.concatenate([ups, ups * up]), np.concatenate([downs, downs * down])
            up, down = up * up, down * down
    return ups, downs


class Rolling:
    """Hashes of any stretch of bytes from prefix sums; equal stretches have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        ups, self.downs = _powers(max(21, int(len(data) + 1).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * ups[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.downs[start])


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def phrases(rolling: Rolling, ends: np.ndarray, span: int = SPAN, trigger: int = TRIGGER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first start, last start, trigger place) of every phrase, places counted over all texts.

    Of all ``trigger``-grams in a string of ``span`` bytes the one with the least rolling hash, the leftmost if equal,
    is its trigger. A phrase is a run of strings with the same trigger: it depends on nothing outside them.
    """
    total = int(ends[-1])
    none = np.zeros(0, np.int64)
    if total < span:
        return none, none, none, none
    at = np.arange(total - trigger + 1)
    hashes = rolling.of(at, at + trigger)
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    chosen = (least_in_window(keys, span - trigger + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(chosen))
    text = np.searchsorted(ends, starts, side="right") - 1
    valid = starts + span <= ends[text + 1]
    starts, chosen, text = starts[valid], chosen[valid], text[valid]
    if not len(starts):
        return none, none, none, none
    fresh = np.r_[True, (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(starts)] - 1
    return text[first], starts[first], starts[last], chosen[first]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def parse(rows: DataFrame, span: int, trigger: int) -> DataFrame:
    """The phrases: key of the trigger, hash of the phrase, how often, one place (doc_id, copy, place) and ``lead``, the
    offset of the trigger in the first string.

    Phrases that a slice of documents repeats are counted there already.
    """
    names = ["trigger", "phrase", "n", "doc_id", "copy", "place", "lead"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, ends = flat_bytes(part.column("text"))
                rolling = Rolling(data)
                text, first, last, at = phrases(rolling, ends, span, trigger)
                keys = rolling.of(at, at + trigger)
                shape = (last - first).astype(np.uint64) << np.uint64(32) | (at - first).astype(np.uint64)
                whole = rolling.of(first, last + span) ^ mix(shape)
                order = np.lexsort((whole, keys))
                keys, whole = keys[order], whole[order]
                new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (whole[1:] != whole[:-1])]) if len(keys) else np.zeros(0, np.int64)
                counts = np.diff(np.r_[new, len(keys)])
                pick = order[new]
                owner = pa.array(text[pick])
                place = (first - ends[text])[pick] << LENGTH_BITS | (last - first)[pick]
                columns = [_signed(keys[new]), _signed(whole[new]), pa.array(counts), part.column("doc_id").take(owner), part.column("copy").take(owner), pa.array(place), pa.array((at - first)[pick].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return arrow_map(rows, work, "trigger long, phrase long, n long, doc_id long, copy long, place long, lead int")


def suffix_classes(data: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """Rank of the string of ``span`` bytes at each start, in suffix order; equal strings have equal ranks.

    Prefix doubling: ranks of 8 bytes, then of twice as many from two ranks, then of ``span`` from two overlapping
    ones. Places near the end of the data are padded; no string reaches there.
    """
    if span < 8:
        windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(span, np.uint8)]), span)[starts]
        return np.unique(windows, axis=0, return_inverse=True)[1].ravel()
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    grams = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1)).copy().view(">u8")[:, 0].astype(np.uint64)
    rank = np.unique(grams, return_inverse=True)[1].astype(np.uint64)
    depth = 8
    while depth * 2 <= span:
        ahead = np.concatenate([rank[depth:], np.zeros(min(depth, len(rank)), np.uint64)])
        rank = np.unique(rank << np.uint64(32) | ahead[: len(rank)], return_inverse=True)[1].astype(np.uint64)
        depth *= 2
    return np.unique(rank[starts] << np.uint64(32) | rank[starts + span - depth], return_inverse=True)[1]


def contexts(places: DataFrame, texts: DataFrame, span: int) -> DataFrame:
    """The bytes of dictionary phrases, cut from the texts of their documents. Other columns of ``places`` go along."""
    carried = [c for c in places.columns if c not in ("doc_id", "copy")]
    types = dict(places.dtypes)
    wanted = F.collect_list(F.struct(*carried)).alias("wanted")
    per_doc = places.groupBy("doc_id", "copy").agg(wanted).select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "wanted")
    joined = texts.join(per_doc, texts["doc_id"].eqNullSafe(per_doc["_id"]) & (texts["copy"] == per_doc["_copy"]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in range(len(batch)):
                data = unpack(batch.column("packed")[row].as_py())
                wanted = batch.column("wanted")[row].values
                place = wanted.field("place").to_numpy()
                first, more = place >> LENGTH_BITS, place & ((1 << LENGTH_BITS) - 1)
                blobs = [data[f : f + m + span] for f, m in zip(first.tolist(), more.tolist(), strict=True)]
                columns = [wanted.field(c) for c in carried]
                columns += [pa.array([batch.column(c)[row].as_py()] * len(blobs), pa.int64()) for c in ("doc_id", "copy")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(blobs, pa.binary())], [*carried, "doc_id", "copy", "bytes"])

    schema = ", ".join([f"{c} {types[c]}" for c in carried] + ["doc_id long, copy long, bytes binary"])
    return arrow_map(joined.select("doc_id", "copy", "packed", "wanted"), work, schema)


def halves(table: pa.Table, span: int) -> pa.RecordBatch:
    """Phrases cut in two by the offset of their trigger; equal halves of one trigger are counted together.

    The strings of a phrase have their trigger at offsets low..high (``lead`` is that of the first one, the next string
    has one less). Those of a half share the bytes from ``low`` before the trigger to ``span - high`` after its start;
    their hash, with the bounds of the half, is the new trigger.
    """
    place, lead, low, high = (table.column(c).to_numpy() for c in ("place", "lead", "low", "high"))
    first, last = place >> LENGTH_BITS, place & ((1 << LENGTH_BITS) - 1)
    data, ends = flat_bytes(table.column("bytes").chunk(0))
    middle = (low + high + 1) // 2
    # strings 0..upper have the trigger at the middle or beyond, the others before it
    upper = np.minimum(lead - middle, last)
    row = np.arange(len(place))
    parts = [(row, np.zeros_like(last), upper, middle, high), (row, np.maximum(upper + 1, 0), last, low, middle - 1)]
    row, begin, end, low, high = (np.concatenate(c) for c in zip(*parts, strict=True))
    there = begin <= end
    row, begin, end, low, high = (c[there] for c in (row, begin, end, low, high))
    rolling = Rolling(data)
    at = ends[row] + lead[row]
    bounds = mix(low.astype(np.uint64) << np.uint64(32) | high.astype(np.uint64))
    keys = rolling.of(at - low, at - high + span) ^ bounds
    shape = (end - begin).astype(np.uint64) << np.uint64(32) | (lead[row] - begin).astype(np.uint64)
    whole = rolling.of(ends[row] + begin, ends[row] + end + span) ^ mix(shape)
    order = np.lexsort((whole, keys))
    new = np.flatnonzero(np.r_[True, (np.diff(keys[order].view(np.int64)) != 0) | (np.diff(whole[order].view(np.int64)) != 0)])
    count = np.add.reduceat(table.column("n").to_numpy()[row][order], new)
    pick = order[new]
    owner = pa.array(row[pick])
    flat = data.tobytes()
    blobs = [flat[a:b] for a, b in zip((ends[row] + begin)[pick].tolist(), (ends[row] + end + span)[pick].tolist(), strict=True)]
    columns = [
        _signed(keys[pick]), _signed(whole[pick]), pa.array(count), *[table.column(c).chunk(0).take(owner) for c in ("doc_id", "copy")],
        pa.array((first[row] + begin)[pick] << LENGTH_BITS | (end - begin)[pick]), pa.array((lead[row] - begin)[pick].astype(np.int32)),
        pa.array(low[pick].astype(np.int32)), pa.array(high[pick].astype(np.int32)), pa.array(blobs, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, PIECE)


PIECE = ["trigger", "phrase", "n", "doc_id", "copy", "place", "lead", "low", "high", "bytes"]


def runs_alone(table: pa.Table, span: int) -> pa.RecordBatch:
    """Runs of strings that occur once among all phrases of the table: owner's doc_id and copy, and place."""
    n_strings = (table.column("place").to_numpy() & ((1 << LENGTH_BITS) - 1)) + 1
    data, ends = flat_bytes(table.column("bytes").chunk(0))
    owner = np.repeat(np.arange(len(n_strings)), n_strings)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(n_strings) - n_strings, n_strings)
    kind = suffix_classes(data, ends[owner] + offset, span)
    total = np.bincount(kind, weights=table.column("n").to_numpy()[owner])
    at = np.flatnonzero(total[kind] == 1)
    fresh = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])] if len(at) else np.zeros(0, bool)
    begin = at[fresh]
    length = np.diff(np.r_[np.flatnonzero(fresh), len(at)])
    first = (table.column("place").to_numpy() >> LENGTH_BITS)[owner[begin]] + offset[begin]
    who = pa.array(owner[begin])
    ids = {c: table.column(c).chunk(0).take(who) for c in ("doc_id", "copy")}
    made = ids | {"place": pa.array(first << LENGTH_BITS | length - 1)}
    kinds = {"lead": pa.int32(), "low": pa.int32(), "high": pa.int32(), "bytes": pa.binary()}
    return pa.RecordBatch.from_arrays([made[c] if c in made else pa.nulls(len(begin), kinds.get(c, pa.int64())) for c in PIECE], PIECE)


def resolve(dictionary: DataFrame, span: int) -> DataFrame:
    """Places of runs of strings that occur once (trigger is null), and the halves of what no block holds.

    Phrases of a trigger with one block meet in one task, the others are spread by salt and only cut in two.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if held and size > BLOCK_BYTES:
                # whole blocks only: that of the last row held may go on in this batch; what is only cut ends anywhere
                other = batch.column("trigger").to_numpy() != held[-1].column("trigger")[-1].as_py()
                cut = int(np.argmax(np.r_[other | (batch.column("blocks").to_numpy() > 1), True]))
                held.append(batch.slice(0, cut))
                batch = batch.slice(cut)
                if len(batch):
                    yield from settled(held)
                    held, size = [], 0
            if len(batch):
                held.append(batch)
                size += batch.column("bytes").nbytes
        if held:
            yield from settled(held)

    def settled(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        one = pa.array(table.column("blocks").to_numpy() == 1)
        for part, of in ((table.filter(one), runs_alone), (table.filter(pc.invert(one)), halves)):
            if len(part):
                yield of(part.combine_chunks(), span)

    schema = "trigger long, phrase long, n long, doc_id long, copy long, place long, lead int, low int, high int, bytes binary"
    dealt = dictionary.repartition("trigger", "salt").sortWithinPartitions("trigger", "salt")
    return arrow_map(dealt, work, schema)


def _dealt(phrases_: DataFrame) -> DataFrame:
    """With the block of each phrase: one per trigger, or as many as its ``rows`` phrases fill. A single string has one."""
    blocks = F.when(F.col("low") == F.col("high"), 1).otherwise(F.ceil(F.col("rows") / BLOCK_PHRASES)).cast("int")
    return phrases_.withColumn("blocks", blocks).withColumn("salt", F.pmod("phrase", "blocks").cast("int")).drop("rows")


def repeated(rows: DataFrame, span: int = SPAN, trigger: int = TRIGGER) -> DataFrame:
    """Runs of string starts that occur once in the corpus: doc_id, copy, place. rows: doc_id, copy, text."""
    # a frequent trigger is split over tasks in the join, too, though the sum after it then needs an exchange
    rows.sparkSession.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    place = ["doc_id", "copy", "place"]
    counted = parse(rows, span, trigger).groupBy("trigger").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("phrase").alias("low"), F.max("phrase").alias("high"), *[F.first(c).alias(c) for c in place]
    )
    once = F.col("n") == 1
    found = stage(
        counted.where(once | (F.col("low") != F.col("high"))).select(
            F.when(~once, F.col("trigger")).alias("trigger"), F.when(~once, F.col("rows")).alias("rows"), *[F.when(once, F.col(c)).alias(c) for c in place]
        ),
        "phrases",
    )
    mixed = found.where("trigger IS NOT NULL").select("trigger", "rows")
    again = parse(rows, span, trigger).join(mixed, "trigger")
    distinct = again.groupBy("trigger", "phrase").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("rows", *place, "lead")])
    ranged = distinct.withColumn("low", F.lit(0)).withColumn("high", F.lit(span - trigger))
    alone = found.where("trigger IS NULL").select(*place)
    level = contexts(_dealt(ranged), packed(rows, ["doc_id", "copy"]), span)
    most = mixed.agg(F.max("rows")).head()[0] or 0
    while True:
        resolved = stage(resolve(level, span), "dictionary")
        alone = alone.union(resolved.where("trigger IS NULL").select(*place))
        if most <= BLOCK_PHRASES:
            return alone
        cut = resolved.where("trigger IS NOT NULL")
        rest = [c for c in PIECE if c not in ("trigger", "phrase", "n")]
        same = cut.groupBy("trigger", "phrase").agg(F.sum("n").alias("n"), F.first(F.struct(*rest)).alias("one")).select("trigger", "phrase", "n", "one.*")
        same = stage(same, "halves")
        sizes = same.groupBy("trigger").agg(F.count(F.lit(1)).alias("rows"))
        # one row per trigger that no block holds: few, as each stands for thousands of phrases
        large = stage(sizes.where(F.col("rows") > BLOCK_PHRASES), "large")
        most = BLOCK_PHRASES + 1 if large.limit(1).count() else 0
        level = _dealt(same.join(large, "trigger", "left").withColumn("rows", F.coalesce("rows", F.lit(1).cast("long"))))


def remove(df: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = SPAN, trigger: int = TRIGGER) -> DataFrame:
    """doc_id, kept (binary), n_bytes, n_removed, n_spans and removed (array of start and end) of every row.

    Every byte that a repeated string of ``span`` bytes covers goes; texts shorter than that, null and empty ones stay
    as they are. Rows may repeat ids (a repeated row repeats all its strings); a null id is an id like another. The
    kept bytes may cut a character in two, so they are no string.
    """
    if not 8 <= trigger <= span < 1 << LENGTH_BITS:
        raise ValueError("a trigger has 8 bytes at least and a span holds it")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # a copy number tells rows of one id apart; without repeated ids it is not needed
    repeats = rows.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    rows = rows.withColumn("copy", F.xxhash64("text") if repeats else F.lit(0).cast("long"))
    unique = repeated(rows, span, trigger)
    per_doc = unique.groupBy("doc_id", "copy").agg(F.collect_list("place").alias("places")).select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "places")
    texts = packed(rows, ["doc_id", "copy"])
    joined = texts.join(per_doc, texts["doc_id"].eqNullSafe(per_doc["_id"]) & (texts["copy"] == per_doc["_copy"]), "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[tuple] = []
            for row in range(len(batch)):
                data = np.frombuffer(unpack(batch.column("packed")[row].as_py()), np.uint8)
                places = batch.column("places")[row]
                out.append(cut(data, places.values.to_numpy() if places.is_valid else np.zeros(0, np.int64), span))
            kept, sizes, removed, runs = zip(*out, strict=True) if out else ((), (), (), ())
            spans = pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            columns = [batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(r) for r in runs], pa.int64()), spans]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "removed"])

    return arrow_map(
        joined.select("doc_id", "packed", "places"),
        work,
        "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, removed array<struct<start:bigint,end:bigint>>",
    )


def cut(data: np.ndarray, places: np.ndarray, span: int) -> tuple[bytes, int, int, list[dict[str, int]]]:
    """Kept bytes, size, removed bytes and removed runs of one text; places are its strings that occur once."""
    n_starts = len(data) - span + 1
    if n_starts <= 0:
        return data.tobytes(), len(data), 0, []
    marks = np.zeros(n_starts + 1, np.int64)
    first = places >> LENGTH_BITS
    np.add.at(marks, first, 1)
    np.add.at(marks, first + (places & ((1 << LENGTH_BITS) - 1)) + 1, -1)
    twice = np.cumsum(marks[:-1]) == 0
    edges = np.flatnonzero(np.diff(np.r_[0, twice.astype(np.int8), 0]))
    starts, stops = edges[::2], edges[1::2] - 1 + span
    runs: list[list[int]] = []
    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = b
        else:
            runs.append([a, b])
    stays = np.ones(len(data), bool)
    for a, b in runs:
        stays[a:b] = False
    kept = data[stays]
    return kept.tobytes(), len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in runs]

