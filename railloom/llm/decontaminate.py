"""Benchmark passages in documents, by the q-gram lemma: a filter in diagonal bands, then banded alignment.

Texts are compared in lower case with everything but letters and digits joined to single blanks. A benchmark item has
a window at every place. A region of a document that is within ``edits`` of a window of n bytes shares at least
n + 1 - q - q * edits q-grams with it, on diagonals (place in the document minus place in the item) that differ by
``edits`` at most. The q-grams are indexed once per item: diagonals are grouped into overlapping bands, and where the
q-grams of an item in a band reach the bound within a window, that window is verified by an alignment of the whole
window that stays inside the band.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.llm.batches import map_texts, ragged

Q = 8  # bytes, so that a q-gram is one 64-bit number
WINDOW = 80
EDIT_SHARE = 0.08
SHORTEST = 24
BAND = 32
ALIGN_ROWS = 1 << 13
#: Benchmark text that one pass over the documents holds; a larger benchmark takes several passes.
BLOCK_BYTES = 4 << 20
FILTER_BITS = 22
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

_KIND = np.full(256, 32, np.uint8)
_KIND[48:58] = np.arange(48, 58)
_KIND[97:123] = np.arange(97, 123)
_KIND[128:] = np.arange(128, 256)
MATCHES = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>"


def normal_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Normalised UTF-8 bytes of all texts, each followed by Q zero bytes, and where each text begins."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    gap = b"\0" * Q
    data = np.frombuffer(gap.join([*raw, b""]), np.uint8)
    ends = np.cumsum(sizes + Q)
    kinds = _KIND[data]
    wall = np.zeros(len(data), bool)
    for k in range(Q):
        wall[ends - Q + k] = True
    kinds[wall] = 0
    stays = np.ones(len(data), bool)
    stays[1:] = (kinds[1:] != 32) | (kinds[:-1] != 32)
    kept = np.concatenate([[0], np.cumsum(stays)])
    return kinds[stays], kept[np.concatenate([[0], ends[:-1]])] if len(ends) else np.zeros(0, np.int64)


def grams(data: np.ndarray) -> np.ndarray:
    """The q-gram that begins at each byte but the last Q - 1."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    return np.lib.stride_tricks.as_strided(data.view(), (len(data) - Q + 1, Q), (1, 1)).copy().view(np.uint64)[:, 0]


@dataclass
class Index:
    ids: np.ndarray  # of the items
    data: np.ndarray  # bytes of all items, each filled up to a window with byte 1
    begins: np.ndarray  # where the bytes of an item begin
    counts: np.ndarray  # windows of an item, one at every place
    widths: np.ndarray  # bytes of each of its windows
    allowances: np.ndarray  # edits of each of its windows
    bounds: np.ndarray  # q-grams that a match of a window shares at least
    reach: int  # bytes of the longest item
    keys: np.ndarray  # distinct q-grams, ascending
    firsts: np.ndarray  # entries of a key: first and last + 1
    owners: np.ndarray  # item and place of each entry
    places: np.ndarray
    bits: np.ndarray  # which hashed q-grams exist

    # every window written out, to look at; the search itself needs none of these

    @cached_property
    def items(self) -> np.ndarray:
        return np.repeat(self.ids, self.counts)

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.repeat(self.widths, self.counts)

    @cached_property
    def edits(self) -> np.ndarray:
        return np.repeat(self.allowances, self.counts)

    @cached_property
    def patterns(self) -> np.ndarray:
        return self.data[ragged(self.begins, self.counts)[:, None] + np.arange(WINDOW)]


def allowed(length: int) -> int:
    """Edits that leave the q-gram bound at two at least."""
    return max(0, min(int(length * EDIT_SHARE), (length - Q - 1) // Q))


def build(items: list[tuple[int, str]]) -> Index:
    known: list[tuple[int, bytes]] = []
    for item, text in items:
        data, _ = normal_bytes([text])
        body = data[:-Q].tobytes().strip(b" ")
        if len(body) >= SHORTEST:
            known.append((item, body))
    sizes = np.array([len(b) for _, b in known], np.int64)
    room = np.maximum(sizes, WINDOW)
    widths = np.minimum(sizes, WINDOW)
    edits = np.array([allowed(int(n)) for n in widths], np.int64)
    parts = [grams(np.frombuffer(b, np.uint8)) for _, b in known]
    all_grams = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(known)), [len(p) for p in parts])
    place = np.concatenate([np.arange(len(p)) for p in parts]) if parts else np.zeros(0, np.int64)
    order = np.argsort(all_grams, kind="stable")
    keys, first = np.unique(all_grams[order], return_index=True)
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[(keys * _SPREAD) >> np.uint64(64 - FILTER_BITS)] = True
    return Index(
        ids=np.array([i for i, _ in known], np.int64),
        data=np.frombuffer(b"".join(b.ljust(WINDOW, b"\1") for _, b in known), np.uint8),
        begins=np.cumsum(room) - room,
        counts=room - WINDOW + 1,
        widths=widths,
        allowances=edits,
        bounds=widths + 1 - Q - Q * edits,
        reach=int(sizes.max(initial=0)),
        keys=keys,
        firsts=np.append(first, len(order)),
        owners=owner[order],
        places=place[order],
        bits=bits,
    )


def _spread(hit: np.ndarray, reach: int, least: int) -> np.ndarray:
    """Places of hits that lie in some stretch of ``reach`` bytes with ``least`` hits."""
    sums = np.concatenate([[0], np.cumsum(hit)])
    ends = np.minimum(np.arange(len(hit)) + reach, len(hit))
    dense = sums[ends] - sums[:-1] >= least
    marks = np.zeros(len(hit) + 1, np.int64)
    at = np.flatnonzero(dense)
    np.add.at(marks, at, 1)
    np.add.at(marks, ends[at], -1)
    return np.flatnonzero(hit & (np.cumsum(marks[:-1]) > 0))


def band_candidates(index: Index, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, band, window) with enough common q-grams, the window given by its place in the item.

    Band b holds the diagonals from b * BAND - reach on, BAND + edits of them.
    """
    found = grams(data)
    hit = index.bits[(found * _SPREAD) >> np.uint64(64 - FILTER_BITS)]
    places = _spread(hit, WINDOW + int(index.allowances.max()), int(index.bounds.min()))
    at = np.minimum(np.searchsorted(index.keys, found[places]), len(index.keys) - 1)
    true = index.keys[at] == found[places]
    places, at = places[true], at[true]
    per_place = index.firsts[at + 1] - index.firsts[at]
    entry = ragged(index.firsts[at], per_place)
    item, inside = index.owners[entry], index.places[entry]
    diagonal = np.repeat(places, per_place) - inside + index.reach
    band = diagonal // BAND
    early = diagonal - band * BAND < index.allowances[item]  # also within reach of the band before
    keys = np.concatenate([item << 40 | band, (item << 40 | (band - 1))[early]])
    inside = np.concatenate([inside, inside[early]])
    pairs, group, counts = np.unique(keys, return_inverse=True, return_counts=True)
    item, band = pairs >> 40, pairs & ((1 << 40) - 1)
    stays = counts[group] >= index.bounds[item[group]]
    group, inside = group[stays], inside[stays]
    order = np.lexsort((inside, group))
    group, inside = group[order], inside[order]
    # a window that holds the bound-th q-gram after this one and this one, too, reaches the bound
    bound, width = index.bounds[item[group]], index.widths[item[group]]
    there = np.minimum(np.arange(len(group)) + bound - 1, len(group) - 1)
    holds = (np.arange(len(group)) + bound - 1 < len(group)) & (group[there] == group) & (inside[there] - inside <= width - Q)
    low = (inside[there] - (width - Q))[holds]
    high, group = inside[holds], group[holds]
    # both ends ascend within a group: what an earlier stretch of windows holds is left out
    again = np.r_[False, group[1:] == group[:-1]] if len(group) else np.zeros(0, bool)
    low = np.maximum(low, np.where(again, np.r_[0, high[:-1] + 1][: len(high)], 0))
    high = np.minimum(high, index.counts[item[group]] - 1)
    size = np.maximum(high - low + 1, 0)
    return np.repeat(item[group], size), np.repeat(band[group], size), ragged(low, size)


def align(index: Index, data: np.ndarray, item: np.ndarray, band: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of the whole window against any stretch of text in the band, and where that stretch ends.

    More edits than any window is allowed may come out too high.
    """
    slack = int(index.allowances.max())
    width = BAND + 3 * slack + 1
    column = np.arange(width)
    padded = np.concatenate([np.zeros(2 * WINDOW, np.uint8), data, np.zeros(4 * WINDOW + width, np.uint8)])
    best, end = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
    for at in range(0, len(item), ALIGN_ROWS):
        some = slice(at, at + ALIGN_ROWS)
        start = band[some] * BAND - index.reach + window[some] - slack
        text = padded[start + 2 * WINDOW + np.arange(WINDOW + width)[:, None]]
        pattern = index.data[index.begins[item[some]] + window[some] + np.arange(WINDOW)[:, None]]
        lengths = index.widths[item[some]]
        ends_here = set(lengths.tolist())
        # costs less their column, so that a byte of text that the window lacks adds nothing
        cost = np.repeat(-column.astype(np.int16)[:, None], len(start), axis=1)
        for i in range(1, WINDOW + 1):
            step = cost + (text[i - 1 : i - 1 + width] != pattern[i - 1])
            np.minimum(step[:-1], cost[1:] + np.int16(2), out=step[:-1])
            run = 1
            while run <= max(1, slack):  # runs of up to 2 * run - 1 such bytes
                step[run:] = np.minimum(step[run:], step[:-run])
                run *= 2
            cost = step
            if i in ends_here:
                done = np.flatnonzero(lengths == i)
                total = cost[:, done] + column[:, None]
                best[at + done] = total.min(axis=0)
                end[at + done] = start[done] + i + total.argmin(axis=0)
    return best, end


def matches(index: Index, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """(item, start, end, edits) per text: of each item the window with the fewest edits, first in the text.

    Start and end count bytes of the normalised text.
    """
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    if not len(index.ids):
        return out
    data, begins = normal_bytes(texts)
    item, band, window = band_candidates(index, data)
    if not len(item):
        return out
    edits, end = align(index, data, item, band, window)
    good = edits <= index.allowances[item]
    item, edits, end = item[good], edits[good], end[good]
    owner = np.searchsorted(begins, end - 1, side="right") - 1
    stop = end - begins[owner]
    start = np.maximum(0, stop - index.widths[item])
    name = index.ids[item]
    order = np.lexsort((stop, start, edits, name, owner))
    owner, name = owner[order], name[order]
    first = order[np.r_[True, (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])]] if len(order) else order
    columns = [x[first].tolist() for x in (np.searchsorted(begins, end - 1, side="right") - 1, index.ids[item], start, stop, edits)]
    for n, *match in zip(*columns, strict=True):
        out[n].append(tuple(match))
    return out


def find(
    df: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Columns ``keep`` plus ``matches``, an array of (item_id, start, end, edits), empty for a clean document.

    A document matches an item if a stretch of it is within 8 % edits of 80 normalised bytes of the item, wherever in
    the item they begin, or of the whole item where that is shorter. An excerpt of 80 bytes or more always matches, one
    of under 74 bytes of a longer item never does. Items under 24 normalised bytes, null items and items without id match nothing;
    null, empty and short texts are clean. The benchmark is dealt by a hash of its ids to blocks of about
    ``block_bytes``; each block is broadcast and all documents pass it. A kept column called ``matches`` is replaced.
    """
    spark = df.sparkSession
    known = benchmark.where(F.col(f"`{item}`").isNotNull() & F.col(f"`{item_text}`").isNotNull()).select(
        F.col(f"`{item}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text")
    )
    size = known.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = -(-size // block_bytes)
    kept = [c for c in dict.fromkeys(keep) if c.lower() != "matches"]
    carried = [c for c in dict.fromkeys([*kept, text])]
    result = df.select(*[F.col(f"`{c}`") for c in carried], F.array().cast(MATCHES).alias("_found"))
    for block in range(blocks):
        members = known.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        shared = spark.sparkContext.broadcast(build([(r["item_id"], r["text"]) for r in members]))

        def work(texts: pa.Array, shared=shared) -> list[pa.Array]:
            rows = [[{"item_id": i, "start": s, "end": e, "edits": k} for i, s, e, k in m] for m in matches(shared.value, texts.to_pylist())]
            struct = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
            return [pa.array(rows, pa.list_(struct))]

        passed = map_texts(result, text, [*carried, "_found"], {"_more": MATCHES}, work)
        result = passed.select(*[F.col(f"`{c}`") for c in carried], F.concat("_found", "_more").alias("_found"))
    return result.select(*[F.col(f"`{c}`") for c in kept], F.col("_found").alias("matches"))
