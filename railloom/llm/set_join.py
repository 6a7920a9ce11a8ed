"""Similarity join of documents on their sets of word shingles, with skipping by set relations.

Documents with equal sets form a class, and one row stands for the class. The shingles of a set are put in a global
order, common ones last (heavy hitters are counted over all documents), and a set is indexed by as many of its first
shingles as similarity asks for. The list of a shingle is sorted by set size; a set skips, block by block, what its
size and the positions in both sets rule out.

Answers are derived from those of similar sets: each set is first compared with a leader of its lists alone. Sets
that links connect then count as one, and only pairs between different components are looked at again. All pairs
that are left and that sketches as wide as the sets do not rule out are verified exactly, with each set travelling once
to the family it belongs to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.llm.batches import arrow_map, flat_bytes, packed, slices
from railloom.llm.components import connected
from railloom.operators.staging import stage

WORDS = 5
SHARE = 80  # percent of the union
BLOCK = 32
#: A shingle in more than one of HEAVY_SHARE documents goes to the end of the order. There are fewer than
#: HEAVY_SHARE x (mean set size) of them, which bounds what is broadcast.
HEAVY_SHARE = 4000
WINDOW_SHINGLES = 1 << 22
MEETING_SETS = 64
SKETCH_WORDS = 8
#: Ids that are broadcast at most, 8 MB of them.
BROADCAST_IDS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2^bits of each."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    ups, downs = np.ones(1, np.uint64), np.ones(1, np.uint64)
    up, down = _BASE, inverse
    with np.errstate(over="ignore"):
        for _ in range(bits):
            ups, downs = np.concatenate([ups, ups * up]), np.concatenate([downs, downs * down])
            up, down = up * up, down * down
    return ups, downs


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of all texts and the number of words per text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(ends) - 1, np.int64)
    low = _LOWER[data]
    solid = ~_WHITE[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[ends] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    finish = solid.copy()
    finish[:-1] &= ~solid[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    ups, downs = _powers(max(21, int(len(low)).bit_length()))
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * ups[: len(low)], out=sums[1:])
    raw = (sums[stops] - sums[starts]) * downs[starts]
    per_text = np.diff(np.searchsorted(starts, ends))
    return mix(raw + (stops - starts).astype(np.uint64) * _ODD[0]), per_text


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, ascending within a text, and the size of each set."""
    words, counts = word_hashes(data, ends)
    first = np.cumsum(counts) - counts
    n_shingles = np.where(counts >= WORDS, counts - WORDS + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(counts)), n_shingles)
    if not len(owner):
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    place = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    width = np.minimum(counts, WORDS)[owner]
    total = width.astype(np.uint64) * _ODD[1]
    for k in range(WORDS):
        total += np.where(k < width, padded[place + k] * _ODD[k], np.uint64(0))
    hashes = mix(total)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=len(counts))


def needed(n: np.ndarray) -> np.ndarray:
    """The least overlap of a set of size n with any partner."""
    return -(-n * SHARE // 100)


def overlap_needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """100 x overlap >= SHARE x (a + b - overlap), solved for the overlap."""
    return -(-(a + b) * SHARE // (100 + SHARE))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _sets_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(*flat_bytes(batch.column("text")))


def heavy_hitters(rows: DataFrame, total: int) -> np.ndarray:
    """Shingles that many documents share, rarest first.

    A shingle in more than one of HEAVY_SHARE documents is that frequent in at least one window of documents, so the
    windows' own heavy hitters, added up, contain it.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = docs = 0

        def heavy() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(3, docs / HEAVY_SHARE)
            return pa.RecordBatch.from_arrays([_signed(found[often]), pa.array(counts[often])], ["shingle", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                shingles, _ = _sets_of(part)
                held.append(shingles)
                size, docs = size + len(shingles), docs + len(part)
                if size >= WINDOW_SHINGLES:
                    yield heavy()
                    held, size, docs = [], 0, 0
        if size:
            yield heavy()

    counted = arrow_map(rows, local, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    often = counted.where(F.col("n") >= max(6, total / HEAVY_SHARE / 2)).toArrow()
    shingles, counts = often.column("shingle").to_numpy().view(np.uint64), often.column("n").to_numpy()
    return shingles[np.lexsort((shingles, counts))]


def sketches_of(shingles: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    """The sketch and the wide sketch of every set.

    A shingle flips one bit of a sketch, so two sets whose sketches differ in k bits differ in k shingles at least. The
    sketch has SKETCH_WORDS x 64 bits; the wide one doubles until it has a bit per shingle, and its halves, added up, are
    the sketch of half the width.
    """
    width = SKETCH_WORDS * 64
    bits = width << np.ceil(np.log2(np.maximum(sizes / width, 1))).astype(np.int64)
    ends = np.cumsum(bits)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = ((shingles >> np.uint64(20)) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    counts = np.bincount((ends - bits)[owner] + at, minlength=int(bits.sum()))
    flat = np.packbits((counts & 1).astype(np.uint8))
    narrow = np.bitwise_xor.reduceat(flat.reshape(-1, width // 8), (ends - bits) // width, axis=0) if len(sizes) else flat
    data, rows = flat.tobytes(), [row.tobytes() for row in narrow]
    return [pa.array(rows, pa.binary()), pa.array([data[(e - b) // 8 : e // 8] for b, e in zip(bits, ends, strict=True)], pa.binary())]


def set_rows(rows: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit print and both sketches of every row's set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                shingles, sizes = _sets_of(part)
                edges = np.concatenate([[0], np.cumsum(sizes)])
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles + _ODD[2]))])
                sums2 = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ _ODD[3]))])
                columns = [part.column("doc_id"), pa.array(sizes.astype(np.int64))]
                columns += [_signed(s[edges[1:]] - s[edges[:-1]]) for s in (sums, sums2)]
                columns += sketches_of(shingles, sizes)
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "print1", "print2", "sketch", "wide"])

    return arrow_map(rows, work, "doc_id long, n_shingles long, print1 long, print2 long, sketch binary, wide binary")


def postings(rows: DataFrame, heavy: np.ndarray) -> DataFrame:
    """The indexed shingles of every class: shingle, doc_id, n, place; rows need text and doc_id."""
    shared = rows.sparkSession.sparkContext.broadcast(heavy)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(shared.value)
        keys = shared.value[order]
        for batch in batches:
            for part in slices(batch, "text"):
                shingles, sizes = _sets_of(part)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                rank = np.zeros(len(shingles), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
                    rank = np.where(keys[at] == shingles, order[at] + 1, 0)
                moved = np.lexsort((rank, owner))  # stable: equal ranks stay in order of their hash
                place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                first = place < (sizes - needed(sizes) + 1)[owner]
                shingle, who = shingles[moved][first], owner[first]
                ids = part.column("doc_id").take(pa.array(who))
                columns = [_signed(shingle), ids, pa.array(sizes[who].astype(np.int32)), pa.array(place[first].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "doc_id", "n", "place"])

    return arrow_map(rows, work, "shingle long, doc_id long, n int, place int")


def _can_link(n: np.ndarray, tail: np.ndarray, sketch: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs size, place and sketch leave open."""
    least = overlap_needed(n[x], n[y])
    fits = (np.minimum(n[x], n[y]) >= needed(np.maximum(n[x], n[y]))) & (np.minimum(tail[x], tail[y]) >= least)
    at = np.flatnonzero(fits)
    apart = np.bitwise_count(sketch[x[at]] ^ sketch[y[at]]).sum(axis=1, dtype=np.int64)
    fits[at] = apart <= (n[x] + n[y] - 2 * least)[at]
    return fits


def leader_pairs(shingle: np.ndarray, doc: np.ndarray, n: np.ndarray, place: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per list, every set with the first set (by id) that it can link with and that has no such set before it.

    One pair per row at most: what a set's likely twin links with is not asked again.
    """
    order = np.lexsort((doc, shingle))
    shingle, doc, n, place, sketch = shingle[order], doc[order], n[order].astype(np.int64), place[order].astype(np.int64), sketch[order]
    tail, left = n - place, np.arange(len(shingle))
    firsts, seconds = [], []
    while len(left):
        keys = shingle[left]
        begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        leader = np.repeat(left[begin], np.diff(np.r_[begin, len(left)]))
        other = left != leader
        x, y = left[other], leader[other]
        same = doc[x] == doc[y]
        fits = _can_link(n, tail, sketch, x, y) & ~same
        firsts.append(doc[y[fits]])
        seconds.append(doc[x[fits]])
        left = x[~fits & ~same]
    return (np.concatenate(firsts), np.concatenate(seconds)) if firsts else (np.zeros(0, np.int64),) * 2


def list_pairs(
    shingle: np.ndarray, doc: np.ndarray, n: np.ndarray, place: np.ndarray, sketch: np.ndarray, component: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of whole lists between different components.

    A list is sorted by component and size; a set looks at the sets of components before its own, in blocks, and a
    block whose largest possible overlap is too small is skipped as a whole.
    """
    order = np.lexsort((doc, n, component, shingle))
    shingle, doc, n, place = shingle[order], doc[order], n[order].astype(np.int64), place[order].astype(np.int64)
    sketch, component, rows = sketch[order], component[order], np.arange(len(shingle))
    new_list = np.r_[True, shingle[1:] != shingle[:-1]]
    new_part = new_list | np.r_[True, component[1:] != component[:-1]]
    low = np.maximum.accumulate(np.where(new_list, rows, 0))
    high = np.maximum.accumulate(np.where(new_part, rows, 0))
    tail = n - place  # shingles from here on: what two sets can have in common at most
    edges = np.arange(-(-len(rows) // BLOCK)) * BLOCK
    best_tail, least_size = np.maximum.reduceat(tail, edges), np.minimum.reduceat(n, edges)
    lefts, rights = [], []
    probe = rows[low < high]
    block = low[probe] // BLOCK
    while len(probe):
        use = np.minimum(tail[probe], best_tail[block]) >= overlap_needed(n[probe], np.maximum(least_size[block], needed(n[probe])))
        p, b = probe[use], block[use]
        for k in range(BLOCK):
            other = b * BLOCK + k
            fits = (other >= low[p]) & (other < high[p])
            x, y = p[fits], other[fits]
            fits = _can_link(n, tail, sketch, x, y) & (doc[x] != doc[y])
            lefts.append(np.minimum(doc[x], doc[y])[fits])
            rights.append(np.maximum(doc[x], doc[y])[fits])
        block = block + 1
        going = block * BLOCK < high[probe]
        probe, block = probe[going], block[going]
    return (np.concatenate(lefts), np.concatenate(rights)) if lefts else (np.zeros(0, np.int64),) * 2


def _by_list(rows: DataFrame, work: Callable[[list[pa.Array]], pa.RecordBatch], names: list[str], schema: str) -> DataFrame:
    """Apply ``work`` to whole lists: rows of one shingle come together, in one batch or over several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            here = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            keys = here.column("shingle").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last list may go on in the next batch
            if cut:
                yield work(here.slice(0, cut).combine_chunks())
            rest = here.slice(cut)
        if rest is not None and len(rest):
            yield work(rest.combine_chunks())

    return arrow_map(rows.select(*names).repartition("shingle").sortWithinPartitions("shingle"), run, schema)


def shared(indexed: DataFrame) -> DataFrame:
    """The postings of shingles that more than one set is indexed by."""
    names = ["shingle", "doc_id", "n", "place"]

    def work(rows: pa.Table) -> pa.RecordBatch:
        keys = rows.column("shingle").to_numpy()
        edge = keys[1:] != keys[:-1]
        several = pa.array(~(np.r_[True, edge] & np.r_[edge, True]))
        return pa.RecordBatch.from_arrays([rows.column(c).combine_chunks().filter(several) for c in names], names)

    return _by_list(indexed, work, names, "shingle long, doc_id long, n int, place int")


def candidates(lists: DataFrame, sketches: DataFrame, components_: DataFrame | None = None) -> DataFrame:
    """Distinct pairs (a < b) out of the lists: with leaders first; then, given components, what lies between them."""
    between = components_ is not None

    def work(rows: pa.Table) -> pa.RecordBatch:
        columns = [rows.column(c).to_numpy() for c in ("shingle", "doc_id", "n", "place")]
        bits = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(-1, SKETCH_WORDS)
        if between:
            a, b = list_pairs(*columns, bits, rows.column("component").to_numpy())
        else:
            a, b = leader_pairs(*columns, bits)
        if len(a):
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            a, b = a[fresh], b[fresh]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    names = ["shingle", "doc_id", "n", "place", "sketch"]
    rows = lists.join(sketches, "doc_id")
    if between:
        rows = rows.join(components_.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        names.append("component")
    return _by_list(rows, work, names, "a long, b long").distinct()


def apart(x: bytes, y: bytes) -> int:
    """In how many bits two wide sketches differ; the wider one is folded first."""
    small, large = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    return int(np.bitwise_count(small ^ np.bitwise_xor.reduce(large.reshape(-1, len(small)), axis=0)).sum())


def among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows that a later join on doc_id with ``ids`` can keep: sifted where they lie if the ids are few enough to be
    broadcast, else all of them, and the join does it."""
    ids = stage(ids.distinct(), "set-ids")
    return rows.join(F.broadcast(ids), "doc_id", "left_semi") if ids.count() <= BROADCAST_IDS else rows


def plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that the wide sketches leave open: a short sketch says nothing of long sets, whose texts are large."""
    pairs = stage(pairs, "set-candidates")
    side = among(sets.select("doc_id", "n_shingles", "wide"), pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    met = pairs.join(side.toDF("a", "n_a", "wide_a"), "a").join(side.toDF("b", "n_b", "wide_b"), "b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            most = n_a + n_b - 2 * overlap_needed(n_a, n_b)
            wide = zip(batch.column("wide_a").to_pylist(), batch.column("wide_b").to_pylist(), strict=True)
            fits = pa.array([apart(x, y) <= m for (x, y), m in zip(wide, most.tolist(), strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(fits)

    # rows with equal id and text have one sketch and would repeat the pair
    return arrow_map(met.select("a", "b", "n_a", "n_b", "wide_a", "wide_b"), work, "a long, b long").distinct()


def meetings(pairs: DataFrame) -> DataFrame:
    """Where sets meet to be compared: hub, part, other, doc_id and the partners of the document there.

    A pair meets at the smallest id near its first document, found by passing the smallest neighbour on twice, so
    a family of similar sets has one hub. The sets of a large hub are dealt to blocks by hash, and each pair of
    blocks meets on its own: a set travels once per block it has partners in, not once per partner.
    """
    both = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).union(pairs.select(F.col("b").alias("x"), F.col("a").alias("y")))
    label = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("hub"))
    near = both.join(label.select(F.col("x").alias("y"), "hub"), "y").groupBy("x").agg(F.min("hub").alias("m"))
    label = stage(label.join(near, "x").select(F.col("x").alias("a"), F.least("hub", "m").alias("hub")), "set-hubs")
    placed = pairs.join(label, "a")
    sides = placed.select("hub", F.col("a").alias("doc_id")).union(placed.select("hub", F.col("b").alias("doc_id"))).distinct()
    sizes = sides.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / MEETING_SETS).alias("blocks"))
    found = placed.join(sizes, "hub").select(
        "hub", "a", "b", *[F.pmod(F.xxhash64(c), F.col("blocks")).cast("int").alias(f"block_{c}") for c in ("a", "b")]
    )
    part, other = F.least("block_a", "block_b").alias("part"), F.greatest("block_a", "block_b").alias("other")
    found = stage(found.select("hub", part, other, "a", "b"), "set-meetings")
    first = found.select("hub", "part", "other", F.col("a").alias("doc_id"), F.col("b").alias("partner"))
    second = found.select("hub", "part", "other", F.col("b").alias("doc_id"), F.lit(None).cast("long").alias("partner"))
    return first.union(second).groupBy("hub", "part", "other", "doc_id").agg(F.collect_set("partner").alias("partners"))


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs that link, with their overlap: a, b, overlap."""
    met = meetings(pairs)
    rows = among(rows, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    key = ["hub", "part", "other"]
    # the texts travel compressed, which is a third of their sets, and become sets where they meet
    dealt = packed(rows, ["doc_id"]).join(met, "doc_id").repartition(*key).sortWithinPartitions(*key)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        here, held = None, []
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            columns = [batch.column(c).to_pylist() for c in (*key, "doc_id", "partners", "packed")]
            for *place, doc, partners, blob in zip(*columns, strict=True):
                if place != here:
                    out += links(held)
                    here, held = place, []
                data = np.frombuffer(unpack(blob), np.uint8)
                held.append((doc, partners, shingle_sets(data, np.array([0, len(data)]))[0]))
            yield answer(out)
        yield answer(links(held))

    def links(held: list[tuple[int, list[int], np.ndarray]]) -> list[tuple[int, int, int]]:
        known = {doc: own for doc, _, own in held}
        out = []
        for doc, partners, own in held:
            for partner in partners:
                other = known[partner]
                at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                both = int((own[at] == other).sum())
                if 100 * both >= SHARE * (len(own) + len(other) - both):
                    out.append((doc, partner, both))
        return out

    def answer(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], ["a", "b", "overlap"])

    return arrow_map(dealt.select(*key, "doc_id", "partners", "packed"), compare, "a long, b long, overlap long")


def join(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, links): rows has doc_id, n_shingles and rep_id; links has a, b and overlap of linked representatives.

    Rows with equal sets have one representative, the smallest id among them. The links are verified and connect
    all that links of the whole connect; a link between sets that others connect already may be left out, so that a
    family of n similar sets does not give n^2 of them. Rows without words have an empty set, are their own
    representative and link with nothing. A null id cannot be linked and is left out, and an id must stand for one text:
    ``keyed`` makes such keys for any table.
    """
    rows = df.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    sets = stage(set_rows(rows), "sets")
    classes = sets.where("n_shingles > 0").groupBy("print1", "print2", "n_shingles").agg(F.min("doc_id").alias("rep_id"))
    classes = stage(classes, "set-classes")
    members = sets.join(classes, ["print1", "print2", "n_shingles"], "left").select("doc_id", "n_shingles", F.coalesce("rep_id", "doc_id").alias("rep_id"))
    heavy = heavy_hitters(rows, sets.count())
    reps = classes.select(F.col("rep_id").alias("doc_id")).distinct()
    sketches = sets.select("doc_id", "sketch").join(reps, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    # copies are indexed with their class and taken out of the short lists, which spares an exchange of all texts
    lists = stage(shared(shared(postings(rows, heavy)).join(reps, "doc_id", "left_semi")), "set-lists")
    near = stage(verified(stage(plausible(candidates(lists, sketches), sets), "set-pairs"), rows), "set-links")
    between = stage(plausible(candidates(lists, sketches, connected(near.select("a", "b"))), sets), "set-pairs")
    return members, near.union(verified(between, rows))


def components(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id: the smallest id that links reach. Rows without id: ``all_components``."""
    members, links = join(df, id_col, text)
    labels = connected(stage(links.select("a", "b"), "set-links"))
    found = members.join(labels.select(F.col("id").alias("rep_id"), "component"), "rep_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "rep_id").alias("component_id"))


def _odd(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Ids that rows with different texts share."""
    own = F.col(f"`{id_col}`").cast("long").alias("_odd_id")
    again = stage(df.where(F.col(f"`{id_col}`").isNotNull()).groupBy(own).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_odd_id"), "again-ids")
    if again.isEmpty():
        return again
    print_ = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    prints = df.select(own, print_.alias("print")).join(again, "_odd_id", "left_semi").groupBy("_odd_id")
    return prints.agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high").select("_odd_id")


def keyed(df: DataFrame, id_col: str = "doc_id", text: str = "text", key: str = "_key_of_row") -> DataFrame:
    """The rows and a key: the id; for rows without one, and for rows that share theirs with other texts, a hash of id and
    text that is no row's id. Rows with equal id and text have one key."""
    own, blank = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    shared_ids = stage(_odd(df, id_col, text), "odd-ids")
    if not df.where(own.isNull()).limit(1).count() and shared_ids.isEmpty():
        return df.withColumn(key, own)
    marked = df.join(shared_ids, own == F.col("_odd_id"), "left")
    odd = own.isNull() | F.col("_odd_id").isNotNull()
    salt = 0
    while marked.where(odd).select(F.xxhash64(own, blank, F.lit(salt)).alias(key)).join(marked.where(~odd).select(own.alias(key)), key, "left_semi").limit(1).count():
        salt += 1
    return marked.withColumn(key, F.when(odd, F.xxhash64(own, blank, F.lit(salt))).otherwise(own)).drop("_odd_id")


def all_components(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``components`` of every row, whatever its id: key, doc_id, n_shingles and component_id.

    The key is that of ``keyed``. Each row is a document of its own, also where rows with different texts share an id: the
    component of each is the smallest id that links of its own text reach. Where no row of a component has an id, it is the
    smallest key in it, which is no row's id.
    """
    return keyed_components(keyed(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text")))).drop("group")


def keyed_components(rows: DataFrame) -> DataFrame:
    """``all_components`` of rows that ``keyed`` has given keys (doc_id, text and _key_of_row), and ``group``, the smallest
    key in the component: components of rows that share an id may have the same component_id, but not the same group."""
    found = components(rows, "_key_of_row")
    differs = F.col("doc_id").isNull() | (F.col("doc_id") != F.col("_key_of_row"))
    odd = stage(rows.where(differs).select(F.col("_key_of_row").alias("key"), F.col("doc_id").cast("long").alias("own"), F.lit(True).alias("odd")).distinct(), "odd-keys")
    if odd.isEmpty():
        return found.select(F.col("doc_id").alias("key"), "doc_id", "n_shingles", "component_id", F.col("component_id").alias("group"))
    found = stage(found.withColumnsRenamed({"doc_id": "key", "component_id": "group"}), "set-components")
    known = found.join(odd, "key", "left").select("key", F.when(F.col("odd"), F.col("own")).otherwise(F.col("key")).alias("doc_id"), "n_shingles", "group")
    least = known.groupBy("group").agg(F.min("doc_id").alias("least"))
    return known.join(least, "group").select("key", "doc_id", "n_shingles", F.coalesce("least", "group").alias("component_id"), "group")
