"""Cross-tokenizer alignment: the tokens of two vocabularies over the same bytes, and how often they meet.

Both tokenizations of a text are lists of byte ends. The shorter list drives a galloping search into the longer: from a
guess that follows the lengths of both lists, steps double until they enclose the place, which a binary search then finds.
Ends in both lists cut the tokens into groups; the differences of successive ranks are the ranges of tokens that overlap.
All texts of a slice are searched together, their ends laid behind each other.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.llm import blocks
from railloom.llm.batches import flat_bytes, int_lists, map_texts, ragged, texts_from
from railloom.llm.bpe import Merges, WordTable
from railloom.operators.staging import stage

MADE = {
    "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_best": "long", "count_sum": "long",
    "groups_sha256": "string",
}
#: Fixed value: how this kind of vocabulary writes a space.
SPACE = "▁"


class _Bytes:
    """The bytes of every id, back to back."""

    def __init__(self, content: list[bytes]):
        self.lengths = np.array([len(b) for b in content], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(content), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts[ids], self.lengths[ids])]


class ByteLevel:
    """A byte-level BPE file; special tokens written in a text are text."""

    def __init__(self, path: str):
        merges = Merges(path)
        merges.cut = None
        self.words = WordTable(merges)
        ids = np.arange(len(merges.lengths))
        self.bytes = _Bytes([merges.bytes[merges.starts[i] : merges.starts[i] + merges.lengths[i]].tobytes() for i in ids])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.words.encode(texts)
        return ids.astype(np.int64), counts


class Pieces:
    """A sentencepiece model whose pieces spell bytes that it lacks as <0xHH>."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = _Bytes([self._content(i) for i in range(self.model.get_piece_size())])

    def _content(self, i: int) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(self.model.id_to_piece(i)[3:-1], 16)])
        return self.model.id_to_piece(i).replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts back to back and how many each text has."""
        found = self.model.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts


@lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def gallop(short: np.ndarray, long: np.ndarray, guess: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For every value of ``short`` the first place in ``long``, from ``low`` up to ``high``, that is not below it.

    ``guess`` is where to begin, within the same bounds. Steps double away from it until they enclose the place.
    """
    left, right = guess.copy(), guess.copy()
    inside = guess < high
    below = np.zeros(len(short), bool)
    below[inside] = long[guess[inside]] < short[inside]
    step, going = 1, np.flatnonzero(below)
    while len(going):  # the place lies above
        left[going] = right[going] + 1
        right[going] = np.minimum(right[going] + step, high[going])
        going = going[(right[going] < high[going])]
        going = going[long[right[going]] < short[going]]
        step *= 2
    step, going = 1, np.flatnonzero(~below & (guess > low))
    while len(going):  # or below
        before = np.maximum(left[going] - step, low[going])
        smaller = long[before] < short[going]
        right[going[~smaller]] = before[~smaller]
        left[going] = np.where(smaller, before + 1, before)
        going = going[~smaller & (before > low[going])]
        step *= 2
    going = np.flatnonzero(left < right)
    while len(going):
        middle = (left[going] + right[going]) // 2
        smaller = long[middle] < short[going]
        left[going[smaller]] = middle[smaller] + 1
        right[going[~smaller]] = middle[~smaller]
        going = going[left[going] < right[going]]
    return left


class Slice:
    """Tokens of both sides of some texts, as flat ids, tokens per text and global byte ends."""

    def __init__(self, ids: list[np.ndarray], counts: list[np.ndarray], contents: list[_Bytes]):
        self.ids, self.counts = ids, counts
        sizes = [c.lengths[i] for c, i in zip(contents, ids, strict=True)]
        self.ends = [np.cumsum(s) for s in sizes]
        self.firsts = [np.cumsum(c) - c for c in counts]

    def aligned(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Links as (text, position in A, position in B), and of both sides whether a group ends with the token."""
        closes = [np.zeros(len(i), bool) for i in self.ids]
        links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        a_drives = self.counts[0] <= self.counts[1]
        for drive, texts in ((0, np.flatnonzero(a_drives)), (1, np.flatnonzero(~a_drives))):
            other = 1 - drive
            n, m = self.counts[drive][texts], self.counts[other][texts]
            token, text = ragged(self.firsts[drive][texts], n), np.repeat(np.arange(len(texts)), n)
            low = self.firsts[other][texts][text]
            high = low + m[text]
            rank = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n)
            guess = low + rank * m[text] // np.maximum(n[text], 1)
            place = gallop(self.ends[drive][token], self.ends[other], guess, low, high)
            common = self.ends[other][place] == self.ends[drive][token]  # the last ends of a text are equal
            closes[drive][token] = common
            closes[other][place[common]] = True
            begin = np.empty_like(place)
            begin[1:] = place[:-1] + common[:-1]
            begin[rank == 0] = low[rank == 0]
            width = place - begin + 1
            mine, theirs = np.repeat(token, width), ragged(begin, width)
            links.append((np.repeat(texts[text], width), *((mine, theirs) if drive == 0 else (theirs, mine))))
        text, a, b = (np.concatenate(parts) for parts in zip(*links, strict=True))
        return text, a, b, closes

    def spelled(self, closes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of every text, as flat bytes and lengths."""
        groups = [np.cumsum(c) - c for c in closes]  # number of each token's group, as both sides have the same groups
        order = np.argsort(np.concatenate([2 * groups[0], 2 * groups[1] + 1]), kind="stable")
        ids = np.concatenate(self.ids)[order]
        ends = np.concatenate([np.where(closes[0], ord("|"), ord(",")), np.where(closes[1], ord(";"), ord(","))])[order]
        digits, starts, lengths = _decimals(max(int(i.max()) for i in self.ids) if len(ids) else 0)
        sizes = lengths[ids] + 1
        out = digits[ragged(starts[ids], sizes)].copy()
        out[np.cumsum(sizes) - 1] = ends
        owner = np.concatenate([np.repeat(np.arange(len(c)), c) for c in self.counts])[order]
        per_text = np.bincount(owner, weights=sizes, minlength=len(self.counts[0])).astype(np.int64)
        keep = np.ones(len(out), bool)
        keep[np.cumsum(per_text)[per_text > 0] - 1] = False  # no mark behind the last group
        return out[keep], per_text - (per_text > 0)


_written: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _decimals(top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal digits of 0 to ``top`` with a blank behind each, where they begin, and how many there are."""
    top = max(1 << 17, 1 << top.bit_length())
    if top not in _written:
        digits = [str(n).encode() + b" " for n in range(top)]
        lengths = np.array([len(d) - 1 for d in digits], np.int64)
        _written[top] = np.frombuffer(b"".join(digits), np.uint8), np.cumsum(lengths + 1) - lengths - 1, lengths
    return _written[top]


def tokens_of(texts: list[str], a: ByteLevel, b: Pieces) -> Slice:
    """Tokens of both sides; none where either side's bytes are not a space and the text."""
    spaced = [" " + t for t in texts]
    data, edges = flat_bytes(pa.array(spaced, pa.large_string()))
    sides = []
    sound = np.array([bool(t) for t in texts], bool)
    for coder, given in ((a, spaced), (b, texts)):
        ids, counts = coder.encode(given)
        sizes = np.bincount(np.repeat(np.arange(len(counts)), counts), weights=coder.bytes.lengths[ids], minlength=len(counts)).astype(np.int64)
        same = sizes == np.diff(edges)
        sound &= same
        rows = np.flatnonzero(sound)
        joined = coder.bytes.joined(ids[np.repeat(sound, counts)])
        wanted = data[ragged(edges[:-1][rows], sizes[rows])]
        wrong = np.bincount(np.repeat(rows, sizes[rows]), weights=joined != wanted, minlength=len(texts))
        sound &= wrong == 0
        sides.append((ids, counts))
    ids = [i[np.repeat(sound, c)] for i, c in sides]
    return Slice(ids, [np.where(sound, c, 0) for _, c in sides], [a.bytes, b.bytes])


class _Pairs:
    """Of a block's documents: counts, group strings, and which id pairs they link how often."""

    def __init__(self, vocabularies: tuple[str, str]):
        self.a, self.b = byte_level(vocabularies[0]), pieces(vocabularies[1])
        self.numbers: list[np.ndarray] = []
        self.digests: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, texts: list[str], more: list[pa.Array]) -> None:
        found = tokens_of(texts, self.a, self.b)
        text, a, b, closes = found.aligned()
        n_groups = np.bincount(np.repeat(np.arange(len(texts)), found.counts[0]), weights=closes[0], minlength=len(texts))
        spelled, lengths = found.spelled(closes)
        ends, raw = np.cumsum(lengths), memoryview(spelled)
        self.digests += [hashlib.sha256(raw[e - n : e]).hexdigest() if n else "" for n, e in zip(lengths, ends, strict=True)]
        n_b = len(self.b.bytes.lengths)
        codes = (text * len(self.a.bytes.lengths) + found.ids[0][a]) * n_b + found.ids[1][b]
        distinct, times = np.unique(codes, return_counts=True)
        per_text = len(self.a.bytes.lengths) * n_b
        self.pairs.append(distinct % per_text)
        self.times.append(times)
        n_pairs = np.bincount(distinct // per_text, minlength=len(texts))
        self.numbers.append(np.stack([found.counts[0], found.counts[1], n_groups.astype(np.int64), np.bincount(text, minlength=len(texts)), n_pairs]))

    def close(self) -> list:
        none = np.zeros(0, np.int64)
        keys, at, documents = np.unique(np.concatenate([*self.pairs, none]), return_inverse=True, return_counts=True)
        numbers = np.concatenate(self.numbers, axis=1)
        n_b = len(self.b.bytes.lengths)
        packed = keys // n_b << 32 | keys % n_b
        blob = blocks.press(*numbers, at, np.concatenate([*self.times, none]))
        return [pa.array([blob], pa.binary()), pa.array([self.digests], pa.list_(pa.string())), int_lists(packed, np.array([len(packed)]), pa.int64()), int_lists(documents, np.array([len(packed)]), pa.int64())]


def _sums(block: dict) -> list[pa.Array]:
    (n_a, n_b, n_groups, n_links, n_pairs, at, times), _ = blocks.unpress(block["payload"][0].as_py())
    count, best = blocks.aligned(block["found"], int(at.max()) + 1 if len(at) else 0, {"count": np.int64, "best": bool})
    document = np.repeat(np.arange(len(n_a)), n_pairs)
    out = [n_a, n_b, n_groups, n_links, *[_exact(document, times * values[at].astype(np.int64), len(n_a)) for values in (best, count)]]
    return [*[pa.array(v.astype(np.int64)) for v in out], block["digests"].flatten()]


def _exact(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of integers per owner; owners come in order."""
    ends = np.searchsorted(owner, np.arange(n + 1))
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return total[ends[1:]] - total[ends[:-1]]


def pair_counts(made: DataFrame) -> DataFrame:
    """``key`` (A id in the upper, B id in the lower half), ``count`` (documents that hold the pair linked) and ``best``."""
    each = made.select(F.explode(F.arrays_zip("keys", "documents")).alias("k")).select(F.col("k.keys").alias("key"), F.col("k.documents").alias("documents"))
    counts = stage(each.groupBy("key").agg(F.sum("documents").alias("count")), "pairs")
    a = F.shiftright("key", 32).alias("a")
    top = counts.groupBy(a).agg(F.max("count").alias("top"))
    return counts.withColumn("a", a).join(top, "a").select("key", "count", (F.col("count") == F.col("top")).alias("best"))


def align(df: DataFrame, a: str, b: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` plus counts of tokens, groups and links, ``n_best``, ``count_sum`` and ``groups_sha256``, the digest of what
    ``groups`` returns.

    ``a`` is the path of a byte-level BPE file, ``b`` of a sentencepiece model; workers can read both. A links to every
    token of B whose bytes overlap. An id pair's count is the number of documents (rows) that hold it linked; a link is best
    if no other pair of its A id has a higher count. Null and empty texts, and texts that a tokenizer changes, have zeros and
    an empty string. Rows that repeat an id count as documents of their own. A kept column with a made one's name is replaced.
    """
    columns = "payload binary, digests array<string>, keys array<bigint>, documents array<bigint>"
    made = blocks.build(df, text, list(keep), list(MADE), [], columns, lambda: _Pairs((a, b)), block_bytes=8 << 20)
    return blocks.resolve(blocks.with_values(made.drop("documents"), pair_counts(made)), MADE, _sums)


def groups(df: DataFrame, a: str, b: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` plus ``groups``: ids of both sides between common ends, as `a1,a2|b1;a3|b2,b3`; odd texts as in align."""

    def work(texts: pa.Array) -> list[pa.Array]:
        found = tokens_of(texts.to_pylist(), byte_level(a), pieces(b))
        return [texts_from(*found.spelled(found.aligned()[3]))]

    return map_texts(df, text, list(keep), {"groups": "string"}, work)
