"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

The pre-tokenizer pattern splits the texts of a slice into words. The symbols of all words that are new to the
task lie in one flat array. Every round finds the lowest-ranked pair of each unfinished word (ranks come from a
binary search over the sorted pair keys) and merges all its occurrences, left first. Finished words stay in a
bounded table of the task, so a frequent word is merged once and then copied.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from railloom.llm.batches import int_lists, map_texts, ragged, texts_from

#: The pattern and the special token of the public byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NO_RANK = np.int32(2**31 - 1)
TABLE_WORDS = 300_000


def byte_symbols() -> dict[str, int]:
    """Printable stand-in character of each byte, as byte-level vocabularies write them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


#: What a vocabulary file says of the rules that this module follows.
MODEL_RULES = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}
BYTE_RULES = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}}
TOKEN_RULES = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}


def require(path: str, found: object, wanted: object, at: str = "") -> None:
    """Raises ValueError where a vocabulary file asks for other rules than ``wanted``; keys not wanted may be anything,
    one that the file lacks counts as null or false."""
    if isinstance(wanted, dict) and isinstance(found, dict):
        for key, value in wanted.items():
            require(path, found.get(key, False if value is False else None), value, f"{at}/{key}")
    elif isinstance(wanted, list) and isinstance(found, list) and len(wanted) == len(found):
        for n, value in enumerate(wanted):
            require(path, found[n], value, f"{at}/{n}")
    elif found != wanted:
        raise ValueError(f"{path}: {at} is {found!r}, only {wanted!r} is supported")


def vocabulary_of(path: str, rules: dict, suffix: str | None) -> dict:
    """The vocabulary file, if its rules are those that the caller follows."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    require(path, spec, {"model": MODEL_RULES | {"end_of_word_suffix": suffix}} | rules)
    for token in spec["added_tokens"]:
        require(path, token, TOKEN_RULES, "/added_tokens")
    return spec


class Merges:
    """Sorted pair keys with rank and result, and the bytes of every id. Files with other rules raise ValueError."""

    def __init__(self, path: str):
        spec = vocabulary_of(path, BYTE_RULES, None)
        vocab: dict[str, int] = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = np.arange(len(pairs), dtype=np.int32)[order]
        self.into = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        symbols = byte_symbols()
        self.of_byte = np.zeros(256, np.int64)
        for char, byte in symbols.items():
            self.of_byte[byte] = vocab[char]
        content = {i: bytes(symbols[c] for c in t) for t, i in vocab.items()}
        content |= {i: t.encode() for t, i in self.special.items()}
        blobs = [content.get(i, b"") for i in range(max(content) + 1)]
        self.lengths = np.array([len(b) for b in blobs], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(blobs), np.uint8)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], NO_RANK), self.into[at]

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and how many each word has; ``data`` holds the words' bytes back to back."""
        symbol, word = self.of_byte[data], np.repeat(np.arange(len(lengths)), lengths)
        rank, into = np.full(len(symbol), NO_RANK), np.zeros(len(symbol), np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], into[inner] = self.look_up(symbol[inner], symbol[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(word)])
            best = np.minimum.reduceat(rank, starts)
            if (best == NO_RANK).any():
                going = np.repeat(best != NO_RANK, sizes)
                done.append((word[~going], symbol[~going]))
                symbol, word, rank, into = symbol[going], word[going], rank[going], into[going]
                sizes, best = sizes[best != NO_RANK], best[best != NO_RANK]
                if not len(symbol):
                    break
            hit = rank == np.repeat(best, sizes)
            at = np.flatnonzero(hit)
            # of overlapping occurrences (a a a) every second one is free: the distance to the start of its run is even
            first = np.r_[True, at[1:] != at[:-1] + 1]
            run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbol[at] = into[at]
            stays = np.ones(len(symbol), bool)
            stays[at + 1] = False
            place = np.cumsum(stays) - 1
            symbol, word, rank, into = symbol[stays], word[stays], rank[stays], into[stays]
            touched = np.zeros(len(symbol), bool)
            touched[place[at]] = True
            touched[:-1] |= touched[1:]
            changed = np.flatnonzero(touched)
            rank[changed] = NO_RANK
            changed = changed[changed + 1 < len(word)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed], into[changed] = self.look_up(symbol[changed], symbol[changed + 1])
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
        owner = np.concatenate([w for w, _ in done])
        ids = np.concatenate([s for _, s in done])
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lengths))

    def decode(self, ids: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Valid UTF-8 bytes of all rows and their lengths; broken sequences become U+FFFD."""
        ids = ids.astype(np.int64)
        sizes = self.lengths[ids]
        data = self.bytes[ragged(self.starts[ids], sizes)]
        row = np.repeat(np.arange(len(per_row)), per_row)
        lengths = np.bincount(row, weights=sizes, minlength=len(per_row)).astype(np.int64)
        raw = data.tobytes()
        ends = np.cumsum(lengths)
        parts = [raw[e - n : e].decode("utf-8", "replace").encode() for n, e in zip(lengths, ends, strict=True)]
        return np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts], np.int64)


class WordTable:
    """Ids of the words met so far, in one flat array; starts anew when it is full."""

    def __init__(self, merges: Merges, limit: int = TABLE_WORDS):
        self.merges, self.limit = merges, limit
        self.words_of = regex.compile(PATTERN).findall
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def learn(self, words: set[str]) -> None:
        """Adds what is new; a full table is emptied first, so one slice of text always fits."""
        if len(self.rows) + len(words) > self.limit:
            self.clear()
        new = list(words.difference(self.rows))
        if not new:
            return
        blobs = [w.encode() for w in new]
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
        ids, counts = self.merges.merge(np.frombuffer(b"".join(blobs), np.uint8), sizes)
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts back to back and how many each text has."""
        special, cut = self.merges.special, self.merges.cut
        words: list[str] = []
        per_text: list[int] = []
        marks: list[tuple[int, int, int]] = []  # words before it, id of the special token, text
        for n, text in enumerate(texts):
            before, at = len(words), 0
            for m in cut.finditer(text) if cut else ():
                words += self.words_of(text, at, m.start())
                marks.append((len(words), special[m.group()], n))
                at = m.end()
            words += self.words_of(text[at:] if at else text)
            per_text.append(len(words) - before)
        self.learn(set(words))
        chosen = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        counts = self.counts[chosen]
        ids = self.ids[ragged(self.starts[chosen], counts)]
        ends = np.r_[0, np.cumsum(counts)]
        edges = np.r_[0, np.cumsum(per_text)].astype(np.int64)
        totals = ends[edges[1:]] - ends[edges[:-1]]
        if marks:
            ids = np.insert(ids, ends[[k for k, _, _ in marks]], [i for _, i, _ in marks])
            totals = totals + np.bincount([n for _, _, n in marks], minlength=len(texts))
        return ids, totals


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def table_of(path: str) -> WordTable:
    return WordTable(merges_of(path))


def encode_decode(df: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` plus ``ids`` (array<int>) and ``decoded`` (the text made from the ids again).

    ``vocabulary`` is the path of a byte-level BPE file that every worker can read. A null or empty text has no ids
    and decodes to the empty text. Special tokens written in a text become their id. Rows are independent: repeated
    rows give repeated results, an empty table gives none. A kept column called ``ids`` or ``decoded`` is replaced.
    """

    def work(texts: pa.Array) -> list[pa.Array]:
        ids, counts = table_of(vocabulary).encode(texts.to_pylist())
        data, lengths = merges_of(vocabulary).decode(ids, counts)
        return [int_lists(ids, counts, pa.int32()), texts_from(data, lengths)]

    return map_texts(df, text, list(keep), {"ids": "array<int>", "decoded": "string"}, work, end=lambda: table_of(vocabulary).clear())
