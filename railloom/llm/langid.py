"""Language identification by cross-parsing against labelled text.

Per language a suffix automaton holds a bounded sample of labelled text. A text is parsed greedily into the longest
phrases that occur in the sample; phrases x log2(sample size) / symbols estimates how many bits a symbol costs in that
language, and the cheapest language wins. The automata are completed into transition tables (a symbol that cannot be
matched ends the phrase and begins the next one), so thousands of blocks of text advance together, one symbol a step.
Symbols are lower-case letters; everything between two letters is one gap. No letter of the sample is lost: those beyond
the SINGLE most frequent are spelled with two symbols each, so scripts of thousands of letters keep the tables narrow.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railloom.llm.batches import map_texts

GAP, OTHER, FIRST_LETTER = 0, 1, 2
#: Letters that are one symbol each; the rest of the sample's letters take two.
SINGLE = 60
#: Most entries of all transition tables together (4 bytes each): the model is broadcast.
MOST_ENTRIES = 1 << 28
BLOCK = 512
UNKNOWN = "und"
#: How fast the score falls with the bits that a symbol costs more than in the best language.
SHARPNESS = 8.0


class SuffixAutomaton:
    """All substrings of a symbol sequence; ``next`` has a dict of transitions per state, state 0 is the root."""

    def __init__(self, symbols: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at != -1 and c not in self.next[at]:
                self.next[at][c] = new
                at = link[at]
            if at != -1:
                to = self.next[at][c]
                if length[to] == length[at] + 1:
                    link[new] = to
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[to]))
                    length.append(length[at] + 1)
                    link.append(link[to])
                    while at != -1 and self.next[at].get(c) == to:
                        self.next[at][c] = copy
                        at = link[at]
                    link[to] = link[new] = copy
            last = new

    def table(self, width: int) -> np.ndarray:
        """Entry [state, symbol]: next state x width x 2, plus 1 where a phrase ends before the symbol.

        A symbol that the sample lacks is a phrase of its own: it leads to an added state after which any symbol
        begins a new phrase. The last symbol stands for the end of a block and changes nothing.
        """
        lost = len(self.next)
        begin = np.full(width, lost * width * 2 + 1, np.int64)
        for c, to in self.next[0].items():
            begin[c] = to * width * 2 + 1
        table = np.tile(begin, (lost + 1, 1))
        table[0, begin == lost * width * 2 + 1] -= 1  # the first phrase of a block is counted already
        state = np.repeat(np.arange(lost), [len(n) for n in self.next])
        symbol = np.fromiter((c for n in self.next for c in n), np.int64, len(state))
        table[state, symbol] = np.fromiter((t for n in self.next for t in n.values()), np.int64, len(state)) * width * 2
        table[:, width - 1] = np.arange(lost + 1) * width * 2
        return table.astype(np.int32)


@dataclass
class Model:
    languages: list[str]
    letters: list[str]  # of one symbol
    table: np.ndarray  # all languages below each other, flat
    roots: np.ndarray  # flat position of each root
    bits: np.ndarray  # of one phrase
    spelled: list[str] = field(default_factory=list)  # letters of two symbols

    @property
    def width(self) -> int:
        return width_of(self.letters, self.spelled)


def digits_of(spelled: list[str]) -> int:
    """Symbols that spell the letters beyond the single ones, two at a time."""
    return math.isqrt(len(spelled) - 1) + 1 if spelled else 0


def width_of(letters: list[str], spelled: list[str]) -> int:
    return len(letters) + digits_of(spelled) + FIRST_LETTER + 1


_classes: dict[tuple[tuple[str, ...], tuple[str, ...]], np.ndarray] = {}


def classes_of(letters: list[str], spelled: list[str]) -> np.ndarray:
    """Symbol of every code point; a spelled letter has the rank it is spelled from, above all symbols."""
    key = tuple(letters), tuple(spelled)
    if key not in _classes:
        kinds = np.zeros(0x110000, np.int32)
        kinds[[n for n in range(0x110000) if not 0xD800 <= n < 0xE000 and chr(n).isalpha()]] = OTHER
        kinds[[ord(c) for c in letters]] = np.arange(FIRST_LETTER, FIRST_LETTER + len(letters))
        kinds[[ord(c) for c in spelled]] = width_of(letters, spelled) + np.arange(len(spelled))
        _classes[key] = kinds
    return _classes[key]


def symbols_of(texts: list[str], letters: list[str], spelled: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts back to back, gaps joined, and how many each text has."""
    spelled = spelled or []
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    found = classes_of(letters, spelled)[points]
    owner = np.repeat(np.arange(len(texts)), sizes)
    stays = np.ones(len(found), bool)
    stays[1:] = (found[1:] != GAP) | (found[:-1] != GAP) | (owner[1:] != owner[:-1])
    found, owner = found[stays], owner[stays]
    width = width_of(letters, spelled)
    if spelled:
        digits, first = digits_of(spelled), FIRST_LETTER + len(letters)
        two = found >= width
        rank = np.where(two, found - width, 0)
        at = np.cumsum(1 + two) - 1 - two
        out = np.empty(len(found) + int(two.sum()), np.int32)
        out[at] = np.where(two, first + rank // digits, found)
        out[at[two] + 1] = first + rank[two] % digits
        found, owner = out, np.repeat(owner, 1 + two)
    return found.astype(np.min_scalar_type(width)), np.bincount(owner, minlength=len(texts))


def fit(samples: dict[str, list[str]], symbols_per_language: int, single: int = SINGLE) -> Model:
    """Automata over equal shares of each language's texts, ``symbols_per_language`` at most.

    Every letter of the samples is told apart: the ``single`` most frequent of all languages together are one symbol,
    the others two. Letters that no sample has are alike, as no language can match them. The tables of all languages
    have MOST_ENTRIES entries at most, else this raises ValueError: fewer symbols per language are needed then.
    """
    languages = sorted(samples)
    seen = Counter(c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha())
    ranked = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))]
    letters, spelled = sorted(ranked[:single]), sorted(ranked[single:])
    width = width_of(letters, spelled)
    tables, bits, entries = [], [], 0
    for language in languages:
        texts = samples[language]
        share = -(-symbols_per_language // max(1, len(texts)))
        flat, counts = symbols_of(texts, letters, spelled)
        ends = np.cumsum(counts)
        sequence = np.concatenate([flat[e - n : e][:share] for n, e in zip(counts, ends, strict=True)] or [np.zeros(0, np.uint8)])
        automaton = SuffixAutomaton(sequence.tolist())
        entries += (len(automaton.next) + 1) * width
        if entries > MOST_ENTRIES:
            raise ValueError(f"{len(languages)} languages of {symbols_per_language} symbols make more than {MOST_ENTRIES} transitions")
        tables.append(automaton.table(width))
        bits.append(math.log2(len(sequence) + 2))
    starts = np.cumsum([0] + [t.size for t in tables])
    flat = [(t + 2 * s).ravel() for t, s in zip(tables, starts[:-1], strict=True)]
    return Model(languages, letters, np.concatenate([*flat, np.zeros(0)]).astype(np.int32), starts[:-1], np.array(bits), spelled)


def phrases(model: Model, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """[text, language]: phrases of each text. Texts are parsed in blocks, a block begins a phrase of its own."""
    blocks = -(-counts // BLOCK)
    total = int(blocks.sum())
    grid = np.full(total * BLOCK, model.width - 1, np.min_scalar_type(model.width))
    first_block = np.cumsum(blocks) - blocks
    begins = np.cumsum(counts) - counts
    grid[np.arange(len(symbols)) + np.repeat(first_block * BLOCK - begins, counts)] = symbols
    columns = np.ascontiguousarray(grid.reshape(total, BLOCK).T)
    state = np.repeat(model.roots.astype(np.int32)[:, None], total, axis=1)
    ended = np.zeros((len(model.languages), total), np.int32)
    for column in columns:
        entry = model.table.take(state + column)
        ended += entry & 1
        state = entry >> 1
    ended += 1
    owner = np.repeat(np.arange(len(counts)), blocks)
    return np.stack([np.bincount(owner, weights=row, minlength=len(counts)) for row in ended], axis=1)


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score (its share among all languages) of every text; ``und`` and 0 without letters."""
    symbols, counts = symbols_of(texts, model.letters, model.spelled)
    owner = np.repeat(np.arange(len(texts)), counts)
    lettered = np.bincount(owner, weights=symbols != GAP, minlength=len(texts)) > 0
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    cost = phrases(model, symbols, counts) * model.bits / np.maximum(counts, 1)[:, None]
    best = np.argmin(cost, axis=1)
    share = 1 / np.exp(-SHARPNESS * (cost - cost.min(axis=1, keepdims=True))).sum(axis=1)
    names = [model.languages[b] if known else UNKNOWN for b, known in zip(best, lettered, strict=True)]
    return names, np.where(lettered, share, 0.0)


def learn(labelled: DataFrame, rows_per_language: int = 64, symbols_per_language: int = 24_000, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on a bounded sample: ``rows_per_language`` rows in the order of a hash of their id, of each row a share of
    ``symbols_per_language`` from the middle of its text. Rows without text or label are not used."""
    share = 2 * -(-symbols_per_language // rows_per_language)
    length = F.char_length(F.col(f"`{text}`"))
    middle = F.substr(F.col(f"`{text}`"), F.greatest(F.lit(1), ((length - share) / 2).cast("int")), F.lit(share))
    rows = labelled.where(F.col(f"`{text}`").isNotNull() & F.col(f"`{lang}`").isNotNull())
    slim = rows.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{id_col}`").alias("id"), middle.alias("text"))
    ranked = slim.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "text")))
    samples: dict[str, list[str]] = {}
    for row in ranked.where(F.col("n") <= rows_per_language).select("lang", "n", "text").collect():
        samples.setdefault(row["lang"], []).append((row["n"], row["text"]))
    return fit({k: [t for _, t in sorted(v)] for k, v in samples.items()}, symbols_per_language)


def identify(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` plus ``lang_pred`` and ``score``, from whole texts.

    Null, empty and letterless texts are ``und`` with score 0, and so is everything if nothing was learned. Equal
    costs go to the first language in order of name. A kept column called ``lang_pred`` or ``score`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # 4 x MOST_ENTRIES bytes at most, see fit()

    def work(texts: pa.Array) -> list[pa.Array]:
        names, scores = predict(shared.value, texts.to_pylist())
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return map_texts(df, text, list(keep), {"lang_pred": "string", "score": "double"}, work)
