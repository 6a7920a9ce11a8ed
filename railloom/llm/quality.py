"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature after the other and fits a shallow tree to the current residuals of that feature's
bins; the trees of a feature add up to one lookup table. The pairs of features that explain most of what is left get
two-dimensional tables in the same way. A text is scored by adding up table entries.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.llm.batches import flat_bytes, map_texts

FEATURES = (
    "log_bytes log_words log_lines word_length longest_word distinct_words distinct_pairs top_word distinct_lines"
    " line_length compressed upper digit blank sentence comma symbol bar bracket wide words_capital words_symbol_end"
    " words_stop_end repeated_letters"
).split()

#: Byte classes, counted per text.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t\r\n\x0b\x0c",
    "sentence": b".!?",
    "comma": b",;:",
    "symbol": b"#$%&*@^~=+_\\`",
    "bar": b"|/-",
    "bracket": b"()[]{}<>",
    "wide": bytes(range(128, 256)),
}
_CLASS_OF = np.zeros(256, np.int64)
for _n, _members in enumerate(_CLASSES.values(), 1):
    _CLASS_OF[list(_members)] = _n


def features(texts: pa.Array) -> np.ndarray:
    """[text, feature] over whole texts."""
    data, ends = flat_bytes(texts)
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    n_classes = len(_CLASSES) + 1
    kinds = _CLASS_OF[data]
    counts = np.bincount(owner * n_classes + kinds, minlength=len(sizes) * n_classes).reshape(-1, n_classes)[:, 1:]
    blank, symbol, stop, upper = (kinds == 1 + list(_CLASSES).index(k) for k in ("blank", "symbol", "sentence", "upper"))
    starts = np.ones(len(data), bool)
    starts[1:] = blank[:-1]
    starts[ends[:-1][sizes > 0]] = True
    last = np.ones(len(data), bool)
    last[:-1] = blank[1:]
    last[ends[1:][sizes > 0] - 1] = True
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & ~blank[1:]

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=mask, minlength=len(sizes))

    capital, symbol_end, stop_end, repeated = per_text(starts & upper), per_text(last & symbol), per_text(last & stop), per_text(same)
    out = np.zeros((len(sizes), len(FEATURES)))
    for n, text in enumerate(texts.to_pylist()):
        words, lines = text.split(), text.split("\n")
        n_words, n_bytes = max(1, len(words)), max(1, int(sizes[n]))
        pairs = set(zip(words, words[1:], strict=False))
        common = max(Counter(words).values(), default=0)
        out[n] = (
            np.log1p(n_bytes),
            np.log1p(len(words)),
            np.log1p(len(lines)),
            sum(map(len, words)) / n_words,
            min(max(map(len, words), default=0), 1000),
            len(set(words)) / n_words,
            len(pairs) / n_words,
            common / n_words,
            len(set(lines)) / len(lines),
            np.log1p(len(text) / len(lines)),
            len(zlib.compress(text.encode(), 1)) / n_bytes,
            *(counts[n] / n_bytes),
            capital[n] / n_words,
            symbol_end[n] / n_words,
            stop_end[n] / n_words,
            repeated[n] / n_bytes,
        )
    return out


@dataclass
class Model:
    base: float
    edges: list[np.ndarray]  # per feature
    tables: list[np.ndarray]  # per feature, by bin
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]  # per feature: coarse bin of each bin
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = bins_of(x, self.edges)
        total = np.full(len(x), self.base)
        for f, values in enumerate(self.tables):
            total += values[bins[:, f]]
        for (a, b), values in zip(self.pairs, self.pair_tables, strict=True):
            total += values[self.coarse[a][bins[:, a]], self.coarse[b][bins[:, b]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def bins_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)


def _gain(g: np.ndarray, h: np.ndarray, smooth: float) -> np.ndarray:
    return g * g / (h + smooth)


def _split(g: np.ndarray, h: np.ndarray, smooth: float) -> int | None:
    """Where to cut a run of bins in two, or None if no cut is better than none."""
    if len(g) < 2:
        return None
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h, smooth) + _gain(g.sum() - left_g, h.sum() - left_h, smooth)
    best = int(np.argmax(gains))
    return best + 1 if gains[best] > _gain(g.sum(), h.sum(), smooth) + 1e-9 else None


def shallow_tree(g: np.ndarray, h: np.ndarray, smooth: float) -> np.ndarray:
    """A tree of depth two over the bins of one feature: the value of every bin."""
    out = np.zeros(len(g))
    cut = _split(g, h, smooth)
    edges = [0, len(g)] if cut is None else [0, cut, len(g)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        inner = _split(g[a:b], h[a:b], smooth)
        for c, d in [(a, b)] if inner is None else [(a, a + inner), (a + inner, b)]:
            out[c:d] = g[c:d].sum() / (h[c:d].sum() + smooth)
    return out


def quadrants(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, np.ndarray]:
    """The best cut of both features at once: its gain and the value of every cell."""
    sum_g, sum_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def corners(s: np.ndarray) -> list[np.ndarray]:
        low, row, column, all_ = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1], s[-1, -1]
        return [low, row - low, column - low, all_ - row - column + low]

    parts = list(zip(corners(sum_g), corners(sum_h), strict=True))
    gains = sum(_gain(a, b, smooth) for a, b in parts)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    value = [a[i, j] / (b[i, j] + smooth) for a, b in parts]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return float(gains[i, j] - _gain(sum_g[-1, -1], sum_h[-1, -1], smooth)), out


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 48, coarse: int = 8, rounds: int = 120, pair_rounds: int = 60, n_pairs: int = 12, rate: float = 0.1, smooth: float = 2.0
) -> Model:
    """Without rows of both classes the score is the same for every text: the share of class 1, or one half."""
    n_features = x.shape[1]
    rate_1 = float(y.mean()) if len(y) else 0.5
    base = float(np.log((rate_1 * len(y) + 0.5) / ((1 - rate_1) * len(y) + 0.5))) if len(y) else 0.0
    if not len(y) or rate_1 in (0.0, 1.0):
        none = [np.zeros(0)] * n_features
        return Model(base, none, [np.zeros(1)] * n_features, [], [np.zeros(1, np.int64)] * n_features, [])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    sizes = [len(e) + 1 for e in edges]
    at = bins_of(x, edges)
    tables = [np.zeros(s) for s in sizes]
    total = np.full(len(y), base)
    for _ in range(rounds):
        for f in range(n_features):
            p = 1 / (1 + np.exp(-total))
            g = np.bincount(at[:, f], weights=y - p, minlength=sizes[f])
            h = np.bincount(at[:, f], weights=p * (1 - p), minlength=sizes[f])
            step = rate * shallow_tree(g, h, smooth)
            tables[f] += step
            total += step[at[:, f]]
    rough = [np.arange(s) * min(coarse, s) // s for s in sizes]
    low = np.stack([rough[f][at[:, f]] for f in range(n_features)], axis=1)
    shapes = [int(r.max()) + 1 for r in rough]

    def cells(a: int, b: int, w: np.ndarray) -> np.ndarray:
        return np.bincount(low[:, a] * shapes[b] + low[:, b], weights=w, minlength=shapes[a] * shapes[b]).reshape(shapes[a], shapes[b])

    p = 1 / (1 + np.exp(-total))
    usable = [f for f in range(n_features) if shapes[f] > 1]
    ranked = sorted(((-quadrants(cells(a, b, y - p), cells(a, b, p * (1 - p)), smooth)[0], a, b) for a, b in combinations(usable, 2)))
    pairs = [(a, b) for _, a, b in ranked[:n_pairs]]
    pair_tables = [np.zeros((shapes[a], shapes[b])) for a, b in pairs]
    for _ in range(pair_rounds):
        for n, (a, b) in enumerate(pairs):
            p = 1 / (1 + np.exp(-total))
            step = rate * quadrants(cells(a, b, y - p), cells(a, b, p * (1 - p)), smooth)[1]
            pair_tables[n] += step
            total += step[low[:, a], low[:, b]]
    return Model(base, edges, tables, pairs, rough, pair_tables)


def learn(documents: DataFrame, labels: DataFrame, sample_rows: int = 20_000, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on at most ``sample_rows`` labelled rows, taken in the order of a hash of their id.

    Labels that are null or belong to no document are not used; an id with several labels counts with each. The
    sample has a fixed bound, so its ids are broadcast and its features come to the driver.
    """
    chosen = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").cast("double").alias("_label")
    )
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample_rows)
    rows = documents.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(F.broadcast(chosen), "_id")

    def work(texts: pa.Array) -> list[pa.Array]:
        x = features(texts)
        offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
        return [pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))]

    found = map_texts(rows, "_text", ["_id", "_label"], {"_features": "array<double>"}, work).collect()
    found.sort(key=lambda r: (r["_id"], r["_label"], r["_features"]))
    x = np.array([r["_features"] for r in found], float).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r["_label"] for r in found], float))


def assess(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` plus ``score`` (0 to 1, higher: label 1 likelier), from whole texts.

    Null counts as empty; an empty text has a score like any other. Nothing but the text enters the score. A kept
    column called ``score`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def work(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(shared.value.score(features(texts)))]

    return map_texts(df, text, list(keep), {"score": "double"}, work)
