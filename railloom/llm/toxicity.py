"""Toxicity: class-conditional Kneser-Ney models of words, spelled as symbols.

Words are runs of letters, lower-cased, with three marks before and one behind. Symbols are predicted from the three
before them. The two upper orders are counted per class on labelled rows and discounted; what the discounts free goes to
the order below, and from the pairs of symbols downwards both classes share one back-off, whose continuation counts come
from every document of the corpus, labelled or not. A rare word, or one that was never seen, is thus judged by the parts
that it shares with others.

The length-normalised log-likelihoods of both classes are compared over the whole text and, as a few words make a
text toxic, word by word: ``excess`` and ``strong`` are the means over all words of the nats by which the toxic model leads, above
a small and a large margin. A logistic curve, fitted on labelled rows that the counts left out, makes the score of all three.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railloom.llm import blocks
from railloom.llm.batches import ragged
from railloom.operators.staging import stage

ORDER = 4
#: Nats by which a word must be likelier under the toxic model before it counts: for ``excess`` and for ``strong``.
MARGINS = {"excess": 1.0, "strong": 4.0}
#: One labelled row in so many is left out of the counts and fits the curve.
CALIBRATE = 4
WORDS = re.compile(r"[^\W\d_]+")
MADE = {"n_words": "long", "toxic_ll": "double", "ordinary_ll": "double", "excess": "double", "strong": "double"}


def grams_of(words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct grams of the padded words in the order of their symbols, the gram of every place, and places per word."""
    points = np.frombuffer("".join(f"   {w} " for w in words).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    if not len(points):
        return [], np.zeros(0, np.int64), lengths
    alphabet, symbols = np.unique(points, return_inverse=True)
    ends = np.cumsum(lengths + ORDER - 1)
    first = ragged(ends - lengths - ORDER + 1, lengths)  # where the gram of each place begins
    n = len(alphabet)
    pairs = symbols[:-1] * n + symbols[1:]
    if n**ORDER < 2**62:
        codes, places = np.unique(pairs[first] * n**2 + pairs[first + 2], return_inverse=True)
        found = [codes // n ** (ORDER - 1 - k) % n for k in range(ORDER)]
    else:  # an alphabet of tens of thousands: pairs are numbered first, in their own order
        kinds, numbered = np.unique(pairs, return_inverse=True)
        codes, places = np.unique(numbered[first] * len(kinds) + numbered[first + 2], return_inverse=True)
        left, right = kinds[codes // len(kinds)], kinds[codes % len(kinds)]
        found = [left // n, left % n, right // n, right % n]
    flat = alphabet[np.stack(found, axis=1).ravel()].astype("<u4").tobytes().decode("utf-32-le")
    return [flat[k : k + ORDER] for k in range(0, len(flat), ORDER)], places, lengths


class _Words:
    """Distinct words of a block, how often each document has them, and the grams with their counts."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.sizes: list[int] = []
        self.used: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.labels: list[int | None] = []

    def add(self, texts: list[str], more: list[pa.Array]) -> None:
        number = self.index
        for text in texts:
            counted = Counter(WORDS.findall(text.lower()))
            self.used.append(np.fromiter((number.setdefault(w, len(number)) for w in counted), np.int32, len(counted)))
            self.times.append(np.fromiter(counted.values(), np.int32, len(counted)))
            self.sizes.append(len(counted))
        self.labels += more[0].to_pylist()

    def close(self) -> list:
        words = list(self.index)
        used, times = np.concatenate([*self.used, np.zeros(0, np.int32)]), np.concatenate([*self.times, np.zeros(0, np.int32)])
        grams, places, lengths = grams_of(words)
        label = np.repeat(np.array([-1 if v is None else v for v in self.labels], np.int8), self.sizes)
        counts = []
        for rows in (slice(None), label == 1, label == 0):
            of_word = np.bincount(used[rows], weights=times[rows], minlength=len(words))
            of_gram = np.bincount(places, weights=np.repeat(of_word, lengths), minlength=len(grams)).astype(np.int64)
            counts.append(pa.array([of_gram], pa.list_(pa.int64())))
        blob = blocks.press(np.array(self.sizes), used, times, tail=" ".join(words).encode())
        return [pa.array([blob], pa.binary()), pa.array([grams], pa.list_(pa.string())), *counts]


def _part(gram: Column, at: int, length: int) -> Column:
    return F.substring(gram, at, length)


def _discount(level: DataFrame, counts: list[str]) -> dict[str, float]:
    """Absolute discount of each count, from the numbers of ones and twos."""
    asked = [F.count_if(F.col(c) == k).alias(f"{c}{k}") for c in counts for k in (1, 2)]
    row = level.agg(*asked).first()
    ones = {c: row[f"{c}1"] for c in counts}
    return {c: min(0.95, ones[c] / (ones[c] + 2 * row[f"{c}2"])) if ones[c] else 0.5 for c in counts}


def _smoothed(count: Column, discount: float, context: Column, lower: Column) -> Column:
    """Discounted share of the count in its context, plus what the discounts free times ``lower``."""
    over = Window.partitionBy(context)  # as many rows as there are symbols
    cut = F.least(count.cast("double"), F.lit(discount))
    total, freed = F.sum(count).over(over), F.sum(cut).over(over)
    return F.when(total > 0, (count - cut) / total + freed / total * lower).otherwise(lower)


def class_models(counts: DataFrame) -> DataFrame:
    """``key`` (gram of four symbols), ``toxic`` and ``ordinary``: log probability of its last symbol by class.

    ``counts`` has ``key``, ``n_all``, ``n_toxic`` and ``n_ordinary``. A context that a class never saw leaves the
    prediction to the order below.
    """
    key = F.col("key")
    kinds = [F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("n_toxic") > 0).alias("n_toxic"), F.count_if(F.col("n_ordinary") > 0).alias("n_ordinary")]
    triples = stage(counts.groupBy(_part(key, 2, 3).alias("key")).agg(*kinds), "triples")
    pairs = stage(triples.groupBy(_part(key, 2, 2).alias("key")).agg(F.count(F.lit(1)).alias("n")), "pairs")
    singles = pairs.groupBy(_part(key, 2, 1).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    cut = _discount(singles, ["n"])["n"]
    row = singles.agg(F.count(F.lit(1)).alias("symbols"), F.sum("n").alias("n"), F.sum(F.least(F.col("n"), F.lit(cut))).alias("freed")).first()
    symbols, total = max(1, row["symbols"]), max(1, row["n"] or 1)
    one = singles.select(key.alias("s"), ((F.col("n") - F.least(F.col("n"), F.lit(cut))) / total + (row["freed"] or 0) / total / symbols).alias("p"))
    cut = _discount(pairs, ["n"])["n"]
    two = pairs.withColumn("s", _part(key, 2, 1)).join(one, "s")
    two = two.select(key.alias("s"), _smoothed(F.col("n"), cut, _part(key, 1, 1), F.col("p")).alias("p"))
    classes = ["n_toxic", "n_ordinary"]
    cuts = _discount(triples, classes)
    three = triples.withColumn("s", _part(key, 2, 2)).join(two, "s")
    three = three.select(key.alias("s"), *[_smoothed(F.col(c), cuts[c], _part(key, 1, 2), F.col("p")).alias(f"p{c}") for c in classes])
    cuts = _discount(counts, classes)
    four = counts.withColumn("s", _part(key, 2, 3)).join(three, "s")
    logs = [F.log(_smoothed(F.col(c), cuts[c], _part(key, 1, 3), F.col(f"p{c}"))).alias(c[2:]) for c in classes]
    return four.select("key", *logs)


def _compare(block: dict) -> list[pa.Array]:
    (sizes, used, times), spelled = blocks.unpress(block["payload"][0].as_py())
    words = spelled.decode().split(" ") if spelled else []
    grams, places, lengths = grams_of(words)
    toxic, ordinary = blocks.aligned(block["found"], len(grams), {"toxic": float, "ordinary": float})
    owner = np.repeat(np.arange(len(words)), lengths)
    of_word = [np.bincount(owner, weights=v[places], minlength=len(words)) for v in (toxic, ordinary)]
    text = np.repeat(np.arange(len(sizes)), sizes)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(text, weights=values[used] * times, minlength=len(sizes))

    n_words, n_symbols = total(np.ones(len(words))), np.maximum(total(lengths.astype(float)), 1)
    leads = [total(np.maximum(of_word[0] - of_word[1] - margin, 0)) / np.maximum(n_words, 1) for margin in MARGINS.values()]
    return [pa.array(v) for v in (n_words.astype(np.int64), *[total(v) / n_symbols for v in of_word], *leads)]


@dataclass
class Curve:
    """Score of a text from the roots of ``excess`` and ``strong``, near 0 for most texts, and the lead over the whole text."""

    weights: tuple[float, ...]

    def column(self) -> Column:
        values = [F.lit(1.0), *[F.sqrt(c) for c in MARGINS], F.col("toxic_ll") - F.col("ordinary_ll")]
        z = sum((F.lit(w) * v for w, v in zip(self.weights, values, strict=True)), F.lit(0.0))
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def fit_curve(excess: np.ndarray, strong: np.ndarray, lead: np.ndarray, label: np.ndarray, ridge: float = 0.005) -> Curve:
    """Logistic regression in which both classes weigh the same; without both the score is the share of class 1."""
    share = float(label.mean()) if len(label) else 0.5
    if not 0 < share < 1 or not len(label):
        return Curve((float(np.log((share * len(label) + 0.5) / ((1 - share) * len(label) + 0.5))) if len(label) else 0.0, 0.0, 0.0, 0.0))
    x = np.stack([np.ones(len(label)), np.sqrt(excess), np.sqrt(strong), lead], axis=1)
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1
    z, w = x / scale, np.zeros(x.shape[1])
    penalty = ridge * (np.arange(len(w)) > 0)
    weight = np.where(label > 0, 0.5 / share, 0.5 / (1 - share)) / len(label)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - label)) + penalty * w
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        w = w - np.linalg.solve(bend, slope)
    return Curve(tuple(float(v) for v in w / scale))


def assess(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 50_000, id_col: str = "doc_id", text: str = "text", label: str = "toxic", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns ``keep`` plus ``n_words``, ``toxic_ll`` and ``ordinary_ll`` (log-likelihood per symbol), ``excess``,
    ``strong``, ``score``.

    Classes are learned from at most ``sample_rows`` labelled ids in the order of a hash of the id, of which one in
    ``CALIBRATE`` fits the curve; the shared back-off counts all documents. The sample has a fixed bound and is broadcast.
    Ids with labels that differ, null labels and labels without a document teach nothing; rows that repeat an id are rows
    like any other. Null counts as empty; a text without letters has zeros and the score of zeros. Without labels of both
    classes the score is the same for all. A kept column with the name of a made one is replaced.
    """
    known = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{id_col}`").isNotNull())
    known = known.groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.min(f"`{label}`").cast("int").alias("_label"), F.max(f"`{label}`").cast("int").alias("_other"))
    order = F.xxhash64("_id")
    known = stage(known.where("_label = _other").select("_id", "_label").orderBy(order, "_id").limit(sample_rows), "sample")
    left_out = F.pmod(order, F.lit(CALIBRATE)) == 0
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"), F.col(f"`{id_col}`").alias("_id"))
    marked = whole.join(F.broadcast(known), "_id", "left")
    marked = marked.withColumn("taught", F.when(~left_out, F.col("_label"))).withColumn("held", F.when(left_out, F.col("_label")))
    kept = [c for c in dict.fromkeys(keep) if c.lower() not in {*MADE, "score"}]
    slim = marked.select(F.struct(*[F.col(f"row.`{c}`") for c in kept]).alias("row") if kept else F.lit(0).alias("row"), "text", "taught", "held")
    columns = "payload binary, keys array<string>, n_all array<bigint>, n_toxic array<bigint>, n_ordinary array<bigint>"
    made = blocks.build(slim, "text", ["row", "held"], [], ["taught"], columns, _Words)
    counted = ["n_all", "n_toxic", "n_ordinary"]
    each = made.select(F.explode(F.arrays_zip("keys", *counted)).alias("k")).select(F.col("k.keys").alias("key"), *[F.col(f"k.{c}").alias(c) for c in counted])
    counts = stage(each.groupBy("key").agg(*[F.sum(c).alias(c) for c in counted]), "grams")
    model = class_models(counts)
    compared = stage(blocks.resolve(blocks.with_values(made.drop(*counted), model), MADE, _compare), "compared")
    fitted = compared.where("held IS NOT NULL").select(*MARGINS, F.expr("toxic_ll - ordinary_ll").alias("lead"), F.col("held").cast("double")).toPandas()
    fitted = fitted.sort_values(list(fitted.columns))  # sums must not depend on the order of tasks
    curve = fit_curve(*[fitted[c].to_numpy(float) for c in fitted.columns])
    return compared.select(*([F.col(f"row.`{c}`") for c in kept]), *MADE, curve.column().alias("score"))
