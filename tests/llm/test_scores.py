"""Toxicity, hard negatives and alignment against plain versions."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from railloom.llm import alignment, bpe, negatives, queries, toxicity
from tests.llm import cases

SF = "/root/testdata/sf0.01"
VOCABULARIES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
LABELS = "doc_id long, toxic int, text string"


# toxicity


def plain_models(texts: list[str], labels: list[int | None]):
    """Log probabilities of both classes by plain dictionaries, as a function of a gram."""
    grams = [Counter(g for w in toxicity.WORDS.findall(t.lower()) for p in [f"   {w} "] for g in (p[i : i + 4] for i in range(len(p) - 3))) for t in texts]
    total = sum(grams, Counter())
    by_class = [sum((g for g, k in zip(grams, labels, strict=True) if k == want), Counter()) for want in (1, 0)]

    def below(counts):
        return Counter(g[1:] for g, n in counts.items() if n)

    def cut(counts, values=None):
        ones, twos = (sum(v == k for v in counts.values()) for k in (1, 2))
        return min(0.95, ones / (ones + 2 * twos)) if ones else 0.5

    def smoothed(counts, lower):
        d, sums, freed = cut(counts), defaultdict(float), defaultdict(float)
        for g, n in counts.items():
            sums[g[:-1]] += n
            freed[g[:-1]] += min(n, d)
        return lambda g: (counts[g] - min(counts[g], d)) / sums[g[:-1]] + freed[g[:-1]] / sums[g[:-1]] * lower(g[1:]) if sums.get(g[:-1]) else lower(g[1:])

    triples = below(total)
    pairs = below(triples)
    singles = below(pairs)
    shared = smoothed(pairs, smoothed(singles, lambda g: 1 / len(singles)))
    out = []
    for counts in by_class:
        four = smoothed(counts, smoothed(below(counts), shared))
        out.append(lambda g, four=four: math.log(four(g)))
    return out


def test_likelihoods_equal_plain_models(spark):
    labels = {1: 1, 2: 0, 3: 1, 9: 0, 11: 1, 12: 0, 99: 1}
    docs = cases.documents(spark)
    given = spark.createDataFrame([(k, v, "x") for k, v in labels.items()] + [(4, None, ""), (None, 1, ""), (13, 0, ""), (13, 1, "")], LABELS)
    held = {r["id"] for r in spark.createDataFrame([(k,) for k in labels], "id long").where(F.pmod(F.xxhash64("id"), F.lit(toxicity.CALIBRATE)) == 0).collect()}
    taught = [labels.get(i) if i not in held else None for i, _, _ in cases.TEXTS]
    assert {0, 1} <= set(taught)
    models = plain_models([t or "" for _, t, _ in cases.TEXTS], taught)
    rows = toxicity.assess(docs, given, keep=tuple(docs.columns)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in rows) == sorted((i or 0, t or "") for i, t, _ in cases.TEXTS)
    for r in rows:
        words = toxicity.WORDS.findall((r["text"] or "").lower())
        assert r["n_words"] == len(words) and 0 <= r["score"] <= 1
        sums, places, lead = [0.0, 0.0], 0, {m: 0.0 for m in toxicity.MARGINS}
        for word, times in Counter(words).items():
            padded = f"   {word} "
            own = [sum(m(padded[i : i + 4]) for i in range(len(padded) - 3)) for m in models]
            sums = [s + times * o for s, o in zip(sums, own, strict=True)]
            places += times * (len(word) + 1)
            lead = {m: v + times * max(own[0] - own[1] - toxicity.MARGINS[m], 0) for m, v in lead.items()}
        assert r["toxic_ll"] == pytest.approx(sums[0] / max(places, 1)) and r["ordinary_ll"] == pytest.approx(sums[1] / max(places, 1))
        assert all(r[m] == pytest.approx(v / max(len(words), 1), abs=1e-9) for m, v in lead.items())


def test_grams_of_many_symbols():
    rng = np.random.default_rng(3)
    words = ["".join(chr(c) for c in rng.integers(0x4E00, 0x9FFF, 40)) for _ in range(2000)] + ["a" * 5000, "b"]
    grams, places, lengths = toxicity.grams_of(words)
    assert lengths.tolist() == [len(w) + 1 for w in words] and len(set(grams)) == len(grams)
    expected = [p[i : i + 4] for w in words for p in [f"   {w} "] for i in range(len(p) - 3)]
    assert [grams[p] for p in places] == expected


def test_many_symbols_and_few_are_numbered_alike():
    wide = [chr(0x20000 + n) * 2 + chr(0x40000 + n) for n in range(42_000)]  # too many symbols for one number per gram
    grams, places, _ = toxicity.grams_of(wide)
    assert [grams[p] for p in places[:4]] == ["   " + wide[0][0], "  " + wide[0][:2], " " + wide[0], wide[0] + " "]
    assert len(places) == 4 * len(wide) and len(grams) == len({g for w in wide for p in [f"   {w} "] for g in (p[i : i + 4] for i in range(4))})


def test_toxicity_without_labels_or_documents(spark):
    docs = cases.documents(spark)
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in toxicity.assess(docs, none).collect()} == {0.5}
    assert toxicity.assess(cases.empty(spark), none).count() == 0
    one = spark.createDataFrame([(1, 1, ""), (2, 1, ""), (3, 1, ""), (9, 1, ""), (12, 1, "")], LABELS)
    scores = {r["score"] for r in toxicity.assess(docs, one).collect()}
    assert len(scores) == 1 and scores.pop() >= 0.5


def test_op11_on_held_out_documents(spark):
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = queries.op11_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    toxic, clean = np.array([s for s, t in held if t]), np.array([s for s, t in held if not t])
    assert np.mean(toxic[:, None] > clean) > 0.96
    assert (toxic >= 0.5).mean() > 0.9 and (clean < 0.5).mean() > 0.95


def test_op11_never_sees_held_out_labels(spark, tmp_path):
    for name in ("documents", "labels"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name == "labels":
            held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
            df = df.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = {r["doc_id"]: r["score"] for r in queries.op11_toxicity(spark, "/root/testdata/sf0.001").collect()}
    after = {r["doc_id"]: r["score"] for r in queries.op11_toxicity(spark, str(tmp_path)).collect()}
    assert after.keys() == before.keys() and all(after[k] == pytest.approx(before[k], rel=1e-9) for k in after)


# hard negatives


def plain_negatives(rows, step):
    points = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, lab, q in {(i, lab, tuple(v)) for i, lab, v in points if i % step == 0}:
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=False)), i, other) for i, other, v in points if i != a)
        for s, p, _ in [x for x in scored if x[2] == lab][:5]:
            fit = [(t, n) for t, n, other in scored if other != lab and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(a, p, rank, n, -s, -t) for rank, (t, n) in enumerate(fit, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, query string, found string, tile string"


def mined(spark, rows, step=10):
    df = spark.createDataFrame([(i, v, lab, "a", "b", "c") for i, lab, v in rows], VECTORS)
    return sorted(tuple(r) for r in negatives.mine(df, F.col("id") % step == 0).collect())


def test_negatives_equal_plain_search(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST_TILE", 40)
    monkeypatch.setattr(negatives, "TILES", 4)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6))
    rows = [(n, int(n % 4), (centres[n % 4] * 0.4 + rng.normal(size=6) * 0.3).tolist()) for n in range(400)]
    rows += [(1000 + n, 1, [0.5] * 6) for n in range(150)] + [(2000 + n, 2, [0.25] * 6) for n in range(60)]  # a vector that many share
    rows += [(3000, None, [1.0] * 6), (3010, 1, None), (3020, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (3030, 1, [math.nan] + [1.0] * 5), (3040, 1, [math.inf] * 6)]
    rows += [(None, 1, [1.0] * 6), (3050, 1, [0.5, 0.5]), (3060, 3, [0.0] * 6), (3070, 2, []), (20, 2, rows[20][2]), (30, *rows[30][1:]), (3080, 7, [-0.5] * 6)]
    want = plain_negatives(rows, 10)
    assert len(want) > 500 and mined(spark, rows) == want


def test_negatives_of_little(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, 1, [1.0])]) == []
    assert mined(spark, [(10, 1, [1.0]), (11, 1, [1.0]), (12, 2, [0.5]), (13, 2, [0.25])]) == [(10, 11, 1, 12, 65536, 32768)]
    with pytest.raises(ValueError, match="exact"):
        mined(spark, [(10, 1, [1e9]), (11, 1, [1e9])])


def test_tree_bounds_hold_and_boxes_are_pruned():
    rng = np.random.default_rng(6)
    ids, labels, vectors = np.arange(3000), rng.integers(0, 3, 3000), rng.integers(-200, 200, (3000, 4))
    tree = negatives.Tree(ids, labels, vectors)
    queries_ = rng.integers(-200, 200, (5, 4)).astype(float)
    low, high = tree.bounds(tree.leaves, queries_)
    for n, start in enumerate(tree.starts):
        scores = tree.vectors[start : start + negatives.LEAF] @ queries_.T
        assert (scores.min(axis=0) >= low[:, n]).all() and (scores.max(axis=0) <= high[:, n]).all()
    opened = []

    class Counted:
        def __getitem__(self, at):
            opened.append(at)
            return vectors_[at]

    vectors_, tree.vectors = tree.vectors, Counted()
    list(tree.search(queries_, np.full(5, -1), np.zeros(5), [[(-math.inf, math.inf)]] * 5, True, 5))
    assert 0 < len(opened) < 5 * len(tree.starts) / 2


# alignment


def plain_alignment(text: str | None, a, b):
    """Ids and byte ranges of both sides, groups and links by comparing everything."""
    if not text:
        return [], []
    left = a.encode(" " + text, add_special_tokens=False).ids
    right = b.encode(text)
    symbols = bpe.byte_symbols()
    spans = []
    for tokens in ([bytes(symbols[c] for c in a.id_to_token(i)) for i in left], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in right]):
        if b"".join(tokens) != (" " + text).encode():
            return [], []
        ends = np.cumsum([len(t) for t in tokens]).tolist()
        spans.append(list(zip([0, *ends[:-1]], ends, strict=True)))
    common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, start = [], 0
    for end in common:
        groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, at, strict=True) if start <= s and e <= end) for ids, at in zip((left, right), spans, strict=True)))
        start = end
    links = [(i, j) for i, (s, e) in zip(left, spans[0], strict=True) for j, (t, f) in zip(right, spans[1], strict=True) if s < f and t < e]
    return groups, links, len(left), len(right)


ODD = ["x", " ", "  a  b\n\nc\td é▁x", "▁", "<s> </s><unk><|endoftext|>", "é ﬁ ™ 😀😀 ​", "1234567890" * 9, "\r\n \x00 \x7f", "naïve café — über", "A" * 300]


def test_alignment_equals_plain(spark):
    a, b = Tokenizer.from_file(VOCABULARIES[0]), sentencepiece.SentencePieceProcessor(model_file=VOCABULARIES[1])
    a.encode_special_tokens = True
    texts = [t if not t or len(t) < 5000 else t[:3000] for _, t, _ in cases.TEXTS] + ODD
    docs = cases.documents(spark, [(n if n != 4 else None, t, "en") for n, t in enumerate(texts)] + [(7, ODD[0], None)])
    plain = [plain_alignment(t, a, b) for t in [*texts, ODD[0]]]
    held = Counter(pair for p in plain for pair in set(p[1]))
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    want = []
    for p in plain:
        links = p[1]
        sha = hashlib.sha256(";".join(p[0]).encode()).hexdigest() if links else ""
        want.append(((p[2], p[3]) if links else (0, 0)) + (len(p[0]), len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), sha))
    assert sum(w[0] == 0 for w in want) >= 2 and sum(w[3] > 0 for w in want) > 10
    out = alignment.align(docs, *VOCABULARIES, keep=tuple(docs.columns))
    keys = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted(((r["text"] or ""), *[r[k] for k in keys]) for r in out.collect())
    assert got == sorted(((t or ""), *w) for t, w in zip([*texts, ODD[0]], want, strict=True))
    strings = {r["text"]: r["groups"] for r in alignment.groups(docs, *VOCABULARIES, keep=("text",)).collect()}
    assert all(strings[t] == (";".join(p[0]) if p[1] else "") for t, p in zip([*texts, ODD[0]], plain, strict=True))
    assert alignment.align(cases.empty(spark), *VOCABULARIES).count() == 0


def test_gallop_from_any_guess():
    rng = np.random.default_rng(8)
    for _ in range(50):
        long = np.sort(rng.choice(1000, rng.integers(1, 200), replace=False))
        short = np.sort(rng.integers(0, 1001, 60))
        low, high = np.zeros(60, np.int64), np.full(60, len(long))
        guess = rng.integers(0, len(long) + 1, 60)
        assert alignment.gallop(short, long, guess, low, high).tolist() == np.searchsorted(long, short).tolist()


def test_op13_counts_hold_together(spark):
    rows = queries.op13_alignment(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    for r in rows:
        assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] and r["n_best"] <= r["n_links"] <= r["count_sum"] or r["n_a"] == 0
    assert sum(r["n_best"] > 0 for r in rows) > 150
