"""Language ID and the quality classifier: parts against brute force, queries by held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from railloom.llm import langid, quality, queries
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def greedy_phrases(reference: list[int], symbols: list[int]) -> int:
    """The longest match at each place by plain search."""
    grams = {tuple(reference[i:j]) for i in range(len(reference)) for j in range(i + 1, min(len(reference), i + 40) + 1)}
    at = phrases = 0
    while at < len(symbols):
        n = 1
        while at + n < len(symbols) and tuple(symbols[at : at + n + 1]) in grams:
            n += 1
        at, phrases = at + n, phrases + 1
    return phrases


def test_automaton_parses_as_plain_search():
    rng = np.random.default_rng(1)
    reference = rng.integers(0, 4, 200).tolist()
    width = 7
    table = langid.SuffixAutomaton(reference).table(width).ravel()
    for n in (1, 5, 200, 511):
        symbols = rng.integers(0, 6, n)
        model = langid.Model(["x"], [""] * (width - 3), table.astype(np.int32), np.zeros(1, np.int64), np.ones(1))
        assert langid.phrases(model, symbols.astype(np.uint8), np.array([n]))[0, 0] == greedy_phrases(reference, symbols.tolist())


def test_texts_in_blocks_and_batches_do_not_mix():
    model = langid.fit({"en": [cases.ENGLISH * 5], "fr": [cases.FRENCH * 5]}, 2000)
    texts = [cases.ENGLISH * 30, "", cases.FRENCH, "!!", cases.ENGLISH]
    names, scores = langid.predict(model, texts)
    assert names == ["en", "und", "fr", "und", "en"] and scores[1] == scores[3] == 0 and (scores >= 0).all() and (scores <= 1).all()
    for text, name, score in zip(texts, names, scores, strict=True):
        one, two = langid.predict(model, [text])
        assert one == [name] and two[0] == score


#: First letter and size of the alphabets of invented scripts.
SCRIPTS = {"en": (0x61, 26), "ru": (0x430, 32), "el": (0x3B1, 24), "he": (0x5D0, 27), "ar": (0x620, 42), "hi": (0x905, 52), "zh": (0x4E00, 3000), "ja": (0x3041, 86), "ko": (0xAC00, 2000)}


def test_many_scripts_at_once():
    """Two languages of each script that share all its letters, told apart by their words alone."""
    rng = np.random.default_rng(3)
    made: dict[str, list[str]] = {}
    for name, (first, n) in SCRIPTS.items():
        for kind in "ab":
            letters = [chr(first + i) for i in range(n) if chr(first + i).isalpha()]
            words = ["".join(rng.choice(letters, rng.integers(2, 7))) for _ in range(400)]
            made[name + kind] = [" ".join(rng.choice(words, 60)) for _ in range(84)]
    model = langid.fit({k: v[:64] for k, v in made.items()}, 24_000)
    every = {c for texts in made.values() for t in texts[:64] for c in t.lower() if c.isalpha()}
    assert len(model.letters) == langid.SINGLE and {*model.letters, *model.spelled} == every
    for name, texts in made.items():
        assert np.mean([x == name for x in langid.predict(model, texts[64:])[0]]) >= 0.95, name


def test_spelled_letters_are_told_apart():
    texts = ["abc xyz", "", "q", "a z"]
    plain, counts = langid.symbols_of(texts, ["a"], list("bcqxyz"))
    assert counts.tolist() == [1 + 2 + 2 + 1 + 6, 0, 2, 4]
    ends = np.cumsum(counts)
    parts = [tuple(plain[e - n : e]) for e, n in zip(ends, counts, strict=True)]
    assert parts[0][:1] == parts[3][:1] and parts[0][-2:] == parts[3][-2:] and len({parts[0][1:3], parts[0][3:5], parts[2], parts[0][-2:]}) == 4
    assert max(plain) < langid.width_of(["a"], list("bcqxyz")) - 1


def test_tables_beyond_the_bound_are_refused(monkeypatch):
    monkeypatch.setattr(langid, "MOST_ENTRIES", 1000)
    with pytest.raises(ValueError, match="transitions"):
        langid.fit({"en": [cases.ENGLISH * 5]}, 2000)


def test_identify_odd_documents(spark):
    docs = cases.documents(spark)
    model = langid.learn(docs)
    assert model.languages == ["en", "fr"]
    out = langid.identify(docs, model, keep=tuple(docs.columns))
    assert "lang_pred" in out.columns and dict(out.dtypes)["score"] == "double"
    rows = out.collect()
    assert len(rows) == len(cases.TEXTS)
    for r in rows:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered)
    assert {r["lang_pred"] for r in rows if r["text"] == cases.FRENCH} == {"fr"}
    assert langid.identify(cases.empty(spark), model).count() == 0
    nothing = langid.learn(cases.empty(spark))
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(docs, nothing).collect()} == {("und", 0.0)}


def test_op3_on_held_out_documents(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op3_language(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.98


def test_shallow_tree_is_the_best_pair_of_cuts():
    g, h = np.array([1.0, 1, 1, -2, -2, 4, 4]), np.ones(7)
    assert quality.shallow_tree(g, h, 0.0).tolist() == [1, 1, 1, -2, -2, 4, 4]
    assert quality.shallow_tree(np.array([2.0]), np.array([1.0]), 1.0).tolist() == [1.0]


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(2)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    single = quality.fit(x[:3000], y[:3000], n_pairs=0)
    assert ((single.score(x[3000:]) > 0.5) == y[3000:]).mean() < 0.7


def test_without_both_classes_the_score_is_constant():
    x = np.random.default_rng(0).random((5, len(quality.FEATURES)))
    assert set(quality.fit(x[:0], np.zeros(0)).score(x)) == {0.5}
    assert len(set(quality.fit(x, np.ones(5)).score(x))) == 1 and quality.fit(x, np.ones(5)).score(x)[0] > 0.5


def test_features_of_a_text_do_not_depend_on_its_batch():
    texts = ["", "ABC def. ", cases.ENGLISH, " \n", "é!! é!! é!!", cases.LONG]
    together = quality.features(pa.array(texts))
    for n, t in enumerate(texts):
        assert np.allclose(quality.features(pa.array([t]))[0], together[n]) and np.isfinite(together[n]).all()


def test_assess_odd_documents(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (8, 0, "x"), (12, 0, "x"), (12, None, "x"), (None, 1, "x"), (99, 1, "x"), (1, 0, "x")], "doc_id long, quality int, text string")
    model = quality.learn(docs, labels)
    out = quality.assess(docs, model, keep=tuple(docs.columns))
    rows = out.collect()
    assert len(rows) == len(cases.TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.assess(cases.empty(spark), model).count() == 0
    assert {r["score"] for r in quality.assess(docs, quality.learn(docs, labels.where("false"))).collect()} == {0.5}


def test_scores_equal_plain_sums(spark):
    """The score of every document by walking its bins one by one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    model = quality.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert model.pairs and any(len(e) for e in model.edges)
    for r in quality.assess(docs, model, keep=("text",)).collect():
        x = quality.features(pa.array([r["text"] or ""]))[0]
        bins = [sum(edge <= v for edge in edges) for v, edges in zip(x, model.edges, strict=True)]
        total = model.base + sum(table[b] for table, b in zip(model.tables, bins, strict=True))
        total += sum(t[model.coarse[a][bins[a]], model.coarse[b][bins[b]]] for (a, b), t in zip(model.pairs, model.pair_tables, strict=True))
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-min(30, max(-30, total)))))


def test_op2_on_held_out_documents(spark):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op2_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([[a > b for b in bad] for a in good]) > 0.97


@pytest.mark.parametrize("name,n", [("op2_quality", 3), ("op3_language", 4)])
def test_held_out_labels_never_enter(spark, tmp_path, name, n):
    """Other labels on held-out rows, other scores nowhere."""
    for table in ("documents", "labels"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        held = F.crc32(F.col("doc_id").cast("string")) % n == (1 if n == 3 else 2)
        changed = "quality" if table == "labels" else "lang"
        other = (1 - F.col(changed)) if table == "labels" else F.lit("xx")
        df.withColumn(changed, F.when(held, other).otherwise(F.col(changed))).coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
    column = "score"
    before = {r["doc_id"]: r[column] for r in queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()}
    assert {r["doc_id"]: r[column] for r in queries.QUERIES[name](spark, str(tmp_path)).collect()} == before
