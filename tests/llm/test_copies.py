"""Set join, phrase dedup and decontamination against brute force; the pipeline against its stages."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from railloom.llm import components, decontaminate, phrase_dedup, queries, set_join
from tests.llm import cases

SF = "/root/testdata/sf0.001"


def texts_of(spark) -> list[tuple[int, str]]:
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# set join


def shingles(text: str | None) -> frozenset:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_components(texts) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t) for i, t in texts}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(n: int, seed: int, edits: int) -> list[str]:
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(200)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 10**6)}"
        out.append(" ".join(words[rng.randint(0, 6) :]))
    return out


@pytest.mark.parametrize("heavy_share", [4000, 4])
def test_links_are_complete(spark, monkeypatch, heavy_share):
    """With heavy_share 4 many shingles count as heavy; the order changes, the links do not."""
    monkeypatch.setattr(set_join, "HEAVY_SHARE", heavy_share)
    texts = [t for s in range(4) for t in near_copies(20, s, 7)]
    texts += ["one", "One", "two words", "two  words", "a b c d", "A B C D e", "", " \n", "same line of words here " * 3] + ["é É", "É é"]
    rows = [(n * 3 + 1, t) for n, t in enumerate(texts)]
    docs = cases.documents(spark, [(i, t, None) for i, t in rows])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in set_join.components(docs).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_links_with_overlap(spark, monkeypatch, most):
    """Also where there are too many ids to broadcast."""
    monkeypatch.setattr(set_join, "BROADCAST_IDS", most)
    texts = near_copies(30, 9, 5)
    docs = cases.documents(spark, [(n, t, None) for n, t in enumerate(texts)])
    members, links = set_join.join(docs)
    reps = {r["doc_id"]: r["rep_id"] for r in members.collect()}
    got = {(r["a"], r["b"]): r["overlap"] for r in links.collect()}
    sets = {n: shingles(t) for n, t in enumerate(texts)}
    kept = sorted(set(reps.values()))
    want = {}
    for n, b in enumerate(kept):
        for a in kept[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * len(sets[a] | sets[b]):
                want[a, b] = both
    assert set(got.items()) <= set(want.items()) and len(want) > 20
    groups = brute_components([(n, texts[n]) for n in kept])
    linked = {r["id"]: r["component"] for r in components.connected(links.select("a", "b")).collect()}
    assert {n: c for n, (_, c) in groups.items()} == {n: linked.get(n, n) for n in kept}


def test_op10_against_brute_force(spark):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op10_set_join(spark, SF).collect()}
    assert got == brute_components(texts_of(spark))


def test_set_join_of_odd_documents(spark):
    rows = set_join.components(cases.documents(spark)).collect()
    assert len(rows) == len([i for i, _, _ in cases.TEXTS if i is not None])
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert found == brute_components([(i, t) for i, t, _ in cases.TEXTS if i is not None])
    assert set_join.components(cases.empty(spark)).count() == 0


def test_rows_without_id_have_components(spark, tmp_path):
    family, alone = near_copies(12, 3, 5), near_copies(4, 5, 5)
    texts = [(None if n % 3 == 0 else n + 50, t) for n, t in enumerate(family)] + [(None, t) for t in alone] + [(None, "one text"), (None, ""), (None, None), (7, "x")]
    docs = cases.documents(spark, [(i, t, None) for i, t in texts])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stand_in = [(10**6 + n if i is None else i, t or "") for n, (i, t) in enumerate(texts)]
    want = brute_components(stand_in)
    rows = queries.op10_set_join(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in rows) == Counter((i, want[s][0]) for (i, _), (s, _) in zip(texts, stand_in, strict=True))
    ids = {i for i, _ in texts if i is not None}
    groups = defaultdict(Counter)
    for r in rows:
        groups[r["component_id"]][r["doc_id"]] += 1
    real = Counter((want[s][1], i) for (i, _), (s, _) in zip(texts, stand_in, strict=True) if want[s][1] in ids)
    assert Counter({(c, i): n for c, members in groups.items() if c in ids for i, n in members.items()}) == real
    assert sum(c not in ids for c in groups) == len({c for _, c in want.values() if c not in ids}) - 1  # two empty texts have one key
    left = corpus_pipeline.near_copies(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted([*[str(i) for i in {c for _, c in want.values()} & ids], *["None"] * len({c for _, c in want.values()} - ids)])


def test_ids_that_repeat_with_other_texts(spark):
    """Rows are documents of their own: each links by its own text, whatever else has its id."""
    first, other = " ".join(f"a{n}" for n in range(41)), " ".join(f"b{n}" for n in range(61))
    texts = [(1, first, "en"), (2, first + " x", "en"), (2, other, "en"), (5, other + " y", "en"), (2, other, "en"), (3, "apart from all of these words", "en"), (3, None, "en"), (None, first, "en")]
    got = sorted(((r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in set_join.all_components(cases.documents(spark, texts)).collect())
    assert got == [(0, 37, 1), (1, 37, 1), (2, 38, 1), (2, 57, 2), (2, 57, 2), (3, 0, 3), (3, 2, 3), (5, 58, 2)]
    named = cases.documents(spark, texts).withColumnRenamed("source", "_key_of_row").withColumnRenamed("row", "_dropped")
    kept = corpus_pipeline.near_copies(spark, named, "")
    assert kept.columns == named.columns
    assert sorted(((r["doc_id"] or 0), r["text"] or "") for r in kept.collect()) == sorted([(1, first), (2, other), (2, other), (3, texts[5][1]), (3, "")])


def test_lists_skip_only_what_cannot_match():
    rng = np.random.default_rng(4)
    n = 400
    shingle, doc = rng.integers(0, 5, n), np.arange(n) % 90
    size = 20 + doc % 40
    place = rng.integers(0, 4, n)
    sketch = rng.integers(0, 2**63, (90, set_join.SKETCH_WORDS)).astype(np.uint64)[doc] & np.uint64(0x0101)
    component = doc // 3
    columns = [shingle.astype(np.int64), doc.astype(np.int64), size.astype(np.int32), place.astype(np.int32), sketch]
    a, b = set_join.list_pairs(*columns, component.astype(np.int64))
    want, near = set(), set()
    for x in range(n):
        for y in range(n):
            if shingle[x] == shingle[y] and doc[x] < doc[y]:
                small, large = sorted((int(size[x]), int(size[y])))
                reach, least = min(size[x] - place[x], size[y] - place[y]), -(-(small + large) * 80 // 180)
                apart = sum(int(v).bit_count() for v in sketch[x] ^ sketch[y])
                if small >= -(-large * 80 // 100) and reach >= least and apart <= small + large - 2 * least:
                    near.add((int(doc[x]), int(doc[y])))
                    if component[x] != component[y]:
                        want.add((int(doc[x]), int(doc[y])))
    first, second = set_join.leader_pairs(*columns)
    assert 0 < len(first) <= n and set(zip(first.tolist(), second.tolist(), strict=True)) <= near
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_wide_sketches_rule_out_only_what_cannot_link(spark):
    """Sets from none to 5,000 shingles: halves added up, a bound that holds, long unrelated sets told apart."""
    rng = np.random.default_rng(6)
    sizes = np.array([0, 1, 511, 512, 513, 900, 1100, 5000, 4300, 4900])
    pool = rng.integers(0, 2**63, 12_000).astype(np.uint64)
    starts = np.array([0, 0, 0, 0, 0, 40, 0, 0, 300, 7000])  # sets are runs of the pool, and the last one is apart
    flat = np.concatenate([pool[s : s + n] for s, n in zip(starts, sizes, strict=True)])
    narrow, wide = (column.to_pylist() for column in set_join.sketches_of(flat, sizes))
    assert [len(w) * 8 for w in wide] == [512, 512, 512, 512, 1024, 1024, 2048, 8192, 8192, 8192]
    sets = [set(pool[s : s + n].tolist()) for s, n in zip(starts, sizes, strict=True)]
    for x, one in enumerate(sets):
        counts = [0] * 512
        for shingle in one:
            counts[(shingle >> 20) % 512] ^= 1
        assert narrow[x] == np.packbits(np.array(counts, np.uint8)).tobytes()
        for y, other in enumerate(sets):
            assert set_join.apart(wide[x], wide[y]) <= len(one ^ other)
    rows = [(n, int(sizes[n]), wide[n]) for n in range(len(sizes))]
    table = spark.createDataFrame([*rows, rows[8]], "doc_id long, n_shingles long, wide binary")  # a repeated row
    pairs = [(a, b) for b in range(1, len(sets)) for a in range(1, b)]
    got = {tuple(r) for r in set_join.plausible(spark.createDataFrame(pairs, "a long, b long"), table).collect()}
    linked = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {(7, 8), (2, 3)} <= linked <= got and not {(7, 9), (8, 9)} & got
    assert set_join.plausible(spark.createDataFrame([], "a long, b long"), table).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.range(0, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(900, 800), (5, 5)], "a long, b long"))
    got = {r["id"]: r["component"] for r in components.connected(links).collect()}
    assert got == {n: 0 for n in range(301)} | {900: 800, 800: 800}
    assert components.connected(links.where("false")).count() == 0


# repeated passages


def brute_cut(texts: list[tuple[int | None, bytes]], span: int) -> list[tuple]:
    counts = Counter(t[i : i + span] for _, t in texts for i in range(len(t) - span + 1))
    out = []
    for d, t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if counts[t[i : i + span]] > 1:
                covered[i : i + span] = b"\1" * span
        runs = sum(1 for i in range(len(t)) if covered[i] and (i == 0 or not covered[i - 1]))
        out.append((d, len(t), sum(covered), runs, bytes(b for b, c in zip(t, covered, strict=True) if not c)))
    return sorted(out, key=repr)


def cut_rows(df, **how) -> list[tuple]:
    rows = phrase_dedup.remove(df, **how).collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"] and len(r["removed"]) == r["n_spans"]
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows), key=repr)


@pytest.mark.parametrize("block", [6000, 3, 1])
def test_short_spans_against_brute_force(spark, monkeypatch, block):
    """A small alphabet, so that strings repeat by chance everywhere; with blocks of one phrase every trigger is
    halved down to single strings."""
    monkeypatch.setattr(phrase_dedup, "BLOCK_PHRASES", block)
    rng = random.Random(8)
    texts = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 400))) for _ in range(60)]
    texts += [texts[3], texts[4][5:90] + "c" + texts[5][10:80], "ab" * 100, "a" * 50, "b" * 19]
    docs = cases.documents(spark, [(n, t, None) for n, t in enumerate(texts)]).repartition(5)
    assert cut_rows(docs, span=20, trigger=8) == brute_cut([(n, t.encode()) for n, t in enumerate(texts)], 20)


@pytest.mark.parametrize("block", [6000, 1])
@pytest.mark.parametrize("nulls", [1, 3])
def test_rows_without_id_against_brute_force(spark, monkeypatch, block, nulls):
    """Near copies of over 200 bytes, of which one row or several have no id."""
    monkeypatch.setattr(phrase_dedup, "BLOCK_PHRASES", block)
    rng = random.Random(31)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    texts = [base[:n] + f"<{n}>" + base[n + 3 :] for n in (300, 450, 700, 900, 1100)]
    rows = [(None if n < nulls else n, t) for n, t in enumerate(texts)]
    docs = cases.documents(spark, [(i, t, None) for i, t in rows]).repartition(3)
    assert cut_rows(docs) == brute_cut([(i, t.encode()) for i, t in rows], 200)


@pytest.mark.parametrize("block", [600, 25])
def test_a_passage_of_most_rows_against_brute_force(spark, monkeypatch, block):
    """One passage in 700 rows, its neighbours unlike, alike in a few bytes, or cut short: over 500 phrases of a trigger."""
    monkeypatch.setattr(phrase_dedup, "BLOCK_PHRASES", block)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    texts = []
    for n in range(700):
        before = "".join(rng.choice("xy") for _ in range(rng.choice((2, 9, 120))))
        texts.append(before + passage[rng.choice((0, 0, 0, 31)) : rng.choice((260, 260, 229))] + "".join(rng.choice("xyz") for _ in range(60)) + str(n))
    docs = cases.documents(spark, [(n, t, None) for n, t in enumerate(texts)]).repartition(4)
    assert cut_rows(docs) == brute_cut([(n, t.encode()) for n, t in enumerate(texts)], 200)


def test_halves_keep_every_string():
    """Strings and their counts before and after a phrase is cut in two; equal strings get equal triggers."""
    rng = np.random.default_rng(12)
    data = rng.integers(97, 99, 120).astype(np.uint8)
    span, trigger = 20, 8
    text, first, last, at = phrase_dedup.phrases(phrase_dedup.Rolling(data), np.array([0, len(data)]), span, trigger)
    blobs = [data[f : t + span].tobytes() for f, t in zip(first, last, strict=True)]
    n = len(first)
    columns = {"trigger": [0] * n, "phrase": list(range(n)), "n": [3] * n, "doc_id": [1] * n, "copy": [0] * n, "place": first << phrase_dedup.LENGTH_BITS | last - first}
    columns |= {"lead": (at - first).astype(np.int32), "low": np.zeros(n, np.int32), "high": np.full(n, span - trigger, np.int32), "bytes": blobs}
    for _ in range(4):
        cut = phrase_dedup.halves(pa.table(columns).combine_chunks(), span)
        seen, keys = Counter(), {}
        for row in cut.to_pylist():
            for i in range((row["place"] & ((1 << phrase_dedup.LENGTH_BITS) - 1)) + 1):
                string = row["bytes"][i : i + span]
                seen[string] += row["n"]
                assert row["low"] <= row["lead"] - i <= row["high"] and keys.setdefault(string, row["trigger"]) == row["trigger"]
        assert seen == Counter({s: 3 * c for s, c in Counter(data[i : i + span].tobytes() for i in range(len(data) - span + 1)).items()})
        columns = {c: cut.column(c) for c in cut.schema.names}


def test_odd_documents_keep_what_is_unique(spark):
    texts = [(i, (t or "").encode()) for i, t, _ in cases.TEXTS if t != cases.LONG and t != cases.LONG + " end"]
    docs = cases.documents(spark).where("n_chars IS NULL AND (text IS NULL OR length(text) < 10000)")
    assert cut_rows(docs) == brute_cut(texts, 200)
    long = {r["doc_id"]: r for r in phrase_dedup.remove(cases.documents(spark)).collect() if r["doc_id"] in (9, 10)}
    assert long[9]["n_removed"] == long[9]["n_bytes"] and long[10]["n_bytes"] - long[10]["n_removed"] == 3
    assert phrase_dedup.remove(cases.empty(spark)).count() == 0


def test_op8_against_brute_force(spark):
    want = brute_cut([(d, t.encode()) for d, t in texts_of(spark)], 200)
    got = queries.op8_phrases(spark, SF).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=repr) == sorted(
        ((d, n, m, s, hashlib.sha256(k).hexdigest()) for d, n, m, s, k in want), key=repr
    )


def test_suffix_classes_are_in_suffix_order():
    rng = np.random.default_rng(6)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    for span in (8, 9, 16, 20, 40):
        starts = rng.permutation(len(data) - span)[:500]
        strings = [data[s : s + span].tobytes() for s in starts]
        order = {s: n for n, s in enumerate(sorted(set(strings)))}
        assert phrase_dedup.suffix_classes(data, starts, span).tolist() == [order[s] for s in strings]


# benchmark passages


def edit_distance_in(pattern: bytes, text: bytes) -> int:
    row = [0] * (len(text) + 1)
    for p in pattern:
        last, row = row, [row[0] + 1]
        for n, c in enumerate(text):
            row.append(min(last[n] + (c != p), last[n + 1] + 1, row[n] + 1))
    return min(row)


def test_matches_are_those_of_plain_alignment():
    rng = random.Random(12)
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrs')}{rng.choice('aeiou')}" for _ in range(300)]
    items = [(n, " ".join(rng.choice(words) for _ in range(rng.randint(5, 40)))) for n in range(25)]
    docs = []
    for n in range(80):
        filler = " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        passage = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, len(passage) // 8) if n % 3 else 0):
            at = rng.randrange(len(passage))
            passage[at : at + rng.randint(0, 1)] = [rng.choice("xyz ")] * rng.randint(0, 1)
        docs.append(filler + "\n" + "".join(passage) + ", " + filler if n % 5 else filler)
    index = decontaminate.build(items)
    found = decontaminate.matches(index, docs)
    hits = 0
    for text, got in zip(docs, found, strict=True):
        data = decontaminate.normal_bytes([text])[0].tobytes()[: -decontaminate.Q]
        want = {}
        for w, item in enumerate(index.items.tolist()):
            least = edit_distance_in(index.patterns[w, : index.lengths[w]].tobytes(), data)
            if least <= index.edits[w]:
                want[item] = min(least, want.get(item, 99))
        assert {i: k for i, _, _, k in got} == want
        hits += len(want)
    assert hits > 40


def test_excerpts_match_wherever_they_are_cut():
    rng = random.Random(21)
    items = [(n, " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(40))) for n in range(6)]
    index = decontaminate.build(items)
    for length in (80, 81, 90, 100, 140):
        docs, want = [], []
        for n in range(60):
            item, text = rng.choice(items)
            at = rng.randint(0, len(text) - length)
            passage = list(text[at : at + length].replace(" ", "x") if n % 10 == 9 else text[at : at + length])
            for _ in range(rng.randint(0, 6) if n % 2 and n % 10 != 9 else 0):
                passage[rng.randrange(1, len(passage) - 1)] = "z"
            docs.append("zz " * rng.randint(0, 9) + "".join(passage) + " zz" * rng.randint(0, 9))
            data = decontaminate.normal_bytes(docs[-1:])[0].tobytes()[: -decontaminate.Q]
            near = [s for s in range(max(0, at - 6), min(len(text) - 80, at + length - 74) + 1)]
            least = min(edit_distance_in(text[s : s + 80].encode(), data) for s in (near if n % 2 else [at]))
            want.append({item: least} if least <= 6 else {})
        assert [{i: k for i, _, _, k in got} for got in decontaminate.matches(index, docs)] == want
        assert sum(map(len, want)) > 50


def test_find_in_odd_documents(spark):
    passage = "benchmark question: which of the seven rivers flows from the north to the south, and why does it?"
    texts = [(i, t, lang) for i, t, lang in cases.TEXTS] + [(50, cases.LONG + " " + passage.upper() + cases.LONG, "en"), (51, passage.replace("rivers", "rivrs"), "en"), (52, passage[:40], "en")]
    bench = spark.createDataFrame([(1, passage, "x"), (2, passage, "x"), (3, None, "x"), (4, "short", "x"), (None, passage, "x"), (5, "é" * 100, "x")], "item_id long, text string, matches string")
    docs = cases.documents(spark, texts)
    for block in (1 << 20, 60):
        out = decontaminate.find(docs, bench, keep=tuple(docs.columns), block_bytes=block)
        assert dict(out.dtypes)["matches"] == decontaminate.MATCHES
        rows = out.collect()
        assert len(rows) == len(texts)
        assert {(r["doc_id"], m["item_id"]) for r in rows for m in r["matches"]} == {(50, 1), (50, 2), (51, 1), (51, 2)}
    assert decontaminate.find(cases.empty(spark), bench).count() == 0
    assert {len(r["matches"]) for r in decontaminate.find(docs, bench.where("false")).collect()} == {0}


def test_op4_finds_every_whole_item_and_leaves_the_rest(spark):
    def norm(t):
        return re.sub(r"[^a-z0-9\x80-\U0010ffff]+", " ", t.lower()).strip()

    items = [(r["item_id"], norm(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r for r in queries.op4_decontaminate(spark, SF).collect()}
    index = decontaminate.build(items)
    for doc_id, text in texts_of(spark):
        data = norm(text)
        whole = {i for i, t in items if t in data}
        assert not whole or rows[doc_id]["contaminated"]
        if rows[doc_id]["contaminated"] and not whole:
            closest = min(edit_distance_in(index.patterns[w, : index.lengths[w]].tobytes(), data.encode()) for w in range(len(index.items)))
            assert closest <= index.edits.max()


# pipeline


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    unique = [" ".join(f"{w}{n}" for w in cases.ENGLISH.split()) + " " + cases.ENGLISH for n in range(6)]
    item = "what is the capital of the country that lies between the two great lakes and the long mountain chain"
    near = " ".join(f"alpha{n} beta{n}" for n in range(60))
    texts = [(n, t, "en") for n, t in enumerate(unique)]
    texts += [(20, unique[0] + "  ", "en"), (21, unique[0], "en"), (22, near, "en"), (23, near + " gamma", "en"), (24, "1234 !!", "en"), (25, None, None)]
    texts += [(26, "Now, " + item.upper() + "? " + unique[1][::-1], "en"), (27, unique[5], None), (27, unique[5], None)]
    cases.documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for k, (name, work) in enumerate(corpus_pipeline.STAGES):
        out = work(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        kept.append(sorted(r["doc_id"] for r in docs.collect()))
    everything = sorted(i for i, _, _ in texts)
    assert kept[0] == [i for i in everything if i not in (24, 25)]
    assert kept[1] == [1, 2, 3, 4, 5, 20, 22, 23, 26]
    assert kept[2] == [i for i in kept[1] if i != 23]
    assert kept[3] == kept[4] == [i for i in kept[2] if i != 26]
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == kept[4]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    cases.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_stage_by_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    white = str.maketrans("", "", " \t\n\x0b\x0c\r")
    first = corpus_pipeline.language(spark, docs, SF)
    ids = {r["doc_id"] for r in first.collect()}
    assert {i for i, t in texts.items() if any(c.isalpha() for c in t)} == ids
    groups = defaultdict(list)
    for i in ids:
        groups[texts[i].translate(white)].append((-len(texts[i]), i))
    want = {min(v)[1] for v in groups.values()}
    second = corpus_pipeline.exact_copies(spark, docs, SF)
    assert {r["doc_id"] for r in second.collect()} == want
    labels = brute_components([(i, texts[i]) for i in want])
    third = corpus_pipeline.near_copies(spark, docs.where(F.col("doc_id").isin(list(want))), SF)
    assert {r["doc_id"] for r in third.collect()} == {i for i, (_, c) in labels.items() if c == i}
