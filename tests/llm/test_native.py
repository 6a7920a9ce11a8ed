"""Content sort, sharding and reply trees: no Python on the executors, exact results."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from railloom.llm import content_sort, queries, reply_trees, shards
from tests.llm import cases

WHITE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute_groups(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[(t or "").translate(WHITE)].append((-len(t or ""), i is None, i or 0, i))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("share", [1000, 3])
def test_groups_with_and_without_cut_texts(spark, monkeypatch, share):
    """With share 3, every text that more than a third of the rows have is cut into pieces."""
    monkeypatch.setattr(content_sort, "HOT_SHARE", share)
    texts = [(i, t) for i, t, _ in cases.TEXTS] + [(100 + n, "hot text" + " " * (n % 5)) for n in range(40)]
    docs = cases.documents(spark, [(i, t, None) for i, t in texts])
    rows = content_sort.exact_groups(docs).collect()
    want = brute_groups(texts)
    assert len(rows) == len(texts)
    found = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows)
    for i, t in texts:
        keep, size = want[(t or "").translate(WHITE)]
        assert found[i, keep, size, hashlib.sha256((t or "").translate(WHITE).encode()).hexdigest()] >= 1
    assert sum(r["kept"] for r in rows) == len(want)
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    left = content_sort.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(want)
    assert content_sort.exact_groups(cases.empty(spark)).count() == 0 and content_sort.drop_copies(cases.empty(spark)).count() == 0


def test_repeated_rows_leave_one(spark):
    docs = cases.documents(spark, [(1, "x", None)] * 3 + [(1, "y", None), (None, "z", None), (None, "z", None)])
    assert sorted(r["text"] for r in content_sort.drop_copies(docs).collect()) == ["x", "y", "z"]


def test_draws_follow_the_hypergeometric_law():
    rng = random.Random(1)
    draws = [shards.draw(rng, 6, 4, 5) for _ in range(20_000)]
    want = {1: 6 / 252, 2: 60 / 252, 3: 120 / 252, 4: 60 / 252, 5: 6 / 252}
    for k, p in want.items():
        assert abs(draws.count(k) / 20_000 - p) < 0.015
    assert shards.draw(rng, 0, 5, 3) == 0 and shards.draw(rng, 5, 0, 3) == 3
    big = [shards.draw(rng, 10**7, 9 * 10**7, 10**6) for _ in range(50)]
    assert abs(sum(big) / 50 - 10**5) < 500


def test_matrix_meets_both_sums():
    counts, sizes = [7, 0, 30, 5], shards.even(42, 5)
    m = shards.matrix(counts, sizes, 3)
    assert [sum(r) for r in m] == counts and [sum(c) for c in zip(*m, strict=True)] == sizes
    assert m == shards.matrix(counts, sizes, 3) != shards.matrix(counts, sizes, 4)


def test_shuffle_is_exact_whole_and_uniform(spark):
    docs = spark.range(0, 4000, 1, 7).withColumn("text", F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")))
    out = shards.shuffle(docs, 16, 5)
    rows = out.collect()
    assert sorted(r["id"] for r in rows) == list(range(4000))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(16)) and all(sorted(v) == list(range(250)) for v in slots.values())
    # no trace of the input order: neighbours fall into one shard about once in 16
    shard = {r["id"]: r["shard"] for r in rows}
    together = sum(shard[i] == shard[i + 1] for i in range(3999))
    assert 180 < together < 330
    order = [r["id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert 1700 < sum(a < b for a, b in zip(order, order[1:], strict=False)) < 2300
    assert {r["id"]: r["shard"] for r in shards.shuffle(docs, 16, 5).collect()} == shard


def test_shuffle_of_odd_rows(spark, tmp_path):
    docs = cases.documents(spark)
    out = shards.shuffle(docs, 4, 1)
    assert sorted(c for c in out.columns if c not in ("shard", "slot")) == sorted(c for c in docs.columns if c not in ("shard", "slot"))
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((i, t) for i, t, _ in cases.TEXTS)
    assert sorted(Counter(r["shard"] for r in rows).values()) == [3, 4, 4, 4]
    few = shards.shuffle(docs.limit(2), 5, 1).collect()
    assert len({r["shard"] for r in few}) == 2 and all(r["slot"] == 0 for r in few)
    assert shards.shuffle(cases.empty(spark), 3, 1).count() == 0
    shards.write_shards(docs, str(tmp_path / "s"), 4, 1)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(cases.TEXTS)


def test_equal_rows_are_spread_like_any_others(spark):
    copies = spark.range(0, 6400, 1, 4).select((F.col("id") % 100).alias("doc_id"), F.lit("same").alias("text"))
    sorted_copies = copies.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id")
    rows = shards.shuffle(sorted_copies, 16, 7).collect()
    held = Counter((r["doc_id"], r["shard"]) for r in rows)
    together = sum(n * (n - 1) for n in held.values()) / (100 * 64 * 63)
    assert abs(together - 1 / 16) < 0.01
    spread = Counter(d for d, _ in held)
    assert min(spread.values()) >= 13 and sorted(Counter(r["shard"] for r in rows).values()) == [400] * 16


def test_op5_against_its_contract(spark):
    """What the law says, row by row: sizes, checksums, counts and slots, and no trace of source or length."""
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op5_sharding(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all((r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(docs[r["doc_id"]]) + 1, zlib.crc32(docs[r["doc_id"]]), "rows", None) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(16)) and {len(v) for v in slots.values()} <= {len(docs) // 16, len(docs) // 16 + 1}
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    equal = defaultdict(list)
    for r in rows:
        equal[docs[r["doc_id"]]].append(r["shard"])
    pairs = [a == b for v in equal.values() for n, a in enumerate(v) for b in v[:n]]
    assert not pairs or sum(pairs) / len(pairs) < 0.25



def messages(spark, rows):
    return spark.createDataFrame(rows, "tree_id long, message_id long, parent_id long, role string, text string, score double, formatted string")


def test_branches_rank_by_score(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0, "x"),
        (1, 2, 1, "assistant", "low", 0.1, "x"),
        (1, 3, 1, "assistant", "high", 0.5, "x"),
        (1, 4, 3, "user", "more", None, "x"),
        (1, 5, 2, "user", "tie", 0.4, "x"),
        (1, 5, 2, "user", "tie", 0.4, "x"),
        (2, 1, 9, "user", None, 1.0, "x"),
        (3, 1, 2, "user", "circle", 1.0, "x"),
        (3, 2, 1, "user", "circle", 1.0, "x"),
        (None, 1, None, None, "no tree", 0.0, "x"),
    ]
    out = {(r["tree_id"], r["branch"]): r for r in reply_trees.format_paths(messages(spark, rows), 2).select("*", reply_trees.read_turns(F.col("formatted")).alias("turns")).collect()}
    texts = {k: [t["text"] for t in r["turns"]] for k, r in out.items()}
    assert texts == {(1, 1): ["q", "high", "more"], (1, 2): ["q", "low", "tie"], (2, 1): [""], (None, 1): ["no tree"]}
    best = reply_trees.format_paths(messages(spark, rows))
    assert best.where("branch > 1").count() == 0 and best.count() == 3
    assert reply_trees.format_paths(messages(spark, [])).count() == 0


def test_escapes_are_reversible(spark):
    rng = random.Random(3)
    parts = [*reply_trees.CONTROL, "\\", "<", "[", "|", "\n", "%", "%0A", "x", "<\\|im_end|>\n", "s>", "INST]"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    rows = [(n, 0, role, t) for n, (role, t) in enumerate(zip(rng.choices(["user", "assistant", "a\nb%", "<|im_end|>\n", None], k=400), texts, strict=True))]
    rows += [(n, 1, "assistant", t) for n, t in enumerate(reversed(texts))]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = reply_trees.format_paths(reply_trees.thread(turns))
    read = out.select("tree_id", "formatted", reply_trees.read_turns(F.col("formatted")).alias("turns"), reply_trees.masked_texts(F.col("formatted"), F.col("mask")).alias("loss"))
    want = defaultdict(list)
    for n, _, role, t in rows:
        want[n].append((role or "", t))
    for r in read.collect():
        assert [(t["role"], t["text"]) for t in r["turns"]] == want[r["tree_id"]]
        assert r["loss"] == [t for role, t in want[r["tree_id"]] if role == "assistant"]
        bodies = r["formatted"].replace(reply_trees.BEGIN, "").replace(reply_trees.END, "")
        assert not any(c in bodies for c in ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>"))


def test_long_thread_takes_few_rounds(spark):
    turns = spark.range(0, 700).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    row = reply_trees.format_paths(reply_trees.thread(turns)).select(reply_trees.read_turns(F.col("formatted")).alias("t")).collect()[0]
    assert [t["text"] for t in row["t"]] == [str(n) for n in range(700)]


@pytest.mark.parametrize("name", ["op5_sharding", "op6_content_sort", "op7_chat"])
def test_plans_have_no_python(spark, name):
    text = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for marker in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert marker not in text


def test_op5_contract(spark):
    rows = queries.op5_sharding(spark, "/root/testdata/sf0.001").collect()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and sorted(sizes) == list(range(16))
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
