"""Operators on small frames, including hot keys, NULL keys and re-partitioned input."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from railloom.operators import (
    columns, dedup, links, merge, numbering, paging, predicates, quality, reshape, staging,
)
from tests.conftest import rows, values


def skewed(spark, n=3000, seed=7):
    """One key holds a third of all rows."""
    rnd = random.Random(seed)
    data = [("hot" if i % 3 == 0 else f"k{rnd.randrange(50)}", rnd.randrange(1000), i) for i in range(n)]
    return data, spark.createDataFrame(data, "k string, v int, i int")


def test_select_present_and_names(spark):
    df = spark.createDataFrame([(1, "x ", 2)], "` A b` int, c string, d int")
    assert columns.snake_names(df).columns == ["a_b", "c", "d"]
    assert columns.trimmed_names(df).columns == ["A b", "c", "d"]
    assert columns.select_present(df, ["d", "zz", "c"]).columns == ["d", "c"]
    assert rows(columns.strip_strings(df)) == [(1, "x", 2)]
    assert rows(df.select(columns.optional(df, "zz", "int", 5))) == [(5,)]


def test_require_ignores_unknown_columns(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    assert rows(predicates.require(df, ["b", "zz"])) == [(2, 3)]
    assert predicates.require(df, ["zz"]).count() == 2
    assert rows(predicates.require_all(df)) == [(2, 3)]


def test_drop_empty_rows(spark):
    df = spark.createDataFrame(
        [(1, {"a": "", "": "x"}), (2, {"a": "v", "b": "", "c": None})], "i int, row map<string,string>"
    )
    assert rows(predicates.drop_empty_rows(df, "row")) == [(2, {"a": "v"})]


def test_many_mandatory_columns_do_not_blow_up_the_plan(spark):
    names = [f"c{i}" for i in range(40)]
    df = spark.range(3).select(*[F.col("id").cast("string").alias(c) for c in names])
    kept = predicates.require_all(df).select(*[F.trim(c).alias(f"t_{c}") for c in names])
    again = kept.select(*[F.col(f"t_{c}").alias(f"u_{c}") for c in names])
    assert again.count() == 3


def test_keep_rules(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "x string, y int")
    assert rows(predicates.keep_rules(df, [{"x": "a", "y": 1}, {"x": "b"}])) == [("a", 1), ("b", 1)]
    assert predicates.keep_rules(df, None).count() == 3
    with pytest.raises(ValueError):
        predicates.keep_rules(df, [{"zz": 1}])


def test_differs_keeps_null(spark):
    df = spark.createDataFrame([(" = ",), ("x",), (None,)], "s string")
    assert values(df.where(predicates.differs(F.col("s"), " = ")), "s") == ["x", None]


def test_absent_filters_do_not_filter(spark):
    df = spark.createDataFrame([(1, "Paris")], "a int, s string")
    kept = predicates.where_all(
        df, predicates.contains(F.col("s"), ""), predicates.contains(F.col("s"), None),
        predicates.equals_id(F.col("a"), 0), predicates.equals(F.col("a"), None), predicates.at_least(F.col("a"), None),
    )
    assert kept.count() == 1
    assert predicates.where_all(df, predicates.at_most(F.col("a"), 0)).count() == 0
    assert predicates.where_all(df, predicates.contains(F.col("s"), "pAr")).count() == 1


def test_keep_first_against_brute_force_on_a_hot_key(spark):
    data, df = skewed(spark)
    expected = {}
    for k, v, i in sorted(data, key=lambda r: (r[1], r[2])):
        expected.setdefault(k, (k, v, i))
    for n in (1, 7, 16):
        got = rows(dedup.keep_first(df.repartition(n, "i"), ["k"], [F.col("v")]))
        assert got == sorted(expected.values(), key=repr)


def test_keep_first_treats_null_as_a_key(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, v int")
    assert rows(dedup.keep_first(df, ["k"], [F.col("v")])) == [("a", 3), (None, 1)]


def test_latest_puts_missing_periods_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 2019, 2), ("a", 2020, 3), ("b", None, 4)], "k string, p int, v int")
    assert rows(dedup.latest_per_key(df, ["k"], F.col("p"))) == [("a", 2020, 3), ("b", None, 4)]


def test_order_of_dedup_and_filter_matters(spark):
    df = spark.createDataFrame([(1, 0, "bad"), (1, 1, "good"), (2, 0, "good")], "k int, i int, s string")
    good = F.col("s") == "good"
    assert rows(dedup.filter_then_dedup(df, good, ["k"], [F.col("i")])) == [(1, 1, "good"), (2, 0, "good")]
    assert rows(dedup.dedup_then_filter(df, good, ["k"], [F.col("i")])) == [(2, 0, "good")]


def test_dense_ids_equal_a_global_row_number(spark):
    rnd = random.Random(3)
    keys = [f"{rnd.randrange(10**9):09d}" for _ in range(2500)] + [None]
    keys = list(dict.fromkeys(keys))
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    expected = {k: i + 5 for i, k in enumerate(sorted(keys, key=lambda k: (k is not None, k)))}
    for n in (1, 9):
        got = {r["k"]: r["id"] for r in numbering.dense_ids(df.repartition(n), ["k"], "id", 5).collect()}
        assert got == expected


def test_dense_ids_of_nothing(spark):
    assert numbering.dense_ids(spark.createDataFrame([], "k string"), ["k"], "id").count() == 0


def test_keyed_ids_survive_a_reload(spark):
    first = spark.createDataFrame([("a", None), ("b", "x"), ("c", "x")], "n string, c string")
    known = numbering.keyed_ids(first, None, ["n", "c"], "id")
    again = numbering.keyed_ids(first, known, ["n", "c"], "id")
    assert rows(again.select("n", "c", "id")) == rows(known.select("n", "c", "id"))
    more = spark.createDataFrame([("0", "x"), ("a", None)], "n string, c string")
    got = {r["n"]: r["id"] for r in numbering.keyed_ids(more, known, ["n", "c"], "id").collect()}
    assert got == {"0": 4, "a": 1}


def test_upsert_semantics(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 30)], "k int, s string, v int")
    new = spark.createDataFrame([(2, None), (3, 33), (None, 99)], "k int, v int")
    merged = merge.merge_upsert(old, new, ["k"])
    assert rows(merged) == sorted([(1, "a", 10), (2, "b", None), (3, None, 33), (None, "n", 99)], key=repr)
    assert rows(merge.merge_upsert(merged, new, ["k"])) == rows(merged)


def test_upsert_with_only_keys_inserts_once(spark):
    old = spark.createDataFrame([(1, None)], "a int, b string")
    new = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(merge.merge_upsert(old, new, ["a", "b"])) == [(1, None), (2, "x")]


def test_upsert_rejects_unknown_columns(spark):
    old = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        merge.merge_upsert(old, spark.createDataFrame([(1, 2)], "a int, z int"), ["a"])


def test_cube_header():
    assert reshape.parse_cube_header("a, b\\TIME_PERIOD ") == (["a", "b"], "TIME_PERIOD")
    assert reshape.parse_cube_header("a\\") == (["a"], "period")
    with pytest.raises(reshape.HeaderError):
        reshape.parse_cube_header("a,b")


def test_split_key_pads_missing_parts(spark):
    df = spark.createDataFrame([("A,B", 1), ("C", 2)], "k string, v int")
    assert rows(reshape.split_key(df, "k", ["x", "y"])) == [("A", "B", 1), ("C", None, 2)]
    assert reshape.max_parts(df, "k").head()[0] == 2


def test_stack_groups_and_union_distinct(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    stacked = reshape.stack_groups(df, [{"v": F.col("a")}, {"v": F.col("b")}])
    assert rows(stacked) == [(1,), (1,), (1,), (2,)]
    assert rows(reshape.union_distinct(df.select(F.col("a").alias("v")), df.select(F.col("b").alias("v")))) == [(1,), (2,)]


def test_union_by_priority(spark):
    a = spark.createDataFrame([("x", None, 1)], "n string, c string, v int")
    b = spark.createDataFrame([("x", None, 2), ("y", "F", 3)], "n string, c string, v int")
    assert rows(reshape.union_by_priority([a, b], ["n", "c"])) == [("x", None, 1), ("y", "F", 3)]


def test_fold_ids_keeps_null_grains_and_empty_sets(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 3), ("b", None), (None, 2)], "g string, i int")
    assert rows(links.fold_ids(df, ["g"], "i")) == [("a", [1, 3]), ("b", []), (None, [2])]


def test_valid_only_and_explode_link(spark):
    df = spark.createDataFrame([(1, [1, 2]), (None, [3])], "k int, ids array<int>")
    parent = spark.createDataFrame([(1, "p")], "k int, s string")
    assert rows(links.valid_only(df, parent, "k")) == [(1, [1, 2])]
    dates = spark.createDataFrame([(1, "one"), (3, "three")], "d int, s string")
    assert rows(links.explode_link(df, "ids", dates, "d")) == [(1, 1, "one"), (3, None, "three")]


def test_pages_tile_the_listing(spark):
    df = spark.createDataFrame([(i,) for i in range(95)], "k int").repartition(5)
    pages = [sorted(values(paging.take_page(df, ["k"], p, 20), "k")) for p in range(1, 7)]
    assert pages == [list(range(i, min(i + 20, 95))) for i in range(0, 120, 20)]
    with pytest.raises(ValueError):
        paging.take_page(df, ["k"], 0)


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, [1, 2]), (1, [2, 1]), (None, None)], "k int, ids array<int>")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert quality.unsorted_links(df, "ids").count() == 2
    parent = spark.createDataFrame([(2,)], "p int")
    assert rows(quality.orphans(df, "k", parent, "p")) == [(1,)]


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert staging.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
