"""Physical plans: what is shuffled, what is read, and how a hot key is handled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from railloom.operators import dedup, links
from railloom.plans import analytics, listings
from workload import registered, views
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return views.Tables(spark, SF)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_no_python_no_cartesian_product_no_single_task_window(spark, name):
    text = plan(registered.QUERIES[name](spark, SF))
    for marker in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert marker not in text
    for line in text.splitlines():
        if "Window [" in line:
            assert "], [" in line.split("windowspecdefinition")[-1], line


def test_statistics_aggregate_before_the_join(tables):
    text = plan(analytics.emissions(views.fact(tables), views.operator(tables), views.route(tables)))
    join = text.index("Join")
    assert "partial_sum" in text[join:], "facts are reduced below the join"
    assert "l_suppkey" in text and "l_shipdate" not in text and "l_tax" not in text


def test_keep_first_limits_groups_before_the_shuffle(tables):
    df = dedup.keep_first(tables.lineitem.select("l_suppkey", "l_orderkey"), ["l_suppkey"], [F.col("l_orderkey")])
    text = plan(df)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_filters_and_columns_reach_the_scan(tables):
    found = listings.journeys_matching(views.star(tables), gare_depart_id=3)
    text = plan(found.select("fact_id"))
    assert "PushedFilters: [IsNotNull(c_nationkey), EqualTo(c_nationkey,3)" in text
    detail = plan(listings.station(views.station(tables), 7))
    assert "EqualTo(n_nationkey,7)" in detail
    cut = plan(listings.list_stations(views.station(tables)).data)
    assert "TakeOrderedAndProject" in cut


@pytest.mark.parametrize("page_size", [20, 5000])
def test_a_page_is_cut_before_its_dimensions_are_joined(tables, page_size):
    text = plan(listings.list_journeys(views.star(tables), page_size=page_size).data)
    assert "lineitem" not in text and "page-" in text and text.count("LeftSemi") >= 5


def test_unneeded_dimensions_are_not_read(tables):
    text = plan(listings.journeys_matching(views.star(tables), operateur="x"))
    assert "supplier.parquet" in text and "nation.parquet" not in text and "part.parquet" not in text


def test_a_hot_key_in_a_lookup_is_split(spark):
    """A third of the facts has one key and the dimension is too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ids = spark.range(0, 120_000, 1, 8)
        facts = ids.select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
        dim = spark.range(-1, 4000).select(F.col("id").alias("k"))
        kept = links.valid_only(facts, dim, "k")
        assert kept.count() == facts.where("k < 4000").count()
        joined = facts.join(dim.withColumn("x", F.col("k") * 2), "k", "left")
        joined.write.format("noop").mode("overwrite").save()
        assert joined.agg(F.sum("x")).head()[0] == facts.where("k < 4000").agg(F.sum(F.col("k") * 2)).head()[0]
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_statistics_do_not_depend_on_the_partitioning(spark, tables):
    facts = views.fact(tables)
    hot = facts.withColumn("operator_id", F.when(F.col("train_id") % 3 == 0, 1).otherwise(F.col("operator_id")))
    one = rows(analytics.operator_performance(hot.coalesce(1), views.operator(tables)))
    many = rows(analytics.operator_performance(hot.repartition(13), views.operator(tables)))
    assert one == many and len(one) > 1
