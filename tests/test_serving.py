"""Serving tables: the same answers as from all facts, out of few files, and made anew only where facts changed."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from railloom.operators.predicates import holds_id
from railloom.plans import analytics, serving
from tests.conftest import rows


def facts(spark, n=1000):
    k = F.col("id")
    return spark.range(n).select(
        (k * 3).alias("fact_id"),
        F.when(k % 7 > 0, (k % 5).cast("string")).alias("operator_id"),
        F.when(k % 11 > 0, (k % 13).cast("int")).alias("route_id"),
        (k % 4).cast("int").alias("gare_depart_id"),
        F.when(k % 3 > 0, (k % 6).cast("int")).alias("gare_arrivee_id"),
        F.when(k % 5 > 0, F.array((k % 3).cast("int"), F.lit(9))).otherwise(F.array().cast("array<int>")).alias("date_ids"),
        F.when(k % 9 > 0, k / 8).alias("emissions_co2"),
        (k % 50).cast("double").alias("average_speed"),
        (k % 60).cast("double").alias("duree_minutes"),
        (k * 2).cast("double").alias("distance_km"),
    )


@pytest.fixture()
def served(spark, zone):
    with zone.draft() as draft:
        serving.refresh(draft, facts(spark), 300)
    return zone


def test_pages_and_lookups_open_only_their_ranges(spark, served):
    release, all_facts = served.release(), rows(facts(spark))
    assert len(release.entry(serving.FACTS).parts) == 10 and serving.total(release) == 1000
    for number, size in ((1, 20), (6, 20), (5, 21), (50, 20), (3, 400), (51, 20), (1, 5000)):
        page = serving.page(release, number, size)
        want = sorted(all_facts)[(number - 1) * size : number * size]
        assert sorted(tuple(r) for r in page.collect()) == want
        if 0 < len(want) < 21:
            assert len(page.inputFiles()) <= 2
    one = serving.fact(release, 1500)
    assert len(one.inputFiles()) == 1 and one.head()["distance_km"] == 1000.0
    assert serving.fact(release, 1501).count() == serving.fact(release, 999_999).count() == 0
    with pytest.raises(ValueError):
        serving.page(release, 0)


def test_dates(spark, served):
    release = served.release()
    for date in (0, 2, 9, 77):
        want = sorted(rows(facts(spark).where(holds_id(F.col("date_ids"), date))))
        assert sorted(rows(serving.facts_on_date(release, date))) == want
        assert [tuple(r) for r in serving.page_on_date(release, date, 3, 30).collect()] == want[60:90]


def test_statistics_equal_those_of_all_facts(spark, served):
    release, all_facts = served.release(), facts(spark)
    operators = spark.createDataFrame([(str(n), f"Rail {n % 3}") for n in range(5)], "agency_id string, agency_name string")
    routes = spark.createDataFrame([(n, f"r{n % 4}") for n in range(13)], "route_id int, route_long_name string")
    gares = spark.createDataFrame([(n, f"g{n}", None, "FR" if n % 2 else "DE") for n in range(6)], "gare_id int, name string, city string, country string")
    pairs = [
        (serving.emissions(release, operators, routes), analytics.emissions(all_facts, operators, routes)),
        (serving.emissions(release, operators, routes, operateur="1"), analytics.emissions(all_facts, operators, routes, operateur="1")),
        (serving.emissions(release, operators, routes, "route"), analytics.emissions(all_facts, operators, routes, "route")),
        (serving.emissions(release, operators, routes, "route", "rail 2"), analytics.emissions(all_facts, operators, routes, "route", "rail 2")),
        (serving.station_traffic(release, gares, "depart", "fr"), analytics.station_traffic(all_facts, gares, "depart", "fr")),
        (serving.station_traffic(release, gares, "arrivee"), analytics.station_traffic(all_facts, gares, "arrivee")),
        (serving.operator_performance(release, operators), analytics.operator_performance(all_facts, operators)),
        (serving.network_summary(release), analytics.network_summary(all_facts)),
    ]
    for got, want in pairs:
        assert got.dtypes == want.dtypes and rows(got) == rows(want) and want.count() > 0


def test_a_change_makes_only_its_ranges_anew(spark, served):
    before = served.release().manifest.tables
    changed = facts(spark).where("fact_id <> 33").withColumn("distance_km", F.when(F.col("fact_id") == 2700, 1.0).otherwise(F.col("distance_km")))
    with served.draft() as draft:
        serving.refresh(draft, changed, 300)
    after = served.release().manifest.tables
    for table in (serving.FACTS, serving.DATES, serving.PARTIALS):
        old, new = ({p.bucket: p.path for p in t[table].parts} for t in (before, after))
        assert {b for b in old if old[b] != new[b]} == {0, 9}
    assert rows(serving.network_summary(served.release())) == rows(analytics.network_summary(changed))
    assert rows(served.read(serving.FACTS)) == rows(changed)
    number = served.release().manifest.number
    with served.draft() as draft:
        serving.refresh(draft, changed, 300)
    assert served.release().manifest.number == number
    with served.draft() as draft:
        serving.refresh(draft, changed.where("fact_id >= 300"), 300)  # a range goes as a whole
    assert serving.total(served.release()) == 900 and rows(serving.network_summary(served.release())) == rows(analytics.network_summary(changed.where("fact_id >= 300")))


def test_no_facts(spark, zone):
    with zone.draft() as draft:
        serving.refresh(draft, facts(spark, 0), 300)
    release = zone.release()
    assert serving.page(release).count() == serving.fact(release, 1).count() == serving.page_on_date(release, 1).count() == 0
    assert rows(serving.network_summary(release)) == [(0, 0.0, 0.0, 0.0, 0.0, 0.0)]


def test_many_small_ranges_share_folders(spark, zone):
    """Folders follow the rows: a narrow range is no folder of its own, and answers are the same."""
    versions = facts(spark), facts(spark).where("fact_id <> 33")
    for version in versions:
        with zone.draft() as draft:
            serving.refresh(draft, version, 6)
    release = zone.release()
    for table in (serving.FACTS, serving.DATES, serving.PARTIALS):
        parts = release.entry(table).parts
        assert len({p.bucket for p in parts}) >= 400 and len({p.path for p in parts}) <= 32
    assert len(release.entry(serving.FACTS).parts) == 500 and serving.total(release) == 999
    want = rows(versions[1])
    for number, size in ((1, 20), (33, 7), (2, 600), (50, 20)):
        page = serving.page(release, number, size)
        assert sorted(tuple(r) for r in page.collect()) == sorted(want)[(number - 1) * size : number * size]
    assert rows(release.buckets(serving.FACTS, [3, 200])) == [r for r in want if r[0] // 6 in (3, 200)]
    assert serving.fact(release, 33).count() == 0 and serving.fact(release, 36).count() == 1
    on = sorted(rows(versions[1].where(holds_id(F.col("date_ids"), 9))))
    assert [tuple(r) for r in serving.page_on_date(release, 9, 3, 30).collect()] == on[60:90]
    assert rows(serving.network_summary(release)) == rows(analytics.network_summary(versions[1]))


def test_ranges_are_dealt_anew_when_many_come(spark, zone):
    for version in (facts(spark, 40), facts(spark, 2000), facts(spark, 1999)):
        with zone.draft() as draft:
            serving.refresh(draft, version, 6)
        release = zone.release()
        assert rows(release.read(serving.FACTS)) == rows(version)
        assert rows(serving.network_summary(release)) == rows(analytics.network_summary(version))
        for table in (serving.FACTS, serving.DATES, serving.PARTIALS):
            assert len({p.path for p in release.entry(table).parts}) <= 32
