"""Steps whose cost per task or per row must not grow with files, blocks or repeated work."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from railloom.operators import dedup, numbering, quality, staging
from railloom.operators.columns import SOURCE_ORDER
from railloom.plans import intermodal, warehouse
from railloom.schemas import WAREHOUSE
from railloom.sources import landed, zones
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()


def connections(spark):
    places = "struct<load:int,file:string,block:bigint,line:bigint,item:int>"
    data = [("A", "B", "x", "1", 0), ("A", "B", "y", "2", 1), ("B", "C", "x", None, 2), (None, "C", "x", "4", 3), ("C", "A", None, "5", 4)]
    made = spark.createDataFrame([(a, b, c, d, (0, "f", 0, n, 0)) for a, b, c, d, n in data], f"`from` string, `to` string, operator string, distance string, {SOURCE_ORDER} {places}")
    return intermodal.numbered_connections(made)


def test_first_lines_are_found_without_a_sort(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("\n" + "\n\n".join(f"{name};{n};x;y" for n in range(50)))
    text = landed._located_text(spark, str(tmp_path), whole=False).where(F.trim("value") != "")
    first = landed._first_lines(text.withColumn("line", F.monotonically_increasing_id()))
    assert "Sort" not in plan(first) and "Window" not in plan(first)
    assert rows(first.select("value", "n")) == [(f"{name};{n};x;y", n + 1) for name in "ab" for n in sorted(range(20), key=lambda n: str(n) + ";")]
    (found,) = landed.dialects(spark, str(tmp_path / "a.csv"))
    assert found.lines == 20 and found.header == "a;0;x;y" and found.agreeing[";"] == 20


def test_pages_find_their_schema_in_many_tasks(spark, tmp_path):
    for n in range(40):
        (tmp_path / f"{n}.json").write_text('{"total_count": 40,\n "results": [{"a": %d}]}' % n)
    context = spark.sparkContext
    context.setJobGroup("pages-schema", "")
    pages = landed.read_pages(spark, str(tmp_path))
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("pages-schema") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) > 1
    assert rows(landed.complete_records(pages)) == sorted(((n,) for n in range(40)), key=repr)


def test_an_entry_is_parsed_once(spark, tmp_path, monkeypatch):
    (tmp_path / "t.json").write_text('{"a": {"k": "1"}, "b": null, "c": {}}\n{"broken": \n\n{}\n')
    plans, stage = [], landed.stage
    monkeypatch.setattr(landed, "stage", lambda df, label: plans.append(df) or stage(df, label))
    found = landed.keyed_rows(spark, str(tmp_path / "t.json"), per_line=True)
    assert plans[-1]._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert sorted((r["item"], r["key"], r["row"], r["text"]) for r in found.where("row IS NOT NULL").collect()) == [(0, "a", {"k": "1"}, None), (2, "c", {}, None)]
    assert [(r["item"], r["key"], r["text"]) for r in found.where("row IS NULL").collect()] == [(0, None, '{"broken": ')]


def test_each_end_is_reduced_on_its_own(spark, monkeypatch):
    raw, sizes, keep_first = connections(spark), [], dedup.keep_first
    monkeypatch.setattr(dedup, "keep_first", lambda df, *a: sizes.append(df.count()) or keep_first(df, *a))
    found = intermodal.stations(raw)
    assert [tuple(r) for r in found.select("gare_id", "name").orderBy("gare_id").collect()] == [(1, "A"), (2, "B"), (3, "C")]
    assert len(sizes) == 3 and max(sizes[:2]) <= raw.count()  # never both ends of all rows


def test_a_unique_key_is_checked_without_a_sort_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    checked = quality.unique_or_fail(df, ["k"])
    assert "SortAggregate" not in checked._jdf.queryExecution().executedPlan().toString()
    assert rows(checked) == rows(df)
    quality.fail_if_repeated(df, ["k"])
    for repeated in (df.unionAll(df.where("k = 2")), df.unionAll(df.where("k IS NULL"))):
        with pytest.raises(Exception, match="repeated key"):
            quality.unique_or_fail(repeated, ["k"]).collect()
        with pytest.raises(Exception, match="repeated key"):
            quality.fail_if_repeated(repeated, ["k"])


def test_facts_are_numbered_before_the_lookups(spark, monkeypatch):
    raw, seen, by_place = connections(spark), [], numbering.ids_by_place
    monkeypatch.setattr(numbering, "ids_by_place", lambda df, *a, **b: seen.append(df.columns) or by_place(df, *a, **b))
    routes = intermodal.routes(raw)
    trains = intermodal.trains(raw, routes)
    facts = intermodal.facts(raw, intermodal.stations(raw), trains)
    assert ["origin", "destination", "operator", intermodal.ROW] in seen
    assert [tuple(r) for r in facts.select("fact_id", "distance_km", "operator_id").orderBy("fact_id").collect()] == [
        (1, 2.0, "OP_" + "9dd4e461"), (2, 2.0, "OP_" + "41529076"), (3, None, "OP_" + "9dd4e461"), (4, 5.0, None)
    ]


def test_changes_are_found_once(spark, zone, monkeypatch):
    first = spark.createDataFrame([("1", "a"), ("2", "b")], "agency_id string, agency_name string")
    second = spark.createDataFrame([("1", "a"), ("2", "c"), ("3", "d")], "agency_id string, agency_name string")
    calls, changes = [], zones.changes
    monkeypatch.setattr(zones, "changes", lambda *a: calls.append(a) or changes(*a))
    for load in (first, second):
        with zone.draft() as draft:
            warehouse.WarehouseLoad(zone.release(), draft)._merge("dim_operateur", load)
    assert not calls
    assert rows(zone.read("dim_operateur").select("agency_id", "agency_name")) == [("1", "a"), ("2", "c"), ("3", "d")]


def test_numbered_rows_are_a_plain_scan_in_order_of_their_position(spark):
    data = [(None, "n")] + [((k % 7, None if k % 3 else k, str(k)), f"v{k}") for k in range(60)]
    df = spark.createDataFrame(data, f"{SOURCE_ORDER} struct<a:int,b:int,c:string>, v string").repartition(5)
    numbered = numbering.source_ids(df, "id", keep=False)
    assert numbered.columns == ["id", "v"] and "Join" not in plan(numbered)
    wanted = [r["v"] for r in df.orderBy(SOURCE_ORDER).collect()]
    assert [(r["id"], r["v"]) for r in numbered.orderBy("id").collect()] == [(i + 1, v) for i, v in enumerate(wanted)]
    kept = numbering.source_ids(df, "id")
    assert kept.columns == ["id", SOURCE_ORDER, "v"] and [r["v"] for r in kept.orderBy("id").collect()] == wanted
    placed = df.select("v", (F.length("v") * 1000 + F.hash("v") % 500).alias("p"))
    assert "Join" not in plan(numbering.ids_by_place(placed, "p", 10_000, "id"))


def test_trains_of_a_connection_are_found_without_a_sort_and_without_its_position(spark):
    raw = connections(spark)
    assert dict(raw.dtypes)[SOURCE_ORDER] == "bigint"  # the number, and not the struct beside it
    found = intermodal.trains_unchecked(raw, intermodal.routes(raw))
    assert "Window" not in plan(found)
    assert rows(found.select("origin", "destination", "distance", intermodal.ROW, SOURCE_ORDER)) == [
        ("A", "B", 1.0, 1, 1), ("A", "B", 2.0, 2, 2), ("B", "C", None, 3, 3), ("C", "A", 5.0, 5, 5)
    ]


def test_an_order_that_is_total_needs_no_other_columns(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z")], "k string, n int, v string")
    first = dedup.keep_first(df, ["k"], [F.col("n")], True)
    assert rows(first) == rows(dedup.keep_first(df, ["k"], [F.col("n")])) == [("a", 1, "y"), (None, 3, "z")]
    order = [line for line in plan(first).splitlines() if "row_number()" in line][0]
    assert "v#" not in order[order.index("windowspecdefinition"):]


def test_shuffles_of_a_staged_table_are_dropped_when_it_is_written(spark):
    seen, before = [], spark.conf.get(staging.CLEANUP, None)
    with staging.shuffles_dropped(spark), staging.shuffles_dropped(spark):
        seen.append(spark.conf.get(staging.CLEANUP))
    assert seen == ["true"] and spark.conf.get(staging.CLEANUP, None) == before
    root = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
    kept = {f.name for f in root.glob("*/shuffle_*.data")}
    staged = staging.stage(spark.range(1000).repartition(3, "id"), "probe")
    for _ in range(100):
        left = {f.name for f in root.glob("*/shuffle_*.data")} - kept
        if not left:
            break
        time.sleep(0.1)
    assert not left and staged.count() == 1000


def facts_of(spark, trains):
    """Facts that differ in their train and their dates only."""
    fields = WAREHOUSE[warehouse.FACT].fields
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields if f.name != "fact_id")
    blank = {f.name: None for f in fields if f.name != "fact_id"}
    data = [tuple((blank | {"train_id": t, "distance_km": 1.0, "date_ids": dates}).values()) for t, dates in trains]
    return spark.createDataFrame(data, kinds)


def test_facts_of_two_runs_are_compared_once(spark, zone, monkeypatch):
    night = [("A", [1]), ("B", [1]), ("B", [2]), ("C", [1])]
    later = [("A", [1, 3]), ("B", [1]), ("D", [4])]

    def load(trains):
        with zone.draft() as draft:
            run = warehouse.WarehouseLoad(zone.release(), draft)
            run._publish_facts(warehouse.NIGHT_FACTS, facts_of(spark, trains))
            run._publish_facts(warehouse.INTERMODAL_FACTS, facts_of(spark, [("X", [1]), ("X", [1])]))
            run.serving_tables()
        return {(r["train_id"], tuple(r["date_ids"])): r["fact_id"] for r in zone.read(warehouse.FACT).collect()}

    first = load(night)
    assert sorted(r["fact_id"] for r in zone.read(warehouse.FACT).collect()) == [1, 2, 3, 4, 5, 6]
    calls, row_changes = [], zones.row_changes
    monkeypatch.setattr(zones, "row_changes", lambda *a: calls.append(a) or row_changes(*a))
    second = load(later)
    assert not calls
    assert second == {("A", (1, 3)): first["A", (1,)], ("B", (1,)): first["B", (1,)], ("D", (4,)): 7, ("X", (1,)): second["X", (1,)]}
    assert rows(zone.read("serving_facts")) == rows(zone.read(warehouse.FACT)) and zone.read(warehouse.FACT).count() == 5
    dates = {(r["date_id"], tuple(r["fact_ids"])) for r in zone.read("serving_dates").collect()}
    a, b = first["A", (1,)], first["B", (1,)]
    assert dates == {(1, tuple(sorted((a, b, 5, 6)))), (3, (a,)), (4, (7,))}
    number = zone.release().manifest.tables
    load(later)
    assert zone.release().manifest.tables == number  # nothing new, nothing written


def test_a_repeated_grain_that_shares_its_short_hash_only_is_a_single_fact(spark, monkeypatch):
    monkeypatch.setattr(warehouse.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    found = warehouse.numbered_in_grain(facts_of(spark, [("A", [1]), ("B", [2]), ("B", [1])]))
    assert rows(found.select("train_id", "date_ids", "occurrence")) == [("A", [1], 0), ("B", [1], 0), ("B", [2], 1)]


def test_new_rows_are_added_without_a_look_at_the_others(spark, zone, monkeypatch):
    keys, joined, upsert = ["agency_id"], [], zones.merge_upsert
    monkeypatch.setattr(zones, "merge_upsert", lambda old, new, *a, **b: joined.append(rows(new)) or upsert(old, new, *a, **b))
    loads = [[("1", "a"), ("2", "b")], [("1", "a"), ("3", "c")], [("1", "x"), ("4", "d")]]
    for load in loads:
        with zone.draft() as draft:
            warehouse.WarehouseLoad(zone.release(), draft)._merge("dim_operateur", spark.createDataFrame(load, "agency_id string, agency_name string"))
    assert joined == [[("1", "x")]]
    assert rows(zone.read("dim_operateur").select(*keys, "agency_name")) == [("1", "x"), ("2", "b"), ("3", "c"), ("4", "d")]


def test_a_repeated_natural_key_fails_after_the_lookup_too(spark):
    known = spark.createDataFrame([(1, "a")], "id int, k string")
    for repeated in ([("b",), ("b",)], [("a",), ("a",)], [(None,), (None,)]):
        with pytest.raises(Exception, match="repeated key"):
            numbering.keyed_ids(spark.createDataFrame(repeated, "k string"), known, ["k"], "id").collect()


def test_a_full_bucket_is_written_by_many_tasks(spark, zone, monkeypatch):
    monkeypatch.setattr(zones, "BUCKET_ROWS", 50)
    zone.publish("t", spark.range(100).toDF("k"), ["k"])
    entry = zone.release().entry("t")
    files = [f for p in entry.parts for f in Path(p.path.removeprefix("file:")).glob("*.parquet")]
    assert entry.buckets == 2 and len(entry.parts) == 2 and len(files) > 4
    assert rows(zone.release().buckets("t", [0, 1])) == [(k,) for k in sorted(range(100), key=lambda k: repr((k,)))]
