"""Landed files to clean zone to warehouse, run twice, against tables worked out by hand."""

from __future__ import annotations

import datetime as dt
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from railloom.operators import merge, numbering, quality
from railloom.plans import analytics, ingest, listings, warehouse
from railloom.schemas import KEYS, SURROGATES, WAREHOUSE
from railloom.sources.zones import Draft, Zone
from tests.conftest import rows, values
from tests.landing import write_landing


def operator_id(name):
    return "OP_" + hashlib.md5(name.encode()).hexdigest()[:8]


def contents(zone):
    return {t: rows(zone.read(t)) for t in WAREHOUSE}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("golden")
    landing = ingest.Landing(write_landing(base / "landing"))
    clean = Zone(spark, "golden_clean", str(base / "clean")).create()
    target = Zone(spark, "golden_warehouse", str(base / "warehouse")).create()
    outcome = ingest.ingest(spark, landing, clean)
    warehouse.refresh(clean, target)
    first = contents(target)
    ingest.ingest(spark, landing, clean)
    warehouse.refresh(clean, target)
    return outcome, clean, target, first


def test_every_source_is_loaded_and_failures_are_isolated(loaded):
    outcome, clean, _, _ = loaded
    assert outcome.pop("passenger_traffic_train_speed") == "empty"
    assert set(outcome.values()) == {"loaded"} and len(outcome) == 3 + 13 + 6 + 2 + 2
    assert clean.read("trips").where("trip_id = 'T1'").count() == 1
    assert len(clean.tables()) == len(outcome)


def test_a_missing_file_is_skipped(spark, tmp_path, zone):
    root = write_landing(tmp_path / "partial")
    (tmp_path / "partial" / "agencies.json").unlink()
    (tmp_path / "partial" / "intermodal.csv").write_text("a;b\n1;2\n")
    outcome = ingest.ingest(spark, ingest.Landing(root), zone)
    assert outcome["agencies"] == "skipped" and {outcome[t] for t in ingest.SNAPSHOT_TABLES} == {"skipped"}
    assert outcome["trips"] == "loaded" and outcome["sncf_emissions"] == "loaded"


def test_damage_inside_a_task_and_short_paging_are_skipped(spark, tmp_path, zone):
    root = write_landing(tmp_path / "damaged")
    body = gzip.compress((tmp_path / "damaged" / "co2_emissions.csv").read_bytes() * 2000)
    (tmp_path / "damaged" / "co2.csv.gz").write_bytes(body[: len(body) // 2])
    (tmp_path / "damaged" / "sncf_emissions" / "1.json").unlink()
    outcome = ingest.ingest(spark, ingest.Landing(root, files={"co2_emissions.csv": "co2.csv.gz"}), zone)
    assert outcome["co2_emissions"] == "skipped" and outcome["sncf_emissions"] == "skipped"
    assert sorted(t for t, o in outcome.items() if o == "skipped") == ["co2_emissions", "sncf_emissions"]
    assert not zone.exists("co2_emissions") and not zone.exists("sncf_emissions")


def test_a_changed_intermodal_file_replaces_the_one_before(spark, tmp_path):
    root = write_landing(tmp_path / "landing")
    clean = Zone(spark, "changed_clean", str(tmp_path / "clean")).create()
    target = Zone(spark, "changed_warehouse", str(tmp_path / "warehouse")).create()
    load = ingest.Landing(root)
    ingest.ingest(spark, load, clean)
    warehouse.refresh(clean, target)

    def facts():
        names = target.read("dim_gare").select("gare_id", "name")
        df = target.read(warehouse.INTERMODAL_FACTS)
        for side in ("depart", "arrivee"):
            df = df.join(names.toDF(f"gare_{side}_id", side), f"gare_{side}_id", "left")
        routes = target.read("dim_route").select("route_id", "route_long_name")
        return df.join(routes, "route_id", "left").select("fact_id", "depart", "arrivee", "route_long_name", "distance_km")

    first = rows(facts())
    file = tmp_path / "landing" / "intermodal.csv"
    head, *lines = file.read_text(encoding="utf-8").splitlines(keepends=True)
    file.write_text(head + "Newtown;Oldtown;RailCo;50;1, 2;3, 4;FR;FR\n" + "".join(lines), encoding="utf-8")
    outcome = ingest.ingest(spark, load, clean)
    assert {outcome[t] for t in ingest.SNAPSHOT_TABLES} == {"loaded"}
    warehouse.refresh(clean, target)
    second = rows(facts())
    assert [r[1:] for r in second if r not in first] == [("Newtown", "Oldtown", "Newtown - Oldtown", 50.0)]
    assert [r for r in first if r not in second] == [] and len({r[0] for r in second}) == len(second)
    everything = contents(target)
    warehouse.refresh(clean, target)
    assert contents(target) == everything
    file.write_text(head + "".join(lines), encoding="utf-8")
    ingest.ingest(spark, load, clean)
    warehouse.refresh(clean, target)
    assert rows(facts()) == first


def test_a_repeated_key_fails_the_merge(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(None, "x"), (None, "y")], "k int, v string")
    with pytest.raises(Exception, match="repeated key"):
        merge.merge_upsert(old, twice, ["k"]).collect()
    with pytest.raises(Exception, match="repeated key"):
        numbering.keyed_ids(twice, None, ["k"], "id").collect()


def test_running_again_changes_nothing(loaded):
    _, _, target, first = loaded
    assert contents(target) == first


def test_schemas_are_fixed(loaded):
    _, _, target, _ = loaded
    for table, schema in WAREHOUSE.items():
        got = target.read(table).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schema]


def test_keys_and_references_hold(loaded):
    _, _, target, _ = loaded
    t = {name: target.read(name) for name in WAREHOUSE}
    for table, keys in KEYS.items():
        assert quality.duplicate_keys(t[table], keys).count() == 0
    for table, key in [*SURROGATES.items(), ("fact_trajet_train", "fact_id")]:
        assert quality.duplicate_keys(t[table], [key]).count() == 0
    for child, fk, parent, pk in [
        ("dim_route", "agency_id", "dim_operateur", "agency_id"),
        ("dim_train", "route_id", "dim_route", "route_id"),
        ("fact_trajet_train", "train_id", "dim_train", "trip_id"),
        ("fact_trajet_train", "route_id", "dim_route", "route_id"),
        ("fact_trajet_train", "operator_id", "dim_operateur", "agency_id"),
        ("fact_trajet_train", "gare_depart_id", "dim_gare", "gare_id"),
        ("fact_trajet_train", "gare_arrivee_id", "dim_gare", "gare_id"),
    ]:
        assert quality.orphans(t[child], fk, t[parent], pk).count() == 0
    assert quality.unsorted_links(t["fact_trajet_train"], "date_ids").count() == 0
    dates = t["fact_trajet_train"].select(F.explode("date_ids").alias("d"))
    assert quality.orphans(dates, "d", t["dim_date"], "date_id").count() == 0


def test_operators(loaded):
    _, _, target, _ = loaded
    got = rows(target.read("dim_operateur").select("agency_id", "agency_name", "agency_url", "agency_lang"))
    assert got == sorted([
        ("A1", "Nightly", "u1", None), ("A2", "Sleeper", None, None),
        (operator_id("RailCo"), "RailCo", None, None), (operator_id("RailTwo"), "RailTwo", None, None),
    ], key=repr)


def test_routes(loaded):
    _, _, target, _ = loaded
    got = rows(target.read("dim_route"))
    assert got == [
        (10, "A1", "Alpha - Beta", "Alphaville", "Betatown", "FR, DE"),
        (11, "A2", "Beta - Gamma", "Betatown", "Gammaburg", "DE"),
        # the route without an operator and the one from a blank station are not kept
        (12, operator_id("RailCo"), "Alphaville - Betatown", "Alphaville", "Betatown", "FR"),
    ]


def test_trains(loaded):
    _, _, target, _ = loaded
    night = target.read("dim_train").where("is_night_train")
    assert rows(night) == [
        ("T1", 10, "Betatown", "Alphaville", "23:10:00", dt.timedelta(hours=25, minutes=10), 1000.0, True),
        ("T2", 11, "Nowhere", "Betatown", None, None, None, True),
        ("T4", 10, "x", "x", None, None, None, True),
    ]
    day = target.read("dim_train").where("not is_night_train").select("route_id", "trip_headsign", "distance")
    assert rows(day) == [(12, "Betatown", 512.3), (12, "Betatown", 600.0)]


def test_stations_keep_the_curated_source_then_take_the_intermodal_update(loaded):
    _, _, target, _ = loaded
    got = rows(target.read("dim_gare").drop("gare_id"))
    assert got == sorted([
        ("Alphaville", None, "FR", 48.1, 2.3, False),
        ("Betatown", None, "DE", None, None, False),
        ("Gammaburg", None, "AT", 50.1, 8.6, False),
    ], key=repr)


def test_stations_of_the_first_load(loaded):
    _, clean, _, _ = loaded
    got = rows(warehouse.dim_gare(clean.read("gares_europeennes"), clean.read("stops")))
    assert got == [("Alphaville", "Alphaville", "FR", 48.1, 2.3, True), ("Betatown", "Betatown", "DE", 50.0, 8.0, False)]


def test_dates(loaded):
    _, _, target, _ = loaded
    d = dt.date
    got = rows(target.read("dim_date").select("start_date", "end_date", "monday", "sunday"))
    assert got == sorted([
        (d(2024, 1, 1), d(2024, 6, 30), True, False), (d(2024, 7, 1), d(2024, 12, 31), False, True),
        (d(2023, 1, 1), d(2023, 6, 30), True, False), (d(2024, 1, 1), d(2024, 6, 30), False, True),
        (d(2023, 8, 1), d(2023, 12, 31), True, True),
    ], key=repr)


def test_energy_keeps_the_first_row_in_file_order(loaded):
    _, _, target, _ = loaded
    got = rows(target.read("dim_energie").drop("energy_id"))
    assert got == sorted([
        ("FR", "LOC", "ELC", 2018, 123.4), ("FR", "LOC", "ELC", 2019, 7.0), ("DE", "LOC", "DIE", 2019, 45.0),
    ], key=repr)


def test_facts(loaded):
    _, _, target, _ = loaded
    gares = {(r["name"], r["country"]): r["gare_id"] for r in target.read("dim_gare").collect()}
    dates = {
        (str(r["start_date"]), r["monday"]): r["date_id"] for r in target.read("dim_date").collect()
    }
    night = rows(target.read("fact_trajet_train").where("is_night_train").drop("fact_id"))
    both = sorted([dates["2024-01-01", True], dates["2024-01-01", False]])
    alpha, beta = gares["Alphaville", "FR"], gares["Betatown", "DE"]
    assert night == [
        ("T1", 10, "A1", alpha, beta, both, 1000.0, 1510.0, 0.5, 11.0, 80.5, True),
        ("T2", 11, "A2", beta, None, both, None, None, None, 77.0, None, True),
    ]
    day = target.read("fact_trajet_train").where("not is_night_train")
    # three connection rows of the one valid pair; the last train of the pair gives the measures
    assert day.count() == 3
    assert set(values(day, "distance_km")) == {600.0}
    assert {round(v, 6) for v in values(day, "emissions_co2")} == {8.4}
    assert set(values(day, "gare_depart_id")) == {alpha} and set(values(day, "gare_arrivee_id")) == {beta}
    assert {tuple(v) for v in values(day, "date_ids")} == {(dates["2023-08-01", True],)}
    assert sorted(values(day, "operator_id")) == sorted([operator_id("RailCo")] * 2 + [operator_id("RailTwo")])


def star(target):
    return listings.Star(
        *[target.read(t) for t in ("fact_trajet_train", "dim_gare", "dim_train", "dim_operateur", "dim_route", "dim_date")]
    )


def test_journey_listing_and_detail(loaded):
    _, _, target, _ = loaded
    page = listings.list_journeys(star(target), page_size=2, pays_depart="fr")
    assert page.total == 4
    got = page.data.collect()
    assert len(got) == 2 and got[0]["fact_id"] < got[1]["fact_id"]
    nothing = listings.list_journeys(star(target), pays_depart="fr", operateur="sleeper")
    assert nothing.total == 0 and nothing.data.count() == 0
    by_name = listings.list_journeys(star(target), operateur="SLEEP").data.head()
    assert by_name["operateur"]["agency_name"] == "Sleeper" and by_name["operateur"]["agency_country"] is None
    assert by_name["gare_arrivee"] is None and by_name["train"]["destination"] == "Gammaburg"
    detail = listings.journey_detail(star(target), by_name["fact_id"]).head()
    assert detail["train"]["trip_id"] == "T2"
    assert listings.journey_dates(star(target), by_name["fact_id"]).count() == 2
    assert listings.journey_detail(star(target), 999_999).count() == 0


def test_pages_do_not_depend_on_their_size(loaded):
    _, _, target, _ = loaded
    whole = rows(listings.list_journeys(star(target), page_size=5000).data)
    pages = [r for n in range(1, 8) for r in rows(listings.list_journeys(star(target), page=n, page_size=1).data)]
    assert sorted(pages, key=repr) == whole and len(whole) > 3


def test_other_listings(loaded):
    _, _, target, _ = loaded
    s = star(target)
    assert values(listings.list_stations(s.dim_gare, country="de").data, "name") == ["Betatown"]
    assert listings.list_stations(s.dim_gare, is_main_station=True).total == 0
    assert values(listings.list_trains(s.dim_train, s.dim_route, destination="gamma").data, "trip_id") == ["T2"]
    assert values(listings.list_trains(s.dim_train, s.dim_route, origin="alpha").data, "duration") == ["1 day, 1:10:00"]
    assert listings.list_operators(s.dim_operateur, agency_country="FR").total == 0
    assert values(listings.list_routes(s.dim_route, origin="beta").data, "route_id") == [11]
    assert listings.train(s.dim_train, s.dim_route, "T1").head()["destination"] == "Betatown"
    assert listings.station(s.dim_gare, 12345).count() == 0
    assert listings.operator(s.dim_operateur, "A1").head()["agency_name"] == "Nightly"
    assert listings.route(s.dim_route, 10).head()["origin"] == "Alphaville"


def test_statistics(loaded):
    _, _, target, _ = loaded
    s = star(target)
    by_operator = [tuple(r) for r in analytics.emissions(s.facts, s.dim_operateur, s.dim_route).collect()]
    # an operator without any emission value comes first, as NULL does in a descending order
    assert by_operator == [
        ("Sleeper", 0.0, 0.0, 1), ("RailCo", 16.8, 8.4, 2), ("RailTwo", 8.4, 8.4, 1), ("Nightly", 0.5, 0.5, 1),
    ]
    by_route = analytics.emissions(s.facts, s.dim_operateur, s.dim_route, "route", "rail")
    assert rows(by_route) == [("Alphaville - Betatown", 25.2, 8.4, 3)]
    assert analytics.emissions(s.facts, s.dim_operateur, s.dim_route, "anything").columns[0] == "label"
    traffic = [tuple(r) for r in analytics.station_traffic(s.facts, s.dim_gare, "arrivee").collect()]
    assert traffic == [("Betatown", None, "DE", 0.0, 4)]
    speed = analytics.operator_performance(s.facts, s.dim_operateur, "night").head()
    assert tuple(speed) == ("Nightly", 80.5, 1510.0, 1000.0, 1)
    assert tuple(analytics.network_summary(s.facts).head()) == (5, 25.7, 0.0, 700.0, 1510.0, 80.5)
    assert tuple(analytics.network_summary(s.facts.where("false")).head()) == (0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_fact_collapses_a_change_of_period_and_keeps_ids(loaded, spark):
    """Ids of known stations survive when a new station sorts before them."""
    _, _, target, first = loaded
    before = {(r["name"], r["country"]): r["gare_id"] for r in target.read("dim_gare").collect()}
    extra = spark.createDataFrame([("AAA", "AAA", "FR", 1.0, 1.0, False)], "name string, city string, country string, latitude double, longitude double, is_main_station boolean")
    draft = Draft(spark, target.root, target.release().manifest)  # never released
    merged = warehouse.WarehouseLoad(target.release(), draft)._merge("dim_gare", extra)
    after = {(r["name"], r["country"]): r["gare_id"] for r in merged.collect()}
    assert target.read("dim_gare").where("name = 'AAA'").isEmpty()
    assert after.pop(("AAA", "FR")) == max(before.values()) + 1
    assert after == before


def test_preview_lists_all_tables(loaded):
    _, clean, _, _ = loaded
    preview = clean.preview()
    assert set(preview) == set(clean.tables())
    assert all(df.count() <= 3 for df in preview.values())


def test_blanks_around_station_names_give_one_fact(spark):
    register = spark.createDataFrame(
        [("Halt ", "FR", "1", "2", "t"), ("Halt", " FR", "3", "4", "f"), (" Ende", "DE", "5", "6", "f")],
        "name string, country string, latitude string, longitude string, is_main_station string",
    )
    stops = spark.createDataFrame([("Halt", "FR ", "7", "8")], "stop_name string, stop_country string, stop_lat string, stop_lon string")
    stations = warehouse.dim_gare(register, stops)
    assert rows(stations.select("name", "country")) == [("Ende", "DE"), ("Halt", "FR")]
    trips = spark.createDataFrame(
        [("T", "1", "A", "FR, DE", " Halt", "Ende ", "10", "08:30", "1")],
        "trip_id string, route_id string, agency_id string, countries string, trip_origin string, trip_headsign string, distance string, duration string, co2_per_km string",
    )
    details = spark.createDataFrame([], "route_id string, start_date_0 string, end_date_0 string, average_speed string")
    transported = spark.createDataFrame([], "geo string, obs_value string, TIME_PERIOD string")
    routes = spark.createDataFrame([(1,)], "route_id int")
    operators = spark.createDataFrame([("A",)], "agency_id string")
    dates = spark.createDataFrame([], "date_id int, start_date date, end_date date")
    numbered = stations.withColumn("gare_id", F.when(F.col("name") == "Halt", 1).otherwise(2))
    (fact,) = warehouse.night_facts(trips, details, transported, routes, operators, numbered, dates).collect()
    assert (fact["gare_depart_id"], fact["gare_arrivee_id"]) == (1, 2)


def test_a_refresh_that_fails_half_way_leaves_the_release_before(loaded, spark, monkeypatch):
    _, clean, target, first = loaded
    number = target.release().manifest.number

    def broken(self):
        self.warehouse.publish("dim_gare", self.warehouse.read("dim_gare").limit(0), ["name", "country"])
        raise RuntimeError("lost")

    monkeypatch.setattr(warehouse.WarehouseLoad, "night_facts", broken)
    with pytest.raises(RuntimeError, match="lost"):
        warehouse.refresh(clean, target)
    assert target.release().manifest.number == number and contents(target) == first


def test_a_refresh_with_nothing_new_writes_only_stations(loaded):
    """Stations take the curated values and then the intermodal ones again; all other tables stay as they are."""
    _, clean, target, _ = loaded
    warehouse.refresh(clean, target)
    before = target.release().manifest.tables
    warehouse.refresh(clean, target)
    after = target.release().manifest.tables
    assert {t for t in after if after[t] != before[t]} <= {"dim_gare"}
