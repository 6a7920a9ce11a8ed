"""Readers over hand-made files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from railloom.operators.columns import SOURCE_ORDER, without_source_order
from railloom.plans import clean
from railloom.sources import catalog, landed
from tests.conftest import rows, values
from tests.landing import write_landing


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return write_landing(tmp_path_factory.mktemp("landing"))


def entity(name):
    return next(e for e in catalog.NIGHT_ENTITIES if e.table == name)


def test_cube_to_long_rows(spark, root):
    raw = landed.read_cube(spark, f"{root}/rail_tf_traveh.tsv")
    long = without_source_order(clean.clean_cube_or_empty(raw, catalog.CUBES[0]))
    assert long.columns == ["train", "vehicle", "mot_nrg", "geo", "TIME_PERIOD", "obs_value"]
    assert rows(long) == sorted([
        ("TOTAL", "LOC", "ELC", "FR", "2018", 123.4), ("TOTAL", "LOC", "ELC", "FR", "2019", None),
        ("PAS", "LOC", "ELC", "FR", "2018", 99.0), ("PAS", "LOC", "ELC", "FR", "2019", 7.0),
        ("TOTAL", "LOC", "DIE", "DE", "2018", None), ("TOTAL", "LOC", "DIE", "DE", "2019", 45.0),
    ], key=repr)


def test_cube_rules_and_shape_errors(spark, root, tmp_path):
    kept = clean.clean_cube_or_empty(landed.read_cube(spark, f"{root}/env_ac_ainah_r2.tsv"), catalog.CUBES[3])
    assert sorted(values(kept, "nace_r2")) == ["H49", "H51"]
    assert clean.clean_cube_or_empty(landed.read_cube(spark, f"{root}/rail_tf_passmov.tsv"), catalog.CUBES[1]) is None
    wide = tmp_path / "wide.tsv"
    wide.write_text("a,b\\T\t2018\nx,y,z\t1\n")
    assert clean.clean_cube_or_empty(landed.read_cube(spark, str(wide)), catalog.CUBES[0]) is None


def test_years_before_the_bound_are_not_scanned(spark, root):
    raw = landed.read_cube(spark, f"{root}/rail_tf_traveh.tsv")
    plan = clean.clean_cube(raw, catalog.CUBES[0])._jdf.queryExecution().executedPlan().toString()
    assert "2018" in plan and "2017" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_keyed_json(spark, root):
    raw = landed.read_keyed_json(spark, f"{root}/agencies.json")
    assert set(raw.columns) == {"agency_id", "agency_name", "agency_url", "agency_timezone", SOURCE_ORDER}
    table = clean.clean_night_entity(raw, entity("agencies")).orderBy(SOURCE_ORDER)
    assert values(table, "agency_name") == ["Nightly", "Sleeper", "Second name"]
    assert values(table, "agency_url") == ["u1", None, "u3"]


def test_typed_entities(spark, root):
    def table(name):
        e = entity(name)
        return without_source_order(clean.clean_night_entity(landed.read_keyed_json(spark, f"{root}/{e.file}"), e))

    assert rows(table("trip_stops").select("arrival_time", "departure_time")) == [("08:05:00", None)]
    on_map = table("view_ontd_map").head()
    assert (on_map["origin_departure_time_0"], on_map["destination_arrival_time_0"]) == ("22:00:00", None)
    assert (on_map["origin_departure_time_1"], on_map["destination_arrival_time_1"]) == ("09:05:00", None)
    assert sorted(values(table("routes"), "route_long_name")) == ["Alpha - Beta", "Beta - Gamma", "again", "no agency"]
    trips = table("trips")
    assert set(values(trips, "is_night_train")) == {True}
    assert sorted(values(trips, "duration"), key=repr) == sorted(["25:10", "25:10", None, None, None, None], key=repr)
    assert dict(trips.dtypes)["distance"] == "string"
    assert dict(table("stops").dtypes)["stop_lat"] == "double"
    assert [str(v) for v in values(table("calendar_dates").orderBy("date"), "date")] == ["None", "2024-01-01 00:00:00"]


def test_per_line_objects_equal_one_object(spark, tmp_path):
    whole, lines = tmp_path / "whole.json", tmp_path / "lines.json"
    whole.write_text('{"1": {"a": "x", "b": ""}, "2": {"a": "y", "c": [1, {"d": 2}]}}')
    lines.write_text('{"1": {"a": "x", "b": ""}}\n{"2": {"a": "y", "c": [1, {"d": 2}]}}\n')
    one = without_source_order(landed.read_keyed_json(spark, str(whole)))
    two = without_source_order(landed.read_keyed_json(spark, str(lines), per_line=True))
    assert rows(one.select("a", "b", "c")) == rows(two.select("a", "b", "c")) == [
        ("x", None, None), ("y", None, '[1,{"d":2}]')
    ]


@pytest.mark.parametrize("body,sep", [("a;b;c;d\n", ";"), ("a,b,c,d\n", ","), ("a\tb\tc\td\n", "\t"), ('"x;y;z;w",b,c,d\n', ",")])
def test_separator_of_unknown_dialect(body, sep):
    assert landed.pick_separator(body.strip("\n")) == sep


def test_no_separator_fits():
    with pytest.raises(ValueError):
        landed.pick_separator("a;b;c")


def test_quoted_cells_and_missing_texts(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b,c,d\n"x,""y""",NA,nan,\n')
    assert rows(without_source_order(landed.read_unknown_dialect(spark, str(path)))) == [('x,"y"', None, None, None)]


def test_files_of_a_folder_have_their_own_dialects(spark, tmp_path):
    """Separators, order of columns and columns differ between files; lines keep their file and order."""
    folder = tmp_path / "mixed files"
    folder.mkdir()
    (folder / "a.csv").write_text("id;name;town;note\n1;A, B;x;p\n2;C, D;y;\n")
    (folder / "b 2.csv").write_text('\ufeffnote,id,"town",name\n"q;r;s;t",3,z,E\n')
    (folder / "c.csv").write_text("id\tname\ttown\textra\n4\tF\tw\t7\n")
    (folder / "d.csv").write_text("id;name;town;note\n5;G;v;u\n")
    (folder / "empty.csv").write_text("")
    for read in (landed.read_unknown_dialect, landed.read_sniffed):
        got = read(spark, str(folder))
        assert set(got.columns) == {"id", "name", "town", "note", "extra", SOURCE_ORDER}
        assert rows(got.select("id", "name", "town", "note", "extra")) == [
            ("1", "A, B", "x", "p", None), ("2", "C, D", "y", None, None), ("3", "E", "z", "q;r;s;t", None), ("4", "F", "w", None, "7"), ("5", "G", "v", "u", None),
        ]
        assert [r["id"] for r in got.orderBy(SOURCE_ORDER).collect()] == ["1", "2", "3", "4", "5"]
    found = landed.dialects(spark, str(folder))
    assert len(found) == 4 and sum(len(d.files) for d in found) == 4


def test_lines_outvote_a_header_that_fits_two_separators(spark, tmp_path):
    path = tmp_path / "two.csv"
    path.write_text("a;x,b;y,c;z,d;w\n" + "1,2,3,4\n" * 5)
    assert landed.read_unknown_dialect(spark, str(path)).columns[:2] == ["a;x", "b;y"]
    assert landed.read_sniffed(spark, str(path)).columns[:2] == ["a;x", "b;y"]


def test_dialects_of_nothing_and_of_too_many(spark, tmp_path, monkeypatch):
    (tmp_path / "none.csv").write_text("\n \n")
    with pytest.raises(ValueError, match="empty source"):
        landed.read_sniffed(spark, str(tmp_path / "none.csv"))
    monkeypatch.setattr(landed, "MOST_DIALECTS", 1)
    (tmp_path / "many").mkdir()
    for n in range(2):
        (tmp_path / "many" / f"{n}.csv").write_text(f"a{n},b\n1,2\n")
    with pytest.raises(ValueError, match="at most"):
        landed.read_sniffed(spark, str(tmp_path / "many"))


def test_stations_timetables_carbon(spark, root):
    stations = clean.clean_stations(landed.read_sniffed(spark, f"{root}/gares_europeennes.csv"))
    assert sorted(values(stations, "id")) == ["1", "4"] and "extra" not in stations.columns
    timetables = clean.clean_timetables(landed.read_sniffed(spark, f"{root}/horaires_des_gares.csv"))
    assert rows(without_source_order(timetables)) == [("A", "6-22")]
    carbon = clean.clean_carbon(landed.read_delimited(spark, f"{root}/co2_emissions.csv", ";"))
    assert carbon.columns[:2] == ["Transporteur", "Origine"] and "Autre" not in carbon.columns
    assert sorted(values(carbon, "Distance entre les gares")) == [197.0, 427.0]


def test_pages(spark, root):
    pages = landed.read_pages(spark, f"{root}/sncf_emissions")
    assert landed.missing_records(pages).head()[0] == 0
    assert landed.missing_records(pages.limit(1)).head()[0] > 0
    records = clean.clean_emission_records(landed.records_of(pages))
    assert "autocar_longue_distance_empreinte_carbone_kgco2e" not in records.columns
    got = {r["transporteur"]: r["duree_estimee_min"] for r in records.collect()}
    assert got == {"TGV INOUI": 60.0, "International": 30.0, "Intercités": 30.0, "TER": 30.0, "x": None}


def test_first_csv_resource(spark, tmp_path):
    from railloom.plans.ingest import manifest_urls

    path = tmp_path / "m.json"
    path.write_text(
        '{"id": "d1", "resources": [{"format": "json", "url": "a"}, {"format": "CSV", "url": "b"}, {"format": "csv", "url": "c"}]}\n'
        '{"id": "d2", "resources": [{"format": "pdf", "url": "a"}]}\n'
    )
    manifests = spark.read.json(str(path))
    assert rows(landed.first_csv_resource(manifests)) == [("d1", "b")]
    assert rows(manifest_urls(manifests, {"d1": "gares", "d9": "x"})) == [("gares", "b")]


def test_source_order_is_the_order_in_the_file_however_it_is_split(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("n,a,b,c\n" + "".join(f"{i},x,y,z\n" for i in range(5000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        df = landed.read_delimited(spark, str(path), ",")
        assert df.rdd.getNumPartitions() > 4
        assert [int(n) for n in values(df.orderBy(SOURCE_ORDER), "n")] == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
