"""The whole ingest: files of every source landed out of the test tables, some of them damaged, and loaded."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railloom.operators.staging import scratch_path
from railloom.plans import ingest
from railloom.sources.zones import Zone
from workload.catalogue import register
from workload.views import Tables

PER_FILE = 5000  # objects in one landed file


def _cube(df: DataFrame, header: str, key: Column, path: str) -> None:
    years = [F.sum(F.when(F.col("l_linenumber") == n, F.col("l_quantity"))).alias(f"{2017 + n} ") for n in range(1, 4)]
    df.groupBy(key.alias(header)).agg(*years).write.csv(path, sep="\t", header=True)


def _objects(df: DataFrame, key: str, values: dict[str, Column], path: str, tail: str | None = None) -> None:
    """Files that are one object of objects each; ``tail`` is the text of one more file."""
    entry = F.concat(F.lit('"k'), F.col(key).cast("string"), F.lit('": '), F.to_json(F.struct(*[v.alias(n) for n, v in values.items()])))
    part = F.floor(F.col(key) / PER_FILE).alias("part")
    files = df.select(part, entry.alias("entry")).groupBy("part").agg(F.array_join(F.collect_list("entry"), ",\n").alias("body"))
    files = files.select("part", F.concat(F.lit("{\n"), "body", F.lit("\n}")).alias("value"))
    if tail is not None:
        files = files.unionByName(files.sparkSession.createDataFrame([(-1, tail)], "part long, value string"))
    files.write.partitionBy("part").text(path)


def _text(name: str, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.col(name).cast("string"))


def land(t: Tables, root: str) -> None:
    """Every source but the timetables, which are missing; one cube has a bad header, the trips break off."""
    lines = t.lineitem
    geo = _text("l_suppkey", "P")
    _cube(lines, "freq,train,vehicle,mot_nrg,unit,geo\\TIME_PERIOD", F.concat(F.lit("A,T,L,E,U,"), geo), f"{root}/rail_tf_traveh.tsv")
    _cube(lines, "no header\\", F.concat(F.lit("A,"), geo), f"{root}/rail_tf_passmov.tsv")
    _cube(lines, "freq,unit,geo\\TIME_PERIOD", F.concat(F.lit("A,U,"), geo), f"{root}/rail_pa_total.tsv")
    nace = F.concat(F.lit("A,H"), (F.col("l_suppkey") % 4 + 48).cast("string"), F.lit(","), geo)
    _cube(lines, "freq,nace_r2,geo\\TIME_PERIOD", nace, f"{root}/env_ac_ainah_r2.tsv")
    short = F.when(F.col("p_size") % 5 == 0, F.lit(" = ")).otherwise(_text("p_size"))
    broken = '{"x1": {"trip_id": "X1", "duration": "}\\""}, "x2": {"trip_id": "X2"'
    _objects(t.nation, "n_nationkey", {"agency_id": _text("n_nationkey"), "agency_name": F.col("n_name")}, f"{root}/agencies.json")
    _objects(t.part, "p_partkey", {"route_id": _text("p_partkey"), "route_short_name": short}, f"{root}/routes.json")
    _objects(t.orders, "o_orderkey", {"trip_id": _text("o_orderkey", "T"), "duration": F.col("o_orderpriority")}, f"{root}/trips.json", broken)
    _objects(t.supplier, "s_suppkey", {"stop_name": F.col("s_name"), "stop_lat": _text("s_acctbal")}, f"{root}/stops.json")
    _objects(t.customer, "c_custkey", {"date": F.lit("2024-01-31"), "id": _text("c_custkey")}, f"{root}/calendar_dates.json")
    _objects(t.customer, "c_custkey", {"trip": _text("c_custkey"), "arrival_time": F.lit("8:05")}, f"{root}/trip_stop.json")
    _objects(t.part, "p_partkey", {"route_id": _text("p_partkey"), "start_date_0": F.lit("20240101")}, f"{root}/view_ontd_details.json")
    for name in ("calendar", "classes", "translations", "view_ontd_cities", "view_ontd_list", "view_ontd_map"):
        _objects(t.supplier, "s_suppkey", {"id": _text("s_suppkey"), "": F.lit("x"), "note": F.lit("}{")}, f"{root}/{name}.json")
    k = F.col("s_suppkey")
    names = [F.concat(F.lit(p), k.cast("string")).alias(n) for p, n in (("A", "From"), ("B", "To"))]
    t.supplier.select(*names, F.lit("RailCo").alias("Operator"), k.alias("Distance")).write.csv(f"{root}/intermodal.csv", sep=";", header=True)
    t.supplier.select(
        k.alias("id"), F.col("s_name").alias("name"), F.lit("4.5").alias("latitude"), F.lit("1").alias("longitude"), F.lit("FR").alias("country")
    ).write.csv(f"{root}/gares_europeennes.csv", sep="|", header=True)
    carbon = [F.lit("x").alias("Origine"), _text("c_custkey").alias("Destination"), F.lit(1).alias("Distance entre les gares")]
    t.customer.select(*carbon, F.lit(2).alias("Train - Empreinte carbone (kgCO2e)")).write.csv(f"{root}/co2_emissions.csv", sep=";", header=True)
    record = F.struct(F.lit("TER").alias("transporteur"), k.cast("double").alias("distance_entre_les_gares"))
    pages = t.supplier.groupBy(F.floor(k / 10).alias("page")).agg(F.collect_list(record).alias("results"))
    n = t.supplier.count()
    texts = pages.select("page", F.to_json(F.struct(F.lit(n).alias("total_count"), "results")).alias("value"))
    # a file a page: some hundred in each task
    texts.repartition(max(1, min(4096, n // 2000)), "page").write.partitionBy("page").text(f"{root}/sncf_emissions")


CUBE_ROWS = "3 * (SELECT count(DISTINCT l_suppkey) FROM lineitem)"
#: Tables and the number of rows that the oracle expects; NULL where nothing is loaded.
ROWS = {
    "train_traffic_source_energy": CUBE_ROWS,
    "passenger_transported": CUBE_ROWS,
    "air_emissions": "3 * (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_suppkey % 4 IN (1, 3))",
    "agencies": "(SELECT count(*) FROM nation)",
    "routes": "(SELECT count(*) FROM part WHERE p_size % 5 > 0)",
    "trips": "1 + (SELECT count(*) FROM orders)",
    **dict.fromkeys(("calendar_dates", "trip_stops", "co2_emissions"), "(SELECT count(*) FROM customer)"),
    "view_ontd_details": "(SELECT count(*) FROM part)",
    **dict.fromkeys(("stops", "calendar", "classes", "translations", "view_ontd_cities", "view_ontd_list", "view_ontd_map"), "(SELECT count(*) FROM supplier)"),
    **dict.fromkeys(("gares_europeennes", "sncf_emissions", "dim_route", "dim_train", "fact_trajet_train"), "(SELECT count(*) FROM supplier)"),
    "dim_gare": "2 * (SELECT count(*) FROM supplier)",
    "dim_operateur": "1",
    "dim_date": "1",
    "quarantine": "1",
}
MISSING = {"passenger_traffic_train_speed": "empty", "horaires_des_gares": "skipped"}
SQL = " UNION ALL ".join(
    [f"SELECT '{name}' AS source, 'loaded' AS outcome, CAST({n} AS BIGINT) AS n_rows" for name, n in ROWS.items()]
    + [f"SELECT '{name}', '{outcome}', CAST(NULL AS BIGINT)" for name, outcome in MISSING.items()]
)


@register(SQL)
def ingested_tables(t: Tables) -> DataFrame:
    """Outcome and rows of every table of the clean zone after one ingest."""
    root = scratch_path(t.spark, "landing")
    land(t, root)
    zone = Zone(t.spark, f"ingested_{uuid.uuid4().hex[:8]}", f"{root}-clean").create()
    outcome = ingest.ingest(t.spark, ingest.Landing(root), zone) | {ingest.QUARANTINE: "loaded"}
    release = zone.release()
    found = t.spark.createDataFrame(sorted(outcome.items()), "source string, outcome string")
    tables = [release.read(n).select(F.lit(n).alias("source")) for n in release.tables()]
    rows = tables[0]
    for other in tables[1:]:
        rows = rows.unionAll(other)
    return found.join(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows")), "source", "left")
