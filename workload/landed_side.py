"""Queries that land files derived from the test tables in the scratch folder and ingest them again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.functions.measures import round_half_up
from railloom.operators.columns import without_source_order
from railloom.operators.staging import scratch_path
from railloom.plans import clean, intermodal
from railloom.sources import landed
from railloom.sources.catalog import NIGHT_ENTITIES, CubeSpec
from railloom.sources.zones import Zone
from workload.catalogue import register, rounded
from workload.views import Tables

FLAGGED = "2001"  # the year whose cells are landed as confidential


@register(
    """WITH cube AS (SELECT l_partkey, l_linestatus, year(l_shipdate) AS y, sum(l_quantity) AS q
      FROM lineitem GROUP BY 1, 2, 3),
    keys AS (SELECT DISTINCT l_partkey, l_linestatus FROM lineitem)
    SELECT l_linestatus AS vehicle, 'P' || l_partkey AS geo, '' || p.y AS TIME_PERIOD,
      CASE WHEN p.y <> 2001 THEN q END AS obs_value
    FROM keys CROSS JOIN (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem WHERE year(l_shipdate) >= 1998) p LEFT JOIN cube USING (l_partkey, l_linestatus, y)
    WHERE (l_linestatus = 'F' OR l_partkey = 7)"""
)
def landed_cube(t: Tables) -> DataFrame:
    """Tab-separated cube with flags and gaps, years before 1998 cut, rows kept by rule."""
    spark = t.spark
    key = F.concat(F.lit("A,"), "l_linestatus", F.lit(" , P"), F.col("l_partkey").cast("string"))
    dated = t.lineitem.withColumn("y", F.year("l_shipdate").cast("string"))
    wide = (
        dated.groupBy(key.alias("freq,vehicle,geo\\TIME_PERIOD"))
        .pivot("y", sorted(r["y"] for r in dated.select("y").distinct().collect()))
        .agg(F.sum("l_quantity"))
    )
    first, *years = wide.columns
    cells = [
        F.when(F.lit(y == FLAGGED), F.lit(": c"))
        .otherwise(F.coalesce(F.concat(F.col(y).cast("string"), F.lit(" e")), F.lit(":")))
        .alias(f"{y} ")
        for y in years
    ]
    path = scratch_path(spark, "cube")
    wide.select(F.col(f"`{first}`"), *cells).write.csv(path, sep="\t", header=True)
    spec = CubeSpec(
        "probe", "probe", drop=("freq", "absent"), keep=({"vehicle": "F"}, {"geo": "P7"}), since=1998
    )
    return without_source_order(clean.clean_cube_or_empty(landed.read_cube(spark, path), spec))


TRIPS_SQL = """SELECT trip_id, CASE WHEN clerk <> '' THEN clerk END AS agency_id,
    CASE WHEN o_orderkey % 30 < 24 THEN lpad('' || (o_orderkey % 30), 2, '0') || ':05:00' END AS origin_departure_time,
    lpad('' || (o_orderkey % 30), 2, '0') || ':05' AS duration, TRUE AS is_night_train
  FROM (SELECT *, unnest(['T' || o_orderkey, 'U' || o_orderkey]) AS trip_id,
          CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END AS clerk FROM orders)"""


def _trip(t: Tables, prefix: str) -> F.Column:
    k = F.col("o_orderkey")
    clock = F.concat(F.lpad((k % 30).cast("string"), 2, "0"), F.lit(":05"))
    return F.struct(
        F.concat(F.lit(prefix), k.cast("string")).alias("trip_id"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.col("o_orderstatus")).alias("agency_id"),
        F.concat(clock, F.lit(":00")).alias("origin_departure_time"),
        clock.alias("duration"),
    )


TRIPS = next(e for e in NIGHT_ENTITIES if e.table == "trips")


@register(TRIPS_SQL)
def landed_keyed_json(t: Tables) -> DataFrame:
    """Objects of objects, one per line; blanks are missing, an empty object is no row."""
    k = F.col("o_orderkey").cast("string")
    line = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            F.concat(F.lit('"a'), k, F.lit('":'), F.to_json(_trip(t, "T"))),
            F.concat(F.lit('"b'), k, F.lit('":'), F.to_json(_trip(t, "U"))),
            F.concat(F.lit('"c'), k, F.lit('":{"trip_id":"","":"x"}')),
        ),
        F.lit("}"),
    )
    path = scratch_path(t.spark, "keyed")
    t.orders.select(line.alias("value")).write.text(path)
    rows = landed.read_keyed_json(t.spark, path, per_line=True)
    return without_source_order(clean.clean_night_entity(rows, TRIPS))


@register(TRIPS_SQL)
def landed_json_lines(t: Tables) -> DataFrame:
    """S3 for volume: the same trips as JSON lines."""
    path = scratch_path(t.spark, "lines")
    both = t.orders.select(F.explode(F.array(_trip(t, "T"), _trip(t, "U"))).alias("r")).select("r.*")
    both.write.json(path)
    return without_source_order(clean.clean_night_entity(landed.read_json_lines(t.spark, path), TRIPS))


@register(
    """SELECT '' || s_suppkey AS id, s_name AS name, '4.5' AS latitude, '' || s_acctbal AS longitude,
      CASE WHEN s_suppkey % 7 > 0 THEN 'N' || s_nationkey END AS country, 't' AS is_main_station
    FROM supplier WHERE s_suppkey % 7 > 0 AND s_suppkey % 11 > 0"""
)
def landed_stations(t: Tables) -> DataFrame:
    """Separator found from the header; unknown columns go, mandatory ones must be there."""
    k = F.col("s_suppkey")
    path = scratch_path(t.spark, "stations")
    t.supplier.select(
        k.cast("string").alias("id"),
        F.lit("x").alias("not_wanted"),
        F.col("s_name").alias("name"),
        F.lit("4.5").alias("latitude"),
        F.when(k % 11 > 0, F.col("s_acctbal").cast("string")).otherwise("NA").alias("longitude"),
        F.when(k % 7 > 0, F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))).alias("country"),
        F.lit("t").alias("is_main_station"),
    ).write.csv(path, sep="|", header=True)
    return without_source_order(clean.clean_stations(landed.read_sniffed(t.spark, path)))


@register(
    """SELECT '' || c_custkey AS stop, c_name AS line, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS hours
    FROM customer WHERE c_custkey % 3 > 0"""
)
def landed_timetables(t: Tables) -> DataFrame:
    """Only complete rows."""
    path = scratch_path(t.spark, "timetables")
    t.customer.select(
        F.col("c_custkey").cast("string").alias("stop"),
        F.col("c_name").alias("line"),
        F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("hours"),
    ).write.csv(path, sep="\t", header=True)
    return without_source_order(clean.clean_timetables(landed.read_sniffed(t.spark, path)))


@register(
    """SELECT DISTINCT 'P' || l_partkey || ' - S' || l_suppkey AS route_long_name, 'P' || l_partkey AS origin,
      'S' || l_suppkey AS destination, CAST(NULL AS VARCHAR) AS countries
    FROM lineitem"""
)
def landed_connections(t: Tables) -> DataFrame:
    """One of three separators, quoted cells that hold it; columns that are missing are NULL."""
    path = scratch_path(t.spark, "connections")
    t.lineitem.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("From"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("To"),
        F.concat(F.lit('Line; "'), F.col("l_returnflag"), F.lit('"')).alias("Operator"),
        F.col("l_quantity").alias("Distance"),
    ).write.csv(path, sep=";", header=True, escape='"')
    connections = intermodal.numbered_connections(landed.read_unknown_dialect(t.spark, path))
    routes = intermodal.routes(connections)
    return routes.select("route_long_name", "origin", "destination", "countries")


@register(
    f"""SELECT s_name AS "Origine", n_name AS "Destination", s_acctbal AS "Distance entre les gares",
      {rounded('s_acctbal * 0.5', 3)} AS "Train - Empreinte carbone (kgCO2e)"
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 > 0"""
)
def landed_carbon(t: Tables) -> DataFrame:
    """Semicolons, a byte-order mark, padded column names."""
    path = scratch_path(t.spark, "carbon")
    half = round_half_up(F.col("s_acctbal") * 0.5, 3)
    t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("\ufeffOrigine"),
        F.when(F.col("s_suppkey") % 4 > 0, F.col("n_name")).alias(" Destination"),
        F.col("s_acctbal").alias("Distance entre les gares "),
        half.alias(" Train - Empreinte carbone (kgCO2e) "),
        F.lit("z").alias("Commentaire"),
    ).write.csv(path, sep=";", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return without_source_order(clean.clean_carbon(landed.read_delimited(t.spark, path, ";")))


@register(
    f"""SELECT p_partkey AS id, r AS transporteur, CAST(p_retailprice AS DOUBLE) AS distance_entre_les_gares,
      {rounded("p_retailprice / (CASE r WHEN 'TER' THEN 90::DOUBLE ELSE 280::DOUBLE END) * 60", 1)} AS duree_estimee_min
    FROM (SELECT *, unnest(['TER', 'TGV INOUI']) AS r FROM part)"""
)
def landed_pages(t: Tables) -> DataFrame:
    """Pages of records, unwanted measures dropped, travel time estimated."""

    def record(carrier: str) -> F.Column:
        return F.struct(
            F.col("p_partkey").alias("id"),
            F.lit(carrier).alias("transporteur"),
            F.col("p_retailprice").alias("distance_entre_les_gares"),
            F.lit(1.5).alias("autocar_longue_distance_empreinte_carbone_kgco2e"),
        )

    path = scratch_path(t.spark, "pages")
    page = F.struct(F.lit(2).alias("total_count"), F.array(record("TER"), record("TGV INOUI")).alias("results"))
    t.part.select(F.to_json(page).alias("value")).write.text(path)
    pages = landed.read_pages(t.spark, path, per_line=True)
    return clean.clean_emission_records(landed.records_of(pages))


@register(
    """SELECT p_partkey AS id, 'http://files.example/' || p_partkey || '/' ||
      CASE WHEN p_size % 3 = 0 THEN 'b' ELSE 'c' END AS url FROM part WHERE p_size % 5 > 0"""
)
def first_csv_resources(t: Tables) -> DataFrame:
    """The first resource whose format is CSV in any case; manifests without one give nothing."""

    def resource(kind: F.Column, name: str) -> F.Column:
        url = F.concat(F.lit("http://files.example/"), F.col("p_partkey").cast("string"), F.lit(f"/{name}"))
        return F.struct(kind.alias("format"), url.alias("url"))

    maybe = F.when(F.col("p_size") % 3 == 0, F.lit("Csv")).otherwise("json")
    last = F.when(F.col("p_size") % 5 > 0, F.lit("CSV")).otherwise("xml")
    with_none = F.when(F.col("p_size") % 5 > 0, maybe).otherwise("pdf")
    manifests = t.part.select(
        F.col("p_partkey").alias("id"),
        F.array(resource(F.lit("pdf"), "a"), resource(with_none, "b"), resource(last, "c")).alias("resources"),
    )
    return landed.first_csv_resource(manifests)


@register(
    """SELECT geo, year, CASE WHEN fresh.v IS NOT NULL OR fresh.geo IS NOT NULL THEN fresh.v ELSE old.v END AS obs_value
    FROM (SELECT l_partkey AS geo, year(l_shipdate)::INTEGER AS year, max(l_quantity) AS v FROM lineitem
          WHERE l_linenumber < 5 GROUP BY 1, 2) old
    FULL JOIN (SELECT l_partkey AS geo, year(l_shipdate)::INTEGER AS year, min(l_extendedprice) AS v FROM lineitem
          WHERE l_linenumber > 3 GROUP BY 1, 2) fresh USING (geo, year)"""
)
def zone_upsert(t: Tables) -> DataFrame:
    """Create a clean table, load a second batch into it, then an empty one."""
    rows = t.lineitem.withColumn("year", F.year("l_shipdate"))
    key = [F.col("l_partkey").alias("geo"), "year"]
    first = rows.where("l_linenumber < 5").groupBy(*key).agg(F.max("l_quantity").alias("obs_value"))
    second = rows.where("l_linenumber > 3").groupBy(*key).agg(F.min("l_extendedprice").alias("obs_value"))
    zone = Zone(t.spark, f"railloom_{uuid.uuid4().hex[:8]}", scratch_path(t.spark, "zone")).create()
    zone.load("measures", first)
    zone.load("measures", second)
    zone.load("measures", second.where("geo < 0"))
    return zone.read("measures")
