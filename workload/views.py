"""The test tables seen as a rail star, as clean-zone tables and as an intermodal connections table.

Every view exists twice: as a DataFrame and as the text of a SQL common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railloom.operators.columns import SOURCE_ORDER
from railloom.plans.listings import Star

CO2 = 0.014


class Tables:
    """The parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def text(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# ------------------------------------------------------------------ star for the statistics

SQL_OPERATOR = """v_operator AS (
  SELECT s_suppkey AS agency_id, s_name AS agency_name,
         'http://operator.example/' || s_suppkey AS agency_url FROM supplier)"""


def operator(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("agency_id"),
        F.col("s_name").alias("agency_name"),
        F.concat(F.lit("http://operator.example/"), text("s_suppkey")).alias("agency_url"),
    )


SQL_ROUTE = """v_route AS (
  SELECT p_partkey AS route_id, p_partkey % 97 AS agency_id,
         p_brand || ' - ' || p_type AS route_long_name, p_brand AS origin, p_type AS destination,
         p_name AS countries FROM part)"""


def route(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("route_id"),
        (F.col("p_partkey") % 97).alias("agency_id"),
        F.concat("p_brand", F.lit(" - "), "p_type").alias("route_long_name"),
        F.col("p_brand").alias("origin"),
        F.col("p_type").alias("destination"),
        F.col("p_name").alias("countries"),
    )


SQL_STATION = """v_station AS (
  SELECT n_nationkey AS gare_id, n_name AS name, n_name AS city, r_name AS country,
         CAST(n_nationkey * 1.5 + 35 AS DOUBLE) AS latitude, CAST(n_nationkey * 2.25 - 10 AS DOUBLE) AS longitude,
         n_nationkey % 2 = 0 AS is_main_station
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def station(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("gare_id"),
        F.col("n_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        (F.col("n_nationkey") * 1.5 + 35).alias("latitude"),
        (F.col("n_nationkey") * 2.25 - 10).alias("longitude"),
        (F.col("n_nationkey") % 2 == 0).alias("is_main_station"),
    )


MEASURES_SQL = """l_quantity * 10 AS distance_km, l_quantity * 6 + l_linenumber AS duree_minutes,
         l_quantity * 10 * 0.014 AS emissions_co2,
         l_quantity * 10 / ((l_quantity * 6 + l_linenumber) / 60) AS average_speed"""

SQL_FACT = f"""v_fact AS (
  SELECT l_orderkey AS train_id, l_partkey AS route_id, l_suppkey AS operator_id, {MEASURES_SQL},
         l_returnflag = 'R' AS is_night_train, CAST(month(l_shipdate) AS INTEGER) AS date_id
  FROM lineitem)"""


def _measures() -> list:
    distance = F.col("l_quantity") * 10
    minutes = F.col("l_quantity") * 6 + F.col("l_linenumber")
    return [
        distance.alias("distance_km"),
        minutes.alias("duree_minutes"),
        (distance * CO2).alias("emissions_co2"),
        (distance / (minutes / 60)).alias("average_speed"),
    ]


def fact(t: Tables) -> DataFrame:
    """One journey per line item, without stations."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("train_id"),
        F.col("l_partkey").alias("route_id"),
        F.col("l_suppkey").alias("operator_id"),
        *_measures(),
        (F.col("l_returnflag") == "R").alias("is_night_train"),
        F.month("l_shipdate").alias("date_id"),
    )


SQL_FACT_DEPART = """v_fact_depart AS (
  SELECT s_nationkey AS gare_depart_id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
SQL_FACT_ARRIVEE = """v_fact_arrivee AS (
  SELECT c_nationkey AS gare_arrivee_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey)"""


def fact_depart(t: Tables) -> DataFrame:
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("gare_depart_id")
    )


def fact_arrivee(t: Tables) -> DataFrame:
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_nationkey").alias("gare_arrivee_id"))
    )


# ------------------------------------------------------------------ journeys with a unique key

SQL_TRAIN = """v_train AS (
  SELECT o_orderkey AS trip_id, o_custkey AS route_id, o_orderpriority AS trip_headsign,
         o_orderstatus AS trip_origin, CAST(o_orderkey % 50 AS INTEGER) AS h, CAST(o_orderkey % 60 AS INTEGER) AS m,
         o_totalprice AS distance, o_orderkey % 3 = 0 AS is_night_train FROM orders)"""


def train(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_custkey").alias("route_id"),
        F.col("o_orderpriority").alias("trip_headsign"),
        F.col("o_orderstatus").alias("trip_origin"),
        F.make_dt_interval(
            F.lit(0), (F.col("o_orderkey") % 50).cast("int"), (F.col("o_orderkey") % 60).cast("int")
        ).alias("duration"),
        F.col("o_totalprice").alias("distance"),
        (F.col("o_orderkey") % 3 == 0).alias("is_night_train"),
    )


SQL_TRAIN_SHAPE = """v_train_shape AS (
  SELECT trip_id, v_train.route_id, trip_headsign, trip_origin AS origin, destination,
         CASE h // 24 WHEN 0 THEN '' WHEN 1 THEN '1 day, ' ELSE (h // 24) || ' days, ' END
           || (h % 24) || ':' || lpad(CAST(m AS VARCHAR), 2, '0') || ':00' AS duration,
         distance, is_night_train
  FROM v_train LEFT JOIN v_route ON v_train.route_id = v_route.route_id)"""

SQL_JOURNEY = """v_journey AS (
  SELECT o_orderkey AS fact_id, o_orderkey AS train_id, o_custkey AS route_id, o_custkey // 15 AS operator_id,
         c_nationkey AS gare_depart_id, (c_nationkey + o_orderkey) % 26 AS gare_arrivee_id,
         [month(o_orderdate), 12 + quarter(o_orderdate)]::INTEGER[] AS date_ids,
         o_totalprice / 1000 AS distance_km, CAST(o_orderkey % 600 + 30 AS DOUBLE) AS duree_minutes,
         o_totalprice / 1000 * 0.014 AS emissions_co2,
         o_totalprice / 1000 / ((o_orderkey % 600 + 30) / 60) AS average_speed
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def journey(t: Tables) -> DataFrame:
    """One journey per order; arrival station 25 does not exist."""
    distance = F.col("o_totalprice") / 1000
    minutes = (F.col("o_orderkey") % 600 + 30).cast("double")
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("fact_id"),
        F.col("o_orderkey").alias("train_id"),
        F.col("o_custkey").alias("route_id"),
        F.floor(F.col("o_custkey") / 15).alias("operator_id"),
        F.col("c_nationkey").alias("gare_depart_id"),
        ((F.col("c_nationkey") + F.col("o_orderkey")) % 26).cast("int").alias("gare_arrivee_id"),
        F.array(F.month("o_orderdate"), 12 + F.quarter("o_orderdate")).alias("date_ids"),
        distance.alias("distance_km"),
        minutes.alias("duree_minutes"),
        (distance * CO2).alias("emissions_co2"),
        (distance / (minutes / 60)).alias("average_speed"),
    )


SQL_DATE = """v_date AS (
  SELECT date_id, min(d) AS start_date, max(d) AS end_date FROM (
    SELECT unnest([month(o_orderdate), 12 + quarter(o_orderdate)]::INTEGER[]) AS date_id, CAST(o_orderdate AS DATE) AS d
    FROM orders) GROUP BY date_id)"""


def date(t: Tables) -> DataFrame:
    ids = F.array(F.month("o_orderdate"), 12 + F.quarter("o_orderdate"))
    return (
        t.orders.select(F.explode(ids).alias("date_id"), F.to_date("o_orderdate").alias("d"))
        .groupBy("date_id")
        .agg(F.min("d").alias("start_date"), F.max("d").alias("end_date"))
    )


def star(t: Tables) -> Star:
    return Star(journey(t), station(t), train(t), operator(t), route(t), date(t))


SQL_STAR = ", ".join([SQL_OPERATOR, SQL_ROUTE, SQL_STATION, SQL_TRAIN, SQL_TRAIN_SHAPE, SQL_JOURNEY, SQL_DATE])

# ------------------------------------------------------------------ clean-zone tables, all text

SQL_AGENCIES = """c_agencies AS (
  SELECT '  ' || s_suppkey AS agency_id, s_name AS agency_name, 'http://op.example/' || s_suppkey AS agency_url,
         'Europe/' || s_nationkey AS agency_timezone, 2 * s_suppkey AS so FROM supplier
  UNION ALL
  SELECT s_suppkey || ' ', 'second ' || s_name, NULL, 'Europe/Paris', 2 * s_suppkey + (s_suppkey % 5) - 2
  FROM supplier WHERE s_suppkey % 5 <> 2)"""


def agencies(t: Tables) -> DataFrame:
    s = t.supplier
    first = s.select(
        F.concat(F.lit("  "), text("s_suppkey")).alias("agency_id"),
        F.col("s_name").alias("agency_name"),
        F.concat(F.lit("http://op.example/"), text("s_suppkey")).alias("agency_url"),
        F.concat(F.lit("Europe/"), text("s_nationkey")).alias("agency_timezone"),
        (2 * F.col("s_suppkey")).alias(SOURCE_ORDER),
    )
    second = s.where("s_suppkey % 5 <> 2").select(
        F.concat(text("s_suppkey"), F.lit(" ")).alias("agency_id"),
        F.concat(F.lit("second "), "s_name").alias("agency_name"),
        F.lit(None).cast("string").alias("agency_url"),
        F.lit("Europe/Paris").alias("agency_timezone"),
        (2 * F.col("s_suppkey") + F.col("s_suppkey") % 5 - 2).alias(SOURCE_ORDER),
    )
    return first.unionByName(second)


SQL_ROUTES = """c_routes AS (
  SELECT CASE WHEN p_partkey % 50 = 49 THEN 'x' || p_partkey ELSE (p_partkey % 1000000) || '.0' END AS route_id,
         CASE WHEN p_partkey % 30 <> 29 THEN ' ' || (p_partkey % 120) END AS agency_id,
         p_name AS route_long_name, p_brand AS origin_trip_0, p_type AS destination_trip_0, p_partkey AS so
  FROM part
  UNION ALL
  SELECT ' ' || p_partkey, '' || (p_partkey % 7), 'again ' || p_name, p_type, p_brand, p_partkey - 1
  FROM part WHERE p_size > 25)"""


def routes(t: Tables) -> DataFrame:
    p = t.part
    key = F.col("p_partkey")
    first = p.select(
        F.when(key % 50 == 49, F.concat(F.lit("x"), text(key)))
        .otherwise(F.concat(text(key % 1000000), F.lit(".0")))
        .alias("route_id"),
        F.when(key % 30 != 29, F.concat(F.lit(" "), text(key % 120))).alias("agency_id"),
        F.col("p_name").alias("route_long_name"),
        F.col("p_brand").alias("origin_trip_0"),
        F.col("p_type").alias("destination_trip_0"),
        key.alias(SOURCE_ORDER),
    )
    again = p.where("p_size > 25").select(
        F.concat(F.lit(" "), text(key)).alias("route_id"),
        text(key % 7).alias("agency_id"),
        F.concat(F.lit("again "), "p_name").alias("route_long_name"),
        F.col("p_type").alias("origin_trip_0"),
        F.col("p_brand").alias("destination_trip_0"),
        (key - 1).alias(SOURCE_ORDER),
    )
    return first.unionByName(again)


SQL_TRIPS = """c_trips AS (
  SELECT CASE WHEN o_orderkey % 101 <> 100 THEN ' T' || (o_orderkey - o_orderkey % 4 // 3) || ' ' END AS trip_id,
         '' || o_custkey AS route_id, '' || (o_custkey // 15) AS agency_id,
         'Halt ' || (o_orderkey % 400) AS trip_headsign, 'Halt ' || (o_custkey % 300) AS trip_origin,
         'C' || (o_custkey % 5) || ', C9 ,C' || (o_orderkey % 6) || ' ' AS countries,
         CAST(o_totalprice AS VARCHAR) AS distance,
         CASE WHEN o_orderkey % 11 = 10 THEN 'n/a'
              ELSE lpad('' || (o_orderkey % 31), 2, '0') || ':' || lpad('' || (o_orderkey % 60), 2, '0')
              END AS duration,
         lpad('' || (o_orderkey % 27), 2, '0') || ':' || lpad('' || (o_orderkey % 60), 2, '0')
              || CASE WHEN o_orderkey % 2 = 0 THEN ':15' ELSE '' END AS destination_arrival_time,
         CASE WHEN o_orderkey % 9 = 8 THEN '-' ELSE '0.0' || (o_orderkey % 50) END AS co2_per_km,
         CASE o_orderkey % 4 WHEN 0 THEN ' Oui' WHEN 1 THEN 't' WHEN 2 THEN '0' END AS is_night_train,
         o_orderkey AS so
  FROM orders)"""


def _two(c) -> F.Column:
    return F.lpad(text(c), 2, "0")


def trips(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    shifted = k - F.floor(k % 4 / 3)
    return t.orders.select(
        F.when(k % 101 != 100, F.concat(F.lit(" T"), text(shifted), F.lit(" "))).alias("trip_id"),
        text(c).alias("route_id"),
        text(F.floor(c / 15)).alias("agency_id"),
        F.concat(F.lit("Halt "), text(k % 400)).alias("trip_headsign"),
        F.concat(F.lit("Halt "), text(c % 300)).alias("trip_origin"),
        F.concat(F.lit("C"), text(c % 5), F.lit(", C9 ,C"), text(k % 6), F.lit(" ")).alias("countries"),
        text("o_totalprice").alias("distance"),
        F.when(k % 11 == 10, F.lit("n/a"))
        .otherwise(F.concat(_two(k % 31), F.lit(":"), _two(k % 60)))
        .alias("duration"),
        F.concat(
            _two(k % 27), F.lit(":"), _two(k % 60), F.when(k % 2 == 0, F.lit(":15")).otherwise("")
        ).alias("destination_arrival_time"),
        F.when(k % 9 == 8, F.lit("-")).otherwise(F.concat(F.lit("0.0"), text(k % 50))).alias("co2_per_km"),
        F.when(k % 4 == 0, F.lit(" Oui"))
        .when(k % 4 == 1, F.lit("t"))
        .when(k % 4 == 2, F.lit("0"))
        .alias("is_night_train"),
        k.alias(SOURCE_ORDER),
    )


DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

SQL_DETAILS = (
    """c_details AS (
  SELECT '' || (c_custkey - c_custkey % 3 // 2) AS route_id, '' || (60 + c_custkey % 40) AS average_speed,
         '2024-' || lpad('' || (1 + c_custkey % 12), 2, '0') || '-01' AS start_date_0,
         CASE WHEN c_custkey % 13 = 12 THEN 'soon'
              ELSE '2024-' || lpad('' || (1 + c_custkey % 12), 2, '0') || '-20 10:00:00' END AS end_date_0,
         CASE WHEN c_custkey % 4 = 0 THEN '2025-0' || (1 + c_custkey % 9) || '-05T23:30:00-05:00' END AS start_date_1,
         '20251231' AS end_date_1, """
    + ", ".join(
        f"CASE WHEN c_custkey % {i + 2} = 0 THEN '1' ELSE '0' END AS {d}_0,"
        f" CASE WHEN c_custkey % {i + 3} = 0 THEN '1.0' END AS {d}_1"
        for i, d in enumerate(DAYS)
    )
    + ", c_custkey AS so FROM customer)"
)


def details(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    month = _two(1 + k % 12)
    flags = []
    for i, d in enumerate(DAYS):
        flags.append(F.when(k % (i + 2) == 0, F.lit("1")).otherwise("0").alias(f"{d}_0"))
        flags.append(F.when(k % (i + 3) == 0, F.lit("1.0")).alias(f"{d}_1"))
    return t.customer.select(
        text(k - F.floor(k % 3 / 2)).alias("route_id"),
        text(60 + k % 40).alias("average_speed"),
        F.concat(F.lit("2024-"), month, F.lit("-01")).alias("start_date_0"),
        F.when(k % 13 == 12, F.lit("soon"))
        .otherwise(F.concat(F.lit("2024-"), month, F.lit("-20 10:00:00")))
        .alias("end_date_0"),
        F.when(k % 4 == 0, F.concat(F.lit("2025-0"), text(1 + k % 9), F.lit("-05T23:30:00-05:00"))).alias(
            "start_date_1"
        ),
        F.lit("20251231").alias("end_date_1"),
        *flags,
        k.alias(SOURCE_ORDER),
    )


SQL_TRANSPORTED = """c_transported AS (
  SELECT 'C' || (l_suppkey % 5) AS geo, '' || year(l_shipdate) AS TIME_PERIOD, 'U' || l_linenumber AS unit,
         CASE WHEN l_quantity = 50 THEN ': c' ELSE CAST(l_quantity AS VARCHAR) END AS obs_value
  FROM lineitem)"""


def transported(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("C"), text(F.col("l_suppkey") % 5)).alias("geo"),
        text(F.year("l_shipdate")).alias("TIME_PERIOD"),
        F.concat(F.lit("U"), text("l_linenumber")).alias("unit"),
        F.when(F.col("l_quantity") == 50, F.lit(": c")).otherwise(text("l_quantity")).alias("obs_value"),
    )


SQL_ENERGY = """c_energy AS (
  SELECT 'G' || (l_suppkey % 40) AS geo, l_linestatus AS vehicle, l_returnflag AS mot_nrg,
         '' || year(l_shipdate) AS TIME_PERIOD,
         CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_extendedprice AS VARCHAR) END AS obs_value,
         l_orderkey AS so FROM lineitem)"""


def energy(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("G"), text(F.col("l_suppkey") % 40)).alias("geo"),
        F.col("l_linestatus").alias("vehicle"),
        F.col("l_returnflag").alias("mot_nrg"),
        text(F.year("l_shipdate")).alias("TIME_PERIOD"),
        F.when(F.col("l_quantity") != 50, text("l_extendedprice")).alias("obs_value"),
        F.col("l_orderkey").alias(SOURCE_ORDER),
    )


SQL_REGISTER = """c_register AS (
  SELECT 'Halt ' || (s_suppkey // 2) AS name, CASE WHEN s_suppkey % 8 < 7 THEN 'C' || (s_nationkey % 6) END AS country,
         CASE WHEN s_suppkey % 10 = 9 THEN '?' ELSE '4' || (s_suppkey % 10) || '.25' END AS latitude,
         '2.' || s_suppkey AS longitude, CASE WHEN s_suppkey % 3 = 0 THEN 't' ELSE 'f' END AS is_main_station,
         s_suppkey AS so FROM supplier)"""
SQL_STOPS = """c_stops AS (
  SELECT 'Halt ' || (c_custkey % 500) AS stop_name,
         CASE WHEN c_custkey % 2 = 0 THEN 'Town ' || c_custkey END AS stop_cityname,
         'C' || (c_nationkey % 6) AS stop_country, '4' || (c_custkey % 10) AS stop_lat,
         '' || c_custkey AS stop_lon, c_custkey AS so FROM customer)"""


def register(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(
        F.concat(F.lit("Halt "), text(F.floor(k / 2))).alias("name"),
        F.when(k % 8 < 7, F.concat(F.lit("C"), text(F.col("s_nationkey") % 6))).alias("country"),
        F.when(k % 10 == 9, F.lit("?"))
        .otherwise(F.concat(F.lit("4"), text(k % 10), F.lit(".25")))
        .alias("latitude"),
        F.concat(F.lit("2."), text(k)).alias("longitude"),
        F.when(k % 3 == 0, F.lit("t")).otherwise("f").alias("is_main_station"),
        k.alias(SOURCE_ORDER),
    )


def stops(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        F.concat(F.lit("Halt "), text(k % 500)).alias("stop_name"),
        F.when(k % 2 == 0, F.concat(F.lit("Town "), text(k))).alias("stop_cityname"),
        F.concat(F.lit("C"), text(F.col("c_nationkey") % 6)).alias("stop_country"),
        F.concat(F.lit("4"), text(k % 10)).alias("stop_lat"),
        text(k).alias("stop_lon"),
        k.alias(SOURCE_ORDER),
    )


# ------------------------------------------------------------------ intermodal connections

SQL_CONNECTIONS = """connections AS (
  SELECT 'P' || l_partkey AS origin,
         CASE WHEN l_linenumber = 7 AND l_quantity > 45 THEN ' ' WHEN l_linenumber = 6 AND l_quantity > 45 THEN NULL
              ELSE 'S' || l_suppkey END AS destination,
         CASE WHEN l_returnflag = 'A' THEN NULL ELSE 'Line ' || (l_suppkey % 40) END AS operator,
         CAST(l_quantity AS VARCHAR) AS distance,
         'N' || (l_partkey % 7) AS origin_country, 'N' || (l_suppkey % 7) AS destination_country,
         CAST(40 + l_partkey % 10 + 0.5 AS DOUBLE) AS origin_lat, CAST(l_linenumber + 0.25 AS DOUBLE) AS origin_lon,
         CASE WHEN l_linenumber <> 5 THEN CAST(45 + l_suppkey % 5 AS DOUBLE) END AS destination_lat,
         CASE WHEN l_linenumber <> 5 THEN CAST(l_linenumber + 0.75 AS DOUBLE) END AS destination_lon,
         l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4, l_quantity AS k5,
         l_returnflag AS k6
  FROM lineitem)"""
CONNECTION_ORDER = "k1, k2, k3, k4, k5, k6"


def connections(t: Tables) -> DataFrame:
    """Raw table, names as landed; the source position is the whole line, so it is a total order."""
    p, s, n, q = (F.col(c) for c in ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity"))
    return t.lineitem.select(
        F.concat(F.lit("P"), text(p)).alias("From"),
        F.when((n == 7) & (q > 45), F.lit(" "))
        .when((n == 6) & (q > 45), F.lit(None))
        .otherwise(F.concat(F.lit("S"), text(s)))
        .alias("To"),
        F.when(F.col("l_returnflag") != "A", F.concat(F.lit("Line "), text(s % 40))).alias(" Operator "),
        text(q).alias("Distance"),
        F.concat(text(40 + p % 10), F.lit(".5, "), text(n), F.lit(".25")).alias("Coordinates from"),
        F.when(n == 5, F.lit("unknown"))
        .otherwise(F.concat(text(45 + s % 5), F.lit(" , "), text(n), F.lit(".75")))
        .alias("Coordinates to"),
        F.concat(F.lit("N"), text(p % 7)).alias("From NUTS-0"),
        F.concat(F.lit("N"), text(s % 7)).alias("To NUTS-0"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag").alias(
            SOURCE_ORDER
        ),
    )
