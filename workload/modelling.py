"""Queries over the modelling side: deduplication, ids, merges, reshaping, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.functions import clock, coerce
from railloom.functions.measures import round_half_up
from railloom.operators import dedup, links, merge, numbering, predicates, quality, reshape
from railloom.operators.columns import SOURCE_ORDER
from railloom.plans import intermodal, warehouse
from railloom.schemas import FACT_GRAIN, KEYS
from workload import views
from workload.catalogue import register, rounded
from workload.views import DAYS, Tables

# ------------------------------------------------------------------ one row per key


@register(
    """SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events)
    WHERE rn = 1"""
)
def latest_event_per_user(t: Tables) -> DataFrame:
    """W2."""
    rows = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    return dedup.latest_per_key(rows, ["user_id"], F.col("ts"), [F.col("event_id")]).drop("ts")


def _per_brand(order: str) -> str:
    return f"""SELECT p_brand, p_partkey, p_name FROM (
      SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey {order}) AS rn FROM part) WHERE rn = 1"""


@register(_per_brand("ASC"))
def keep_first_per_brand(t: Tables) -> DataFrame:
    """W1."""
    rows = t.part.select("p_brand", "p_partkey", "p_name")
    return dedup.keep_first(rows, ["p_brand"], [F.col("p_partkey")])


@register(_per_brand("DESC"))
def keep_last_per_brand(t: Tables) -> DataFrame:
    """W3."""
    return dedup.keep_last(t.part.select("p_brand", "p_partkey", "p_name"), ["p_brand"], ["p_partkey"])


@register(
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_quantity) AS rn
      FROM lineitem WHERE l_quantity > 10) WHERE rn = 1"""
)
def filter_then_dedup(t: Tables) -> DataFrame:
    """J4, default order of the two steps."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return dedup.filter_then_dedup(rows, F.col("l_quantity") > 10, ["l_orderkey"], [F.col("l_linenumber")])


@register(
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_quantity) AS rn
      FROM lineitem) WHERE rn = 1 AND l_quantity > 10"""
)
def dedup_then_filter(t: Tables) -> DataFrame:
    """J4 variant: a rejected first row takes its key with it."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return dedup.dedup_then_filter(rows, F.col("l_quantity") > 10, ["l_orderkey"], [F.col("l_linenumber")])


# ------------------------------------------------------------------ ids


@register(
    """SELECT CAST(row_number() OVER (ORDER BY r_name, n_name) AS INTEGER) AS gare_id, r_name, n_name
    FROM nation JOIN region ON n_regionkey = r_regionkey"""
)
def dense_station_ids(t: Tables) -> DataFrame:
    """W4 on a small table."""
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name")
    return numbering.dense_ids(rows, ["r_name", "n_name"], "gare_id")


@register(
    """SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS nr, o_orderkey FROM orders"""
)
def dense_order_ids(t: Tables) -> DataFrame:
    """W4 over all orders, in a descending order."""
    rows = t.orders.select("o_orderkey", "o_totalprice")
    numbered = numbering.dense_ids(
        rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], "nr", id_type="long"
    )
    return numbered.select("nr", "o_orderkey")


@register(
    """WITH known AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 3 = 0),
    incoming AS (SELECT c_name AS name, c_acctbal FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 <> 0)
    SELECT coalesce(id, (SELECT max(id) FROM known) +
             row_number() OVER (PARTITION BY id IS NULL ORDER BY incoming.name)) AS id,
           incoming.name, c_acctbal
    FROM incoming LEFT JOIN known ON incoming.name = known.name"""
)
def ids_kept_on_reload(t: Tables) -> DataFrame:
    """W4 with known keys: they keep their id, new keys follow the last one."""
    known = t.customer.where("c_custkey % 3 = 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    incoming = t.customer.where("c_custkey % 2 = 0 OR c_custkey % 3 <> 0").select(F.col("c_name").alias("name"), "c_acctbal")
    return numbering.keyed_ids(incoming, known, ["name"], "id", "long")


# ------------------------------------------------------------------ foreign keys and links


@register(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
      AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20)"""
)
def fk_semi_filter(t: Tables) -> DataFrame:
    """J1-J3."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = t.part.where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"))
    suppliers = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return links.valid_only(links.valid_only(rows, parts, "l_partkey"), suppliers, "l_suppkey")


@register(
    """SELECT train_id, operator_id, is_night_train,
      array_to_string(list_sort(list(DISTINCT date_id)), ',') AS date_ids
    FROM v_fact GROUP BY 1, 2, 3""",
    (views.SQL_FACT,),
)
def fact_date_ids(t: Tables) -> DataFrame:
    """A6, O5, P5."""
    folded = links.fold_ids(views.fact(t), ["train_id", "operator_id", "is_night_train"], "date_id")
    return folded.withColumn("date_ids", F.array_join("date_ids", ","))


@register(
    """SELECT o_orderkey, c_name, x.country FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN (SELECT n_nationkey AS k, n_regionkey AS rk, n_name AS country FROM nation) x
      ON c_nationkey = x.k AND o_orderkey % 5 = x.rk"""
)
def left_multi_key_join(t: Tables) -> DataFrame:
    """Left joins, one of them on two keys; unmatched rows keep NULL."""
    named = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(
        t.customer.select("c_custkey", "c_name", "c_nationkey"), "c_custkey", "left"
    )
    places = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("rk"), F.col("n_name").alias("country")
    )
    return (
        named.withColumn("rk", (F.col("o_orderkey") % 5).cast("int"))
        .join(places, ["c_nationkey", "rk"], "left")
        .select("o_orderkey", "c_name", "country")
    )


# ------------------------------------------------------------------ reshape


@register(
    """SELECT l_returnflag AS flag, l_linestatus AS status, measure AS TIME_PERIOD, value AS obs_value FROM (
      SELECT l_returnflag, l_linestatus, sum(l_quantity) AS "2001", sum(l_linenumber)::DOUBLE AS "2002",
             count(*)::DOUBLE AS "2003" FROM lineitem GROUP BY 1, 2)
    UNPIVOT (value FOR measure IN ("2001", "2002", "2003")) WHERE l_returnflag IN ('A', 'N')"""
)
def unpivot_measures(t: Tables) -> DataFrame:
    """Header cell, wide to long, composite key to columns, kept rules."""
    wide = t.lineitem.groupBy(
        F.concat_ws(",", "l_returnflag", "l_linestatus").alias("flag,status\\TIME_PERIOD")
    ).agg(
        F.sum("l_quantity").alias("2001"),
        F.sum("l_linenumber").cast("double").alias("2002"),
        F.count(F.lit(1)).cast("double").alias("2003"),
    )
    first, *periods = wide.columns
    dims, time = reshape.parse_cube_header(first)
    long = reshape.unpivot(wide, [first], periods, time, "obs_value")
    return predicates.keep_rules(reshape.split_key(long, first, dims), [{"flag": "A"}, {"flag": "N"}])


@register(
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS start_date, 'order' AS kind, o_orderstatus AS status
      FROM orders UNION
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE), 'any', 'X' FROM orders"""
)
def union_distinct_periods(t: Tables) -> DataFrame:
    """Repeated groups to rows, then the set of them."""
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    groups = [
        {"start_date": month, "kind": F.lit("order"), "status": F.col("o_orderstatus")},
        {"start_date": month, "kind": F.lit("any"), "status": F.lit("X")},
    ]
    return reshape.stack_groups(t.orders, groups).distinct()


@register(
    """SELECT name, nation, balance, source FROM (
      SELECT *, row_number() OVER (PARTITION BY name, nation ORDER BY pr, nr) AS rn FROM (
        SELECT 'H' || (s_suppkey % 50) AS name, s_nationkey AS nation, s_acctbal AS balance, 'register' AS source,
               0 AS pr, s_suppkey AS nr FROM supplier
        UNION ALL
        SELECT 'H' || (c_custkey % 50), c_nationkey, c_acctbal, 'stop', 1, c_custkey FROM customer)) WHERE rn = 1"""
)
def union_stations_priority(t: Tables) -> DataFrame:
    """Two sources, the first one wins."""
    first = t.supplier.select(
        F.concat(F.lit("H"), (F.col("s_suppkey") % 50).cast("string")).alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
        F.lit("register").alias("source"),
        F.col("s_suppkey").alias("nr"),
    )
    second = t.customer.select(
        F.concat(F.lit("H"), (F.col("c_custkey") % 50).cast("string")).alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.lit("stop").alias("source"),
        F.col("c_custkey").alias("nr"),
    )
    return reshape.union_by_priority([first, second], ["name", "nation"], [F.col("nr")]).drop("nr")


# ------------------------------------------------------------------ merges


@register(
    """WITH old AS (SELECT CASE WHEN c_custkey = 1 THEN NULL ELSE c_custkey END AS k, c_nationkey AS n, c_name, c_acctbal
      FROM customer WHERE c_custkey % 3 <> 0),
    fresh AS (SELECT CASE WHEN c_custkey = 2 THEN NULL ELSE c_custkey END AS k,
      CASE WHEN c_custkey = 2 THEN (SELECT n FROM old WHERE k IS NULL) ELSE c_nationkey END AS n,
      CASE WHEN c_custkey % 10 <> 4 THEN c_acctbal + 100 END AS c_acctbal FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0)
    SELECT coalesce(old.k, fresh.k) AS k, coalesce(old.n, fresh.n) AS n, c_name,
      CASE WHEN fresh.n IS NOT NULL THEN fresh.c_acctbal ELSE old.c_acctbal END AS c_acctbal
    FROM old FULL OUTER JOIN fresh ON old.k IS NOT DISTINCT FROM fresh.k AND old.n = fresh.n"""
)
def upsert_customers(t: Tables) -> DataFrame:
    """Known keys (a NULL one too) take the new balance, even NULL; the name is not in the batch."""
    c = t.customer
    old = c.where("c_custkey % 3 <> 0").select(
        F.when(F.col("c_custkey") != 1, F.col("c_custkey")).alias("k"),
        F.col("c_nationkey").alias("n"),
        "c_name",
        "c_acctbal",
    )
    other = c.where("c_custkey = 1").select((F.col("c_custkey") + 1).alias("c_custkey"), F.col("c_nationkey").alias("_n1"))
    fresh = (
        c.where("c_custkey % 2 = 0 OR c_custkey % 3 = 0")
        .join(other, "c_custkey", "left")
        .select(
            F.when(F.col("c_custkey") != 2, F.col("c_custkey")).alias("k"),
            F.coalesce("_n1", "c_nationkey").alias("n"),
            F.when(F.col("c_custkey") % 10 != 4, F.col("c_acctbal") + 100).alias("c_acctbal"),
        )
    )
    return merge.merge_upsert(old, fresh, ["k", "n"])


@register(
    """SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0
    UNION SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 1"""
)
def insert_only_upsert(t: Tables) -> DataFrame:
    """S12 when every column is key."""
    pairs = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey")
    old = pairs.where("o_orderkey % 2 = 0").drop("o_orderkey").distinct()
    fresh = pairs.where("o_orderkey % 3 = 0 OR o_orderkey % 2 = 1").drop("o_orderkey").distinct()
    return merge.merge_upsert(old, fresh, ["o_custkey", "o_orderstatus"])


# ------------------------------------------------------------------ quality


@register(
    """SELECT count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS rule_0,
      count(*) FILTER (l_linenumber = 7) AS rule_1,
      count(*) FILTER ((l_returnflag = 'R' AND l_linestatus = 'F') OR l_linenumber = 7) AS any_rule,
      count(*) AS n_rows FROM lineitem"""
)
def rule_counts(t: Tables) -> DataFrame:
    """A10, L4."""
    rules = [{"l_returnflag": "R", "l_linestatus": "F"}, {"l_linenumber": 7}]
    return quality.rule_counts(t.lineitem, rules)


@register("SELECT DISTINCT p_type FROM part")
def distinct_types(t: Tables) -> DataFrame:
    """A8."""
    return quality.distinct_values(t.part, "p_type")


@register(
    """SELECT CAST(max(len(string_split(text, ','))) AS INTEGER) AS max_parts FROM documents"""
)
def widest_key(t: Tables) -> DataFrame:
    """A12 over whole texts."""
    return reshape.max_parts(t.documents, "text")


@register(
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def repeated_keys(t: Tables) -> DataFrame:
    """Key check: keys that occur more than once."""
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@register(
    """SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL
    AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"""
)
def unlabelled_documents(t: Tables) -> DataFrame:
    """Foreign-key check: keys without a parent, here documents without a label."""
    return quality.orphans(t.documents, "doc_id", t.labels, "doc_id")


@register("SELECT * FROM region ORDER BY r_regionkey LIMIT 3")
def table_preview(t: Tables) -> DataFrame:
    """S16, O3."""
    from railloom.operators.paging import preview

    return preview(t.region.orderBy("r_regionkey"))


# ------------------------------------------------------------------ dimensions of the warehouse

FIRST = "row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn"

SQL_D_OPERATOR = """d_operator AS (SELECT agency_id, agency_name, agency_url, agency_timezone, agency_lang FROM (
  SELECT trim(agency_id) AS agency_id, agency_name, agency_url, agency_timezone, CAST(NULL AS VARCHAR) AS agency_lang,
    row_number() OVER (PARTITION BY trim(agency_id)
      ORDER BY so, agency_name NULLS FIRST, agency_url NULLS FIRST, agency_timezone NULLS FIRST) AS rn
  FROM c_agencies) WHERE rn = 1)"""


@register("SELECT * FROM d_operator", (views.SQL_AGENCIES, SQL_D_OPERATOR))
def dim_operateur(t: Tables) -> DataFrame:
    """D7."""
    return warehouse.dim_operateur(views.agencies(t))


SQL_D_ROUTE = """d_route AS (SELECT route_id, agency_id, route_long_name, origin, destination, countries FROM (
  SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY so, agency_id, route_long_name) AS rn FROM (
    SELECT CAST(TRY_CAST(trim(route_id) AS DOUBLE) AS INTEGER) AS route_id, trim(agency_id) AS agency_id,
      route_long_name, origin_trip_0 AS origin, destination_trip_0 AS destination,
      CAST(NULL AS VARCHAR) AS countries, so FROM c_routes)
  WHERE route_id IS NOT NULL AND agency_id IN (SELECT agency_id FROM d_operator)) WHERE rn = 1)"""


@register(
    "SELECT * FROM d_route", (views.SQL_AGENCIES, SQL_D_OPERATOR, views.SQL_ROUTES, SQL_D_ROUTE)
)
def dim_route(t: Tables) -> DataFrame:
    """D8."""
    return warehouse.dim_route(views.routes(t), dim_operateur(t))


SQL_MINUTES = """CASE WHEN duration LIKE '__:__' THEN CAST(left(duration, 2) AS DOUBLE) * 60 + CAST(right(duration, 2) AS DOUBLE) END"""

SQL_D_TRAIN = f"""d_train AS (SELECT * EXCLUDE (rn, so) FROM (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY so) AS rn FROM (
    SELECT trim(trip_id) AS trip_id, CAST(route_id AS INTEGER) AS route_id, trip_headsign, trip_origin,
      CASE WHEN left(destination_arrival_time, 2) < '24'
           THEN rpad(destination_arrival_time, 5, ' ')
             || CASE WHEN length(destination_arrival_time) = 8 THEN ':15' ELSE ':00' END
      END AS destination_arrival_time,
      {SQL_MINUTES} AS minutes,
      CAST(distance AS DOUBLE) AS distance,
      coalesce(lower(trim(is_night_train)) IN ('oui', 't'), FALSE) AS is_night_train, so FROM c_trips)
  WHERE trip_id IS NOT NULL AND route_id IN (SELECT route_id FROM d_route)) WHERE rn = 1)"""
SQL_D_TRAINS = (views.SQL_AGENCIES, SQL_D_OPERATOR, views.SQL_ROUTES, SQL_D_ROUTE, views.SQL_TRIPS, SQL_D_TRAIN)


@register("SELECT * FROM d_train", SQL_D_TRAINS)
def dim_train(t: Tables) -> DataFrame:
    """D9; the interval is shown in minutes."""
    train = warehouse.dim_train(views.trips(t), dim_route(t))
    seconds = (
        F.extract(F.lit("DAY"), "duration") * 86400
        + F.extract(F.lit("HOUR"), "duration") * 3600
        + F.extract(F.lit("MINUTE"), "duration") * 60
    )
    return train.withColumn("minutes", (seconds / 60).cast("double")).drop("duration")


def _period_sql(i: int, start: str, end: str) -> str:
    flags = ", ".join(f"coalesce(CAST({d}_{i} AS DOUBLE) = 1, FALSE) AS {d}" for d in DAYS)
    return f"SELECT {start} AS start_date, {end} AS end_date, {flags} FROM c_details"


SQL_D_DATE = f"""d_date AS (SELECT CAST(row_number() OVER (ORDER BY {', '.join(KEYS['dim_date'])}) AS INTEGER) AS date_id, * FROM (
  {_period_sql(0, 'TRY_CAST(start_date_0 AS DATE)', 'CAST(TRY_CAST(end_date_0 AS TIMESTAMP) AS DATE)')}
  UNION {_period_sql(1, "CAST(CAST(left(start_date_1, 19) AS TIMESTAMP) + INTERVAL 5 HOUR AS DATE)", "DATE '2025-12-31'")})
  WHERE start_date IS NOT NULL AND end_date IS NOT NULL)"""


@register("SELECT * FROM d_date", (views.SQL_DETAILS, SQL_D_DATE))
def dim_date(t: Tables) -> DataFrame:
    """D10, W4."""
    return numbering.dense_ids(warehouse.dim_date(views.details(t)), KEYS["dim_date"], "date_id")


@register(
    """SELECT geo, vehicle, energy_type, year, energy_value FROM (
      SELECT *, row_number() OVER (PARTITION BY geo, vehicle, energy_type, year ORDER BY so, energy_value) AS rn FROM (
        SELECT geo, vehicle, mot_nrg AS energy_type, CAST(TIME_PERIOD AS INTEGER) AS year,
          CAST(obs_value AS DOUBLE) AS energy_value, so FROM c_energy) WHERE energy_value IS NOT NULL) WHERE rn = 1""",
    (views.SQL_ENERGY,),
)
def dim_energie(t: Tables) -> DataFrame:
    """D11."""
    return warehouse.dim_energie(views.energy(t))


SQL_D_STATION = """d_station AS (SELECT CAST(row_number() OVER (ORDER BY name, country NULLS FIRST) AS INTEGER) AS gare_id,
  name, city, country, latitude, longitude, is_main_station FROM (
  SELECT *, row_number() OVER (PARTITION BY name, country ORDER BY pr, so) AS rn FROM (
    SELECT name, name AS city, country, TRY_CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
      is_main_station = 't' AS is_main_station, 0 AS pr, so FROM c_register
    UNION ALL
    SELECT stop_name, coalesce(stop_cityname, stop_name), stop_country, CAST(stop_lat AS DOUBLE),
      CAST(stop_lon AS DOUBLE), FALSE, 1, so FROM c_stops)
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL) WHERE rn = 1)"""


@register("SELECT * FROM d_station", (views.SQL_REGISTER, views.SQL_STOPS, SQL_D_STATION))
def dim_gare(t: Tables) -> DataFrame:
    """D12, W4."""
    return numbering.dense_ids(
        warehouse.dim_gare(views.register(t), views.stops(t)), KEYS["dim_gare"], "gare_id"
    )


SQL_D_PASSENGERS = """d_passengers AS (SELECT geo, passengers FROM (
  SELECT geo, passengers, row_number() OVER (PARTITION BY geo ORDER BY TIME_PERIOD DESC, unit, passengers DESC) AS rn
  FROM (SELECT *, TRY_CAST(obs_value AS DOUBLE) AS passengers FROM c_transported) WHERE passengers IS NOT NULL)
  WHERE rn = 1)"""


@register("SELECT * FROM d_passengers", (views.SQL_TRANSPORTED, SQL_D_PASSENGERS))
def latest_passengers(t: Tables) -> DataFrame:
    """W2 with ties."""
    return warehouse.latest_passengers(views.transported(t))


SQL_D_FACT = f"""d_fact AS (
  SELECT train_id, route_id, operator_id, gare_depart_id, gare_arrivee_id, distance_km, duree_minutes, emissions_co2,
    passengers, average_speed, is_night_train,
    coalesce(array_to_string(list_sort(list(DISTINCT date_id) FILTER (date_id IS NOT NULL)), ','), '') AS date_ids
  FROM (
    SELECT trim(trip_id) AS train_id, CAST(t.route_id AS INTEGER) AS route_id, agency_id AS operator_id,
      dep.gare_id AS gare_depart_id, arr.gare_id AS gare_arrivee_id, CAST(distance AS DOUBLE) AS distance_km,
      {SQL_MINUTES} AS duree_minutes, TRY_CAST(co2_per_km AS DOUBLE) AS emissions_co2, p.passengers,
      CAST(v.average_speed AS DOUBLE) AS average_speed,
      coalesce(lower(trim(is_night_train)) IN ('oui', 't'), FALSE) AS is_night_train, dd.date_id
    FROM c_trips t
    LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY so) AS rn FROM c_details)
      WHERE rn = 1) v ON v.route_id = t.route_id
    LEFT JOIN d_date dd ON dd.start_date = TRY_CAST(start_date_0 AS DATE)
      AND dd.end_date = CAST(TRY_CAST(end_date_0 AS TIMESTAMP) AS DATE)
    LEFT JOIN d_station dep ON dep.name = trip_origin AND dep.country = trim(split_part(countries, ',', 1))
    LEFT JOIN d_station arr ON arr.name = trip_headsign AND arr.country = trim(split_part(countries, ',', 3))
    LEFT JOIN d_passengers p ON p.geo = trim(split_part(countries, ',', 1))
    WHERE trip_id IS NOT NULL AND CAST(t.route_id AS INTEGER) IN (SELECT route_id FROM d_route)
      AND agency_id IN (SELECT agency_id FROM d_operator))
  GROUP BY ALL)"""


@register(
    "SELECT * FROM d_fact",
    (
        views.SQL_AGENCIES, SQL_D_OPERATOR, views.SQL_ROUTES, SQL_D_ROUTE, views.SQL_TRIPS, views.SQL_DETAILS,
        SQL_D_DATE, views.SQL_REGISTER, views.SQL_STOPS, SQL_D_STATION, views.SQL_TRANSPORTED, SQL_D_PASSENGERS,
        SQL_D_FACT,
    ),
)
def night_facts(t: Tables) -> DataFrame:
    """J3, J5-J9, W1, W2, C6, C14, C23, A6."""
    facts = warehouse.night_facts(
        views.trips(t),
        views.details(t),
        views.transported(t),
        dim_route(t),
        dim_operateur(t),
        dim_gare(t),
        dim_date(t),
    )
    return facts.select(*FACT_GRAIN, F.array_join("date_ids", ",").alias("date_ids"))


# ------------------------------------------------------------------ intermodal star

ORDER = views.CONNECTION_ORDER

SQL_I_STATION = f"""i_station AS (SELECT CAST(row_number() OVER (ORDER BY role, {ORDER}, name) AS INTEGER) AS gare_id,
  name, CAST(NULL AS VARCHAR) AS city, country, latitude, longitude, FALSE AS is_main_station FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY role, {ORDER}, country, latitude, longitude) AS rn FROM (
    SELECT 0 AS role, origin AS name, origin_country AS country, origin_lat AS latitude, origin_lon AS longitude, {ORDER}
    FROM connections
    UNION ALL SELECT 1, destination, destination_country, destination_lat, destination_lon, {ORDER} FROM connections)
  WHERE trim(name) <> '') WHERE rn = 1)"""


@register("SELECT * FROM i_station", (views.SQL_CONNECTIONS, SQL_I_STATION))
def intermodal_stations(t: Tables) -> DataFrame:
    """P3, P4, C16, U3, L6, W1, W4."""
    return intermodal.stations(intermodal.numbered_connections(views.connections(t)))


@register(
    """SELECT DISTINCT 'OP_' || left(md5(operator), 8) AS agency_id, operator AS agency_name,
      CAST(NULL AS VARCHAR) AS agency_url, CAST(NULL AS VARCHAR) AS agency_country
    FROM connections WHERE trim(operator) <> ''""",
    (views.SQL_CONNECTIONS,),
)
def intermodal_operators(t: Tables) -> DataFrame:
    """C15, A7, L6."""
    return intermodal.operators(intermodal.prepare(views.connections(t)))


SQL_I_ROUTE = f"""i_route AS (SELECT CAST(row_number() OVER (ORDER BY {ORDER}, origin, destination) AS INTEGER) AS route_id,
  'OP_' || left(md5(operator), 8) AS agency_id, origin || ' - ' || destination AS route_long_name, origin, destination,
  origin_country AS countries FROM (
  SELECT *, row_number() OVER (PARTITION BY origin, destination ORDER BY {ORDER}) AS rn FROM connections
  WHERE trim(origin) <> '' AND trim(destination) <> '') WHERE rn = 1)"""


@register("SELECT * FROM i_route", (views.SQL_CONNECTIONS, SQL_I_ROUTE))
def intermodal_routes(t: Tables) -> DataFrame:
    """W1, W4, C18, C19."""
    return intermodal.routes(intermodal.numbered_connections(views.connections(t)))


SQL_I_TRAIN = f"""i_train AS (SELECT 'TR_' || left(md5(length(origin) || ':' || origin || '|' || length(destination) || ':' || destination || '|'
    || coalesce(length(operator) || ':' || operator, '-') || '|' || length(distance) || ':' || distance), 16) AS trip_id, route_id, destination AS trip_headsign,
  t.origin, t.destination, CAST(distance AS DOUBLE) AS distance, FALSE AS is_night_train, {ORDER}
  FROM (SELECT *, row_number() OVER (PARTITION BY origin, destination, operator, distance ORDER BY {ORDER}) AS rn
        FROM connections WHERE origin IS NOT NULL AND destination IS NOT NULL) t
  LEFT JOIN i_route USING (origin, destination) WHERE rn = 1)"""


@register(
    "SELECT trip_id, route_id, trip_headsign, origin, destination, CAST(NULL AS VARCHAR) AS duration, distance,"
    " is_night_train FROM i_train",
    (views.SQL_CONNECTIONS, SQL_I_ROUTE, SQL_I_TRAIN),
)
def intermodal_trains(t: Tables) -> DataFrame:
    """A7, J11, W5."""
    prepared = intermodal.numbered_connections(views.connections(t))
    return intermodal.trains(prepared, intermodal.routes(prepared)).drop(SOURCE_ORDER, intermodal.ROW)


SQL_I_FACT = f"""i_fact AS (SELECT row_number() OVER (ORDER BY {', '.join('c.' + k.strip() for k in ORDER.split(','))}) AS fact_id, l.trip_id AS train_id, l.route_id,
  CASE WHEN trim(operator) <> '' THEN 'OP_' || left(md5(operator), 8) END AS operator_id,
  a.gare_id AS gare_depart_id, b.gare_id AS gare_arrivee_id, CAST(1 AS INTEGER) AS date_id, l.distance AS distance_km,
  {rounded('l.distance * 0.014', 4)} AS emissions_co2
  FROM connections c
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY origin, destination
      ORDER BY {', '.join(k.strip() + ' DESC' for k in ORDER.split(','))}) AS rn FROM i_train) l
    ON l.origin = c.origin AND l.destination = c.destination AND l.rn = 1
  LEFT JOIN i_station a ON a.name = c.origin LEFT JOIN i_station b ON b.name = c.destination
  WHERE c.origin IS NOT NULL AND c.destination IS NOT NULL)"""


@register(
    "SELECT * FROM i_fact",
    (views.SQL_CONNECTIONS, SQL_I_STATION, SQL_I_ROUTE, SQL_I_TRAIN, SQL_I_FACT),
)
def intermodal_facts(t: Tables) -> DataFrame:
    """J10, W3, C22, W4, over the whole bundle."""
    fact = intermodal.intermodal_star(views.connections(t))["fact_trajet_train"]
    return fact.withColumn("emissions_co2", round_half_up(F.col("emissions_co2"), 4)).drop(
        "duree_minutes", "passengers", "average_speed", "is_night_train"
    )
