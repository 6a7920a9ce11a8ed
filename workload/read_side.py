"""Queries over the star: statistics, listings, details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.operators import links, predicates
from railloom.plans import analytics, listings
from workload import views
from workload.catalogue import register, rounded
from workload.views import Tables

EMISSIONS = (
    f"label, {rounded('coalesce(sum(emissions_co2), 0)', 2)} AS total_emissions_co2, "
    f"{rounded('coalesce(avg(emissions_co2), 0)', 2)} AS moyenne_emissions_co2, count(*) AS nb_trajets"
)


def _emissions(t: Tables, **kw) -> DataFrame:
    return analytics.emissions(views.fact(t), views.operator(t), views.route(t), **kw)


@register(
    f"SELECT {EMISSIONS} FROM (SELECT agency_name AS label, emissions_co2 FROM v_fact"
    " JOIN v_operator ON operator_id = agency_id) GROUP BY label",
    (views.SQL_FACT, views.SQL_OPERATOR),
)
def emissions_by_operator(t: Tables) -> DataFrame:
    """QRY11, A1, J14, A11, O1."""
    return _emissions(t)


@register(
    f"SELECT {EMISSIONS} FROM (SELECT route_long_name AS label, emissions_co2 FROM v_fact"
    " JOIN v_route USING (route_id)) GROUP BY label",
    (views.SQL_FACT, views.SQL_ROUTE),
)
def emissions_by_route(t: Tables) -> DataFrame:
    """QRY11, A2."""
    return _emissions(t, group_by="route")


@register(
    f"SELECT {EMISSIONS} FROM (SELECT route_long_name AS label, emissions_co2 FROM v_fact"
    " JOIN v_route USING (route_id) JOIN v_operator o ON operator_id = o.agency_id"
    " WHERE agency_name ILIKE '%#0000000_1%') GROUP BY label",
    (views.SQL_FACT, views.SQL_ROUTE, views.SQL_OPERATOR),
)
def emissions_by_route_for_operator(t: Tables) -> DataFrame:
    """QRY11 with both parameters: the operator filter is a join on its key."""
    return _emissions(t, group_by="route", operateur="#0000000_1")


@register(
    f"SELECT {EMISSIONS} FROM (SELECT agency_name AS label, emissions_co2 FROM v_fact"
    " JOIN v_operator ON operator_id = agency_id WHERE agency_name ILIKE '%SUPPLIER%7%') GROUP BY label",
    (views.SQL_FACT, views.SQL_OPERATOR),
)
def emissions_for_operator(t: Tables) -> DataFrame:
    """QRY11, L8: the term is matched in any case and its % stays a wildcard."""
    return _emissions(t, operateur="SUPPLIER%7")


def _traffic_sql(view: str, fk: str, where: str = "") -> str:
    return (
        "SELECT name AS gare, city AS ville, country AS pays, CAST(0 AS DOUBLE) AS total_passengers,"
        f" count(*) AS nb_trajets FROM {view} JOIN v_station ON {fk} = gare_id {where} GROUP BY 1, 2, 3"
    )


@register(
    _traffic_sql("v_fact_depart", "gare_depart_id"), (views.SQL_FACT_DEPART, views.SQL_STATION)
)
def traffic_departure(t: Tables) -> DataFrame:
    """QRY12, A3, J17."""
    return analytics.station_traffic(views.fact_depart(t), views.station(t))


@register(
    _traffic_sql("v_fact_arrivee", "gare_arrivee_id", "WHERE country ILIKE '%ic%'"),
    (views.SQL_FACT_ARRIVEE, views.SQL_STATION),
)
def traffic_arrival(t: Tables) -> DataFrame:
    """QRY12 for arrivals in some countries."""
    return analytics.station_traffic(views.fact_arrivee(t), views.station(t), "arrivee", "ic")


@register(
    f"""SELECT agency_name AS operateur, {rounded('coalesce(avg(average_speed), 0)', 1)} AS vitesse_moyenne_kmh,
    {rounded('coalesce(avg(duree_minutes), 0)', 1)} AS duree_moyenne_minutes,
    {rounded('coalesce(avg(distance_km), 0)', 1)} AS distance_moyenne_km, count(*) AS nb_trajets
    FROM v_fact JOIN v_operator ON operator_id = agency_id GROUP BY 1""",
    (views.SQL_FACT, views.SQL_OPERATOR),
)
def operator_performance(t: Tables) -> DataFrame:
    """QRY13, A4."""
    return analytics.operator_performance(views.fact(t), views.operator(t))


@register(
    f"""SELECT count(*) AS total_trajets, {rounded('coalesce(sum(emissions_co2), 0)', 2)} AS total_emissions_co2_kg,
    CAST(0 AS DOUBLE) AS total_passengers, {rounded('coalesce(avg(distance_km), 0)', 1)} AS distance_moyenne_km,
    {rounded('coalesce(avg(duree_minutes), 0)', 1)} AS duree_moyenne_minutes,
    {rounded('coalesce(avg(average_speed), 0)', 1)} AS vitesse_moyenne_kmh FROM v_fact""",
    (views.SQL_FACT,),
)
def network_summary(t: Tables) -> DataFrame:
    """QRY14, A5."""
    return analytics.network_summary(views.fact(t))


# ------------------------------------------------------------------ journeys

JOURNEY_COLUMNS = f"""j.fact_id, {rounded('j.distance_km', 3)} AS distance_km, j.duree_minutes,
  {rounded('j.emissions_co2', 4)} AS emissions_co2, {rounded('j.average_speed', 3)} AS average_speed,
  d.name AS depart_name, d.country AS depart_country, a.city AS arrivee_city, a.latitude AS arrivee_latitude,
  tr.origin AS train_origin, tr.destination AS train_destination, tr.duration AS train_duration,
  tr.is_night_train AS train_is_night, o.agency_name AS operateur_name, r.route_long_name AS route_name,
  a.gare_id IS NULL AS arrivee_unknown"""
JOURNEY_JOINS = """FROM v_journey j LEFT JOIN v_station d ON j.gare_depart_id = d.gare_id
  LEFT JOIN v_station a ON j.gare_arrivee_id = a.gare_id LEFT JOIN v_train_shape tr ON j.train_id = tr.trip_id
  LEFT JOIN v_operator o ON j.operator_id = o.agency_id LEFT JOIN v_route r ON j.route_id = r.route_id"""


def _flat(journeys: DataFrame) -> DataFrame:
    from railloom.functions.measures import round_half_up

    return journeys.select(
        "fact_id",
        round_half_up(F.col("distance_km"), 3).alias("distance_km"),
        "duree_minutes",
        round_half_up(F.col("emissions_co2"), 4).alias("emissions_co2"),
        round_half_up(F.col("average_speed"), 3).alias("average_speed"),
        F.col("gare_depart.name").alias("depart_name"),
        F.col("gare_depart.country").alias("depart_country"),
        F.col("gare_arrivee.city").alias("arrivee_city"),
        F.col("gare_arrivee.latitude").alias("arrivee_latitude"),
        F.col("train.origin").alias("train_origin"),
        F.col("train.destination").alias("train_destination"),
        F.col("train.duration").alias("train_duration"),
        F.col("train.is_night_train").alias("train_is_night"),
        F.col("operateur.agency_name").alias("operateur_name"),
        F.col("route.route_long_name").alias("route_name"),
        F.col("gare_arrivee").isNull().alias("arrivee_unknown"),
    )


@register(
    f"SELECT {JOURNEY_COLUMNS} {JOURNEY_JOINS} ORDER BY j.fact_id LIMIT 20 OFFSET 20", (views.SQL_STAR,)
)
def journeys_page(t: Tables) -> DataFrame:
    """QRY1, J12, O2, P9: second page without a filter."""
    return _flat(listings.list_journeys(views.star(t), page=2).data)


@register(
    f"""SELECT {JOURNEY_COLUMNS} {JOURNEY_JOINS}
    WHERE d.city ILIKE '%nation_1%' AND a.country ILIKE '%a%' AND (o.agency_name ILIKE '%0_1%' OR
      CAST(o.agency_id AS VARCHAR) ILIKE '%0_1%') AND tr.trip_headsign ILIKE '%i%'
      AND j.distance_km >= 50 AND j.distance_km <= 400 AND j.duree_minutes >= 60 AND j.duree_minutes <= 580
    ORDER BY j.fact_id LIMIT 50""",
    (views.SQL_STAR,),
)
def journeys_filtered(t: Tables) -> DataFrame:
    """QRY1, L8, L9, L11, L15, J13: filters over all dimensions."""
    page = listings.list_journeys(
        views.star(t),
        ville_depart="nation_1",
        pays_arrivee="a",
        operateur="0_1",
        trip_headsign="i",
        distance_min=50,
        distance_max=400,
        duree_min=60,
        duree_max=580,
        page_size=50,
    )
    return _flat(page.data)


@register(
    """SELECT count(*) AS total FROM v_journey j JOIN v_station d ON j.gare_depart_id = d.gare_id
    WHERE d.country ILIKE '%a%' AND j.distance_km >= 100 AND j.gare_arrivee_id = 3""",
    (views.SQL_STAR,),
)
def journeys_total(t: Tables) -> DataFrame:
    """Number of matches of a filtered listing."""
    found = listings.journeys_matching(
        views.star(t), pays_depart="a", distance_min=100, gare_arrivee_id=3, gare_depart_id=0
    )
    return found.agg(F.count(F.lit(1)).alias("total"))


@register(
    """SELECT gare_depart_id, count(*) AS n, min(fact_id) AS first_fact FROM v_journey
    WHERE list_contains(date_ids, 3) GROUP BY 1""",
    (views.SQL_STAR,),
)
def journeys_on_date(t: Tables) -> DataFrame:
    """Journeys whose id array holds a date, counted per station."""
    found = listings.journeys_matching(views.star(t), date_id=3)
    return found.groupBy("gare_depart_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("fact_id").alias("first_fact")
    )


@register(f"SELECT {JOURNEY_COLUMNS} {JOURNEY_JOINS} WHERE j.fact_id = 77", (views.SQL_STAR,))
def journey_detail(t: Tables) -> DataFrame:
    """QRY2, L14."""
    return _flat(listings.journey_detail(views.star(t), 77))


@register(
    """SELECT date_id, start_date, end_date FROM v_date
    WHERE date_id IN (SELECT unnest(date_ids) FROM v_journey WHERE fact_id = 77)""",
    (views.SQL_STAR,),
)
def journey_detail_dates(t: Tables) -> DataFrame:
    """QRY2, J15: the service periods of one journey."""
    return listings.journey_dates(views.star(t), 77)


@register(
    """SELECT x.date_id, start_date, count(*) AS n_journeys FROM
    (SELECT unnest(date_ids) AS date_id FROM v_journey) x JOIN v_date ON x.date_id = v_date.date_id
    GROUP BY 1, 2""",
    (views.SQL_STAR,),
)
def journeys_per_period(t: Tables) -> DataFrame:
    """Array link to the periods over all journeys."""
    s = views.star(t)
    linked = links.explode_link(s.facts.select("date_ids"), "date_ids", s.dim_date, "date_id")
    return linked.groupBy("date_id", "start_date").agg(F.count(F.lit(1)).alias("n_journeys"))


# ------------------------------------------------------------------ dimensions


@register(
    """SELECT * FROM v_station WHERE name ILIKE '%n_1%' AND country ILIKE '%A%' AND is_main_station
    ORDER BY gare_id LIMIT 3 OFFSET 3""",
    (views.SQL_STATION,),
)
def stations_page(t: Tables) -> DataFrame:
    """QRY3, L8, L10."""
    return listings.list_stations(
        views.station(t), name="n_1", city="", country="A", is_main_station=True, page=2, page_size=3
    ).data


@register("SELECT * FROM v_station WHERE gare_id = 7", (views.SQL_STATION,))
def station_by_id(t: Tables) -> DataFrame:
    """QRY4."""
    return listings.station(views.station(t), 7)


@register(
    """SELECT * FROM v_train_shape WHERE trip_headsign ILIKE '%urg%' AND origin ILIKE '%f%'
    AND destination ILIKE '%o%' AND NOT is_night_train ORDER BY trip_id LIMIT 20 OFFSET 40""",
    (views.SQL_ROUTE, views.SQL_TRAIN, views.SQL_TRAIN_SHAPE),
)
def trains_page(t: Tables) -> DataFrame:
    """QRY5, J16, P8: filter on the destination of the route."""
    return listings.list_trains(
        views.train(t),
        views.route(t),
        trip_headsign="urg",
        origin="f",
        destination="o",
        is_night_train=False,
        page=3,
    ).data


@register(
    "SELECT * FROM v_train_shape WHERE is_night_train ORDER BY trip_id LIMIT 25",
    (views.SQL_ROUTE, views.SQL_TRAIN, views.SQL_TRAIN_SHAPE),
)
def night_trains_page(t: Tables) -> DataFrame:
    """QRY5: the page is cut before the route join."""
    return listings.list_trains(
        views.train(t), views.route(t), is_night_train=True, page_size=25
    ).data


@register(
    "SELECT * FROM v_train_shape WHERE trip_id = 123",
    (views.SQL_ROUTE, views.SQL_TRAIN, views.SQL_TRAIN_SHAPE),
)
def train_by_id(t: Tables) -> DataFrame:
    """QRY6."""
    return listings.train(views.train(t), views.route(t), 123)


@register(
    """SELECT *, CAST(NULL AS VARCHAR) AS agency_country FROM v_operator WHERE agency_name ILIKE '%0_5%'
    ORDER BY agency_id LIMIT 20""",
    (views.SQL_OPERATOR,),
)
def operators_page(t: Tables) -> DataFrame:
    """QRY7."""
    return listings.list_operators(views.operator(t), agency_name="0_5").data


@register(
    "SELECT *, CAST(NULL AS VARCHAR) AS agency_country FROM v_operator WHERE agency_id = 5",
    (views.SQL_OPERATOR,),
)
def operator_by_id(t: Tables) -> DataFrame:
    """QRY8."""
    return listings.operator(views.operator(t), 5)


@register(
    """SELECT agency_id, agency_name FROM v_operator WHERE agency_name ILIKE '%0_7%'
    OR CAST(agency_id AS VARCHAR) ILIKE '%7_%'""",
    (views.SQL_OPERATOR,),
)
def operator_name_or_id(t: Tables) -> DataFrame:
    """L9."""
    found = predicates.where_all(
        views.operator(t),
        predicates.either(
            predicates.contains(F.col("agency_name"), "0_7"),
            predicates.contains(F.col("agency_id").cast("string"), "7_"),
        ),
    )
    return found.select("agency_id", "agency_name")


@register(
    """SELECT * FROM v_route WHERE origin ILIKE '%#1%' AND destination ILIKE '%s%' AND countries ILIKE '%ring%'
    ORDER BY route_id LIMIT 10 OFFSET 10""",
    (views.SQL_ROUTE,),
)
def routes_page(t: Tables) -> DataFrame:
    """QRY9."""
    return listings.list_routes(
        views.route(t), origin="#1", destination="s", countries="ring", page=2, page_size=10
    ).data


@register("SELECT * FROM v_route WHERE route_id = 42", (views.SQL_ROUTE,))
def route_by_id(t: Tables) -> DataFrame:
    """QRY10."""
    return listings.route(views.route(t), 42)
