"""Filtered, paged listings and detail lookups (ids QRY1-QRY10).

A journey page is cut before it is decorated: filters on a dimension reduce the facts by a semi join, the
page is taken on the fact table alone, and only its rows meet the five dimensions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railloom.functions.clock import interval_text
from railloom.operators.columns import optional
from railloom.operators.paging import Page, take_page
from railloom.operators.predicates import (
    at_least,
    at_most,
    by_key,
    contains,
    either,
    equals,
    equals_id,
    holds_id,
    where_all,
)
from railloom.operators.staging import stage

# The fields of the answers.
GARE = ("gare_id", "name", "city", "country", "latitude", "longitude", "is_main_station")
ROUTE = ("route_id", "agency_id", "route_long_name", "origin", "destination", "countries")
TRAIN = (
    "trip_id", "route_id", "trip_headsign", "origin", "destination", "duration", "distance", "is_night_train",
)
OPERATEUR = ("agency_id", "agency_name", "agency_url", "agency_country")
JOURNEY = ("fact_id", "distance_km", "duree_minutes", "emissions_co2", "average_speed")
LINKS = ("gare_depart_id", "gare_arrivee_id", "train_id", "operator_id", "route_id")


@dataclass(frozen=True)
class Star:
    """The tables a journey query needs."""

    facts: DataFrame
    dim_gare: DataFrame
    dim_train: DataFrame
    dim_operateur: DataFrame
    dim_route: DataFrame
    dim_date: DataFrame | None = None


# ---------------------------------------------------------------- shapes of the dimensions


def stations(dim_gare: DataFrame) -> DataFrame:
    return dim_gare.select(*GARE)


def routes(dim_route: DataFrame) -> DataFrame:
    return dim_route.select(*ROUTE)


def operators(dim_operateur: DataFrame) -> DataFrame:
    """The country of an operator is part of the shape and never known."""
    return dim_operateur.select(*OPERATEUR[:3], F.lit(None).cast("string").alias("agency_country"))


def trains(dim_train: DataFrame, dim_route: DataFrame) -> DataFrame:
    """Origin of the trip, destination of its route, duration as text."""
    ends = dim_route.select("route_id", "destination")
    duration = optional(dim_train, "duration", "interval day to second")
    shaped = dim_train.select(
        "trip_id",
        "route_id",
        "trip_headsign",
        F.col("trip_origin").alias("origin"),
        interval_text(duration).alias("duration"),
        "distance",
        "is_night_train",
    )
    return shaped.join(ends, "route_id", "left").select(*TRAIN)


# ---------------------------------------------------------------- journeys


def journeys_matching(
    star: Star,
    ville_depart: str | None = None,
    ville_arrivee: str | None = None,
    pays_depart: str | None = None,
    pays_arrivee: str | None = None,
    gare_depart_id: int | None = None,
    gare_arrivee_id: int | None = None,
    operateur: str | None = None,
    trip_headsign: str | None = None,
    distance_min: float | None = None,
    distance_max: float | None = None,
    duree_min: float | None = None,
    duree_max: float | None = None,
    date_id: int | None = None,
) -> DataFrame:
    """Facts under the active filters. A dimension is read only if a filter needs it."""
    rows = where_all(
        star.facts,
        equals_id(F.col("gare_depart_id"), gare_depart_id),
        equals_id(F.col("gare_arrivee_id"), gare_arrivee_id),
        at_least(F.col("distance_km"), distance_min),
        at_most(F.col("distance_km"), distance_max),
        at_least(F.col("duree_minutes"), duree_min),
        at_most(F.col("duree_minutes"), duree_max),
        holds_id(F.col("date_ids"), date_id) if date_id is not None else None,
    )
    city, country = F.col("city"), F.col("country")
    links = (
        ("gare_depart_id", star.dim_gare, "gare_id",
         [contains(city, ville_depart), contains(country, pays_depart)]),
        ("gare_arrivee_id", star.dim_gare, "gare_id",
         [contains(city, ville_arrivee), contains(country, pays_arrivee)]),
        ("operator_id", star.dim_operateur, "agency_id",
         [either(contains(F.col("agency_name"), operateur),
                 contains(F.col("agency_id").cast("string"), operateur))]),
        ("train_id", star.dim_train, "trip_id", [contains(F.col("trip_headsign"), trip_headsign)]),
    )
    for fk, dim, pk, conditions in links:
        if any(c is not None for c in conditions):
            keys = where_all(dim, *conditions).select(F.col(pk).alias(fk))
            rows = rows.join(keys, fk, "left_semi")
    return rows


def _nested(prefix: str, fields: Sequence[str], pk: str) -> Column:
    packed = F.struct(*[F.col(f"{prefix}_{c}").alias(c) for c in fields])
    return F.when(F.col(f"{prefix}_{pk}").isNotNull(), packed).alias(prefix)


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}_{c}" for c in df.columns])


def decorate(page: DataFrame, star: Star) -> DataFrame:
    """Nest the five dimensions into the rows of a page; an unknown key gives NULL.

    The page is staged, so its size is known to the planner; every dimension is reduced to the keys of the page
    before it is joined.
    """
    page = stage(page, "page")

    def only(dim: DataFrame, pk: str, *fks: str) -> DataFrame:
        wanted = reduce(DataFrame.union, [page.select(F.col(fk).alias(pk)) for fk in fks])
        return dim.join(wanted, pk, "left_semi")

    gares = only(stations(star.dim_gare), "gare_id", "gare_depart_id", "gare_arrivee_id")
    sides = (
        ("gare_depart", gares, "gare_id", "gare_depart_id", GARE),
        ("gare_arrivee", gares, "gare_id", "gare_arrivee_id", GARE),
        ("train", trains(only(star.dim_train, "trip_id", "train_id"), star.dim_route), "trip_id",
         "train_id", TRAIN),
        ("operateur", only(operators(star.dim_operateur), "agency_id", "operator_id"), "agency_id",
         "operator_id", OPERATEUR),
        ("route", only(routes(star.dim_route), "route_id", "route_id"), "route_id", "route_id", ROUTE),
    )
    out = page
    for prefix, dim, pk, fk, _ in sides:
        out = out.join(_prefixed(dim, prefix), F.col(fk) == F.col(f"{prefix}_{pk}"), "left")
    extras = [c for c in page.columns if c not in (*JOURNEY, *LINKS)]
    return out.select(
        *[c for c in JOURNEY if c in page.columns],
        *[_nested(prefix, fields, pk) for prefix, _, pk, _, fields in sides],
        *extras,
    )


def list_journeys(
    star: Star,
    page: int = 1,
    page_size: int = 20,
    order_by: Sequence[str] = ("fact_id",),
    **filters,
) -> Page:
    """QRY1: filtered journeys, one page, nested dimensions."""
    matches = journeys_matching(star, **filters)
    needed = [c for c in matches.columns if c in {*JOURNEY, *LINKS, *order_by}]
    rows = take_page(matches.select(*needed), order_by, page, page_size)
    extra = [c for c in needed if c not in (*JOURNEY, *LINKS)]
    shaped = decorate(rows, star)
    data = shaped.orderBy(*[c for c in order_by if c in shaped.columns]).drop(*extra)
    return Page(matches, data, page, page_size)


def journey_detail(star: Star, fact_id: int) -> DataFrame:
    """QRY2: one journey with its dimensions; 0 or 1 row."""
    found = by_key(star.facts, "fact_id", fact_id).select(*JOURNEY, *LINKS)
    return decorate(found, star)


def journey_dates(star: Star, fact_id: int) -> DataFrame:
    """QRY2/J15: the service periods in the journey's id array; none when the array is empty."""
    ids = by_key(star.facts, "fact_id", fact_id).select(F.explode("date_ids").alias("date_id")).distinct()
    return star.dim_date.join(ids, "date_id", "left_semi")


# ---------------------------------------------------------------- dimensions


def _page(df: DataFrame, key: str, page: int, page_size: int) -> Page:
    return Page(df, take_page(df, [key], page, page_size), page, page_size)


def list_stations(
    dim_gare: DataFrame,
    name: str | None = None,
    city: str | None = None,
    country: str | None = None,
    is_main_station: bool | None = None,
    page: int = 1,
    page_size: int = 20,
) -> Page:
    """QRY3."""
    found = where_all(
        stations(dim_gare),
        contains(F.col("name"), name),
        contains(F.col("city"), city),
        contains(F.col("country"), country),
        equals(F.col("is_main_station"), is_main_station),
    )
    return _page(found, "gare_id", page, page_size)


def station(dim_gare: DataFrame, gare_id: int) -> DataFrame:
    """QRY4."""
    return by_key(stations(dim_gare), "gare_id", gare_id)


def list_trains(
    dim_train: DataFrame,
    dim_route: DataFrame,
    trip_headsign: str | None = None,
    origin: str | None = None,
    destination: str | None = None,
    is_night_train: bool | None = None,
    page: int = 1,
    page_size: int = 20,
) -> Page:
    """QRY5. Without a filter on the route's destination the page is cut before the route join."""
    found = where_all(
        dim_train,
        contains(F.col("trip_headsign"), trip_headsign),
        contains(F.col("trip_origin"), origin),
        equals(F.col("is_night_train"), is_night_train),
    )
    if destination:
        shaped = where_all(trains(found, dim_route), contains(F.col("destination"), destination))
        return _page(shaped, "trip_id", page, page_size)
    cut = trains(take_page(found, ["trip_id"], page, page_size), dim_route).orderBy("trip_id")
    return Page(found, cut, page, page_size)


def train(dim_train: DataFrame, dim_route: DataFrame, trip_id: object) -> DataFrame:
    """QRY6."""
    return trains(by_key(dim_train, "trip_id", trip_id), dim_route)


def list_operators(
    dim_operateur: DataFrame,
    agency_name: str | None = None,
    agency_country: str | None = None,
    page: int = 1,
    page_size: int = 20,
) -> Page:
    """QRY7. The country is never known, so a filter on it finds nothing."""
    found = where_all(
        operators(dim_operateur),
        contains(F.col("agency_name"), agency_name),
        contains(F.col("agency_country"), agency_country),
    )
    return _page(found, "agency_id", page, page_size)


def operator(dim_operateur: DataFrame, agency_id: object) -> DataFrame:
    """QRY8."""
    return by_key(operators(dim_operateur), "agency_id", agency_id)


def list_routes(
    dim_route: DataFrame,
    origin: str | None = None,
    destination: str | None = None,
    countries: str | None = None,
    page: int = 1,
    page_size: int = 20,
) -> Page:
    """QRY9."""
    found = where_all(
        routes(dim_route),
        contains(F.col("origin"), origin),
        contains(F.col("destination"), destination),
        contains(F.col("countries"), countries),
    )
    return _page(found, "route_id", page, page_size)


def route(dim_route: DataFrame, route_id: object) -> DataFrame:
    """QRY10."""
    return by_key(routes(dim_route), "route_id", route_id)
