"""Statistics over the star (ids QRY11-QRY14, A1-A5).

Facts are aggregated on the foreign key before any dimension is joined: map tasks reduce them to one row
per key, so a key that holds a third of all facts costs a few rows, the join sees one row per key, and
no size assumption about a dimension is needed. Means travel as (sum, count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railloom.functions.measures import rounded_or_zero
from railloom.operators.predicates import contains, where_all


PERFORMANCE = ["average_speed", "duree_minutes", "distance_km"]


def _partials(facts: DataFrame, fk: str, measures: Sequence[str]) -> DataFrame:
    aggs = [f(m).alias(f"{p}_{m}") for m in measures for f, p in ((F.sum, "s"), (F.count, "n"))]
    known = facts.where(F.col(fk).isNotNull())
    return known.groupBy(fk).agg(*aggs, F.count(F.lit(1)).alias("n"))


def _rolled_up(
    partials: DataFrame, fk: str, dim: DataFrame, pk: str, labels: dict[str, str], measures: Sequence[str]
) -> DataFrame:
    """Join the partial sums to the dimension and merge those that share a label."""
    side = dim.select(F.col(pk).alias(fk), *[F.col(c).alias(out) for out, c in labels.items()])
    sums = [F.sum(f"{p}_{m}").alias(f"{p}_{m}") for m in measures for p in ("s", "n")]
    return (
        partials.join(side, fk).groupBy(*labels).agg(*sums, F.sum("n").cast("long").alias("nb_trajets"))
    )


def _mean(measure: str) -> Column:
    return F.try_divide(F.col(f"s_{measure}"), F.col(f"n_{measure}"))


def emissions(
    facts: DataFrame,
    dim_operateur: DataFrame,
    dim_route: DataFrame,
    group_by: str = "operateur",
    operateur: str | None = None,
) -> DataFrame:
    """QRY11: CO2 by operator or by route, optionally for operators whose name contains a term."""
    rows = facts
    if group_by == "route" and operateur:
        keys = where_all(dim_operateur, contains(F.col("agency_name"), operateur)).select(F.col("agency_id").alias("operator_id"))
        rows = facts.join(keys, "operator_id", "left_semi")
    partials = _partials(rows, "route_id" if group_by == "route" else "operator_id", ["emissions_co2"])
    return emissions_of(partials, dim_operateur, dim_route, group_by, operateur)


def emissions_of(
    partials: DataFrame, dim_operateur: DataFrame, dim_route: DataFrame, group_by: str = "operateur", operateur: str | None = None
) -> DataFrame:
    """QRY11 from sums and counts by operator, or by route (of the wanted operators)."""
    measure = ["emissions_co2"]
    if group_by == "route":
        fk, dim, pk, label = "route_id", dim_route, "route_id", "route_long_name"
    else:
        wanted = where_all(dim_operateur, contains(F.col("agency_name"), operateur))
        fk, dim, pk, label = "operator_id", wanted, "agency_id", "agency_name"
    merged = _rolled_up(partials, fk, dim, pk, {"label": label}, measure)
    return merged.orderBy(F.desc_nulls_first("s_emissions_co2"), "label").select(
        "label",
        rounded_or_zero(F.col("s_emissions_co2"), 2).alias("total_emissions_co2"),
        rounded_or_zero(_mean("emissions_co2"), 2).alias("moyenne_emissions_co2"),
        "nb_trajets",
    )


def station_traffic(
    facts: DataFrame, dim_gare: DataFrame, type: str = "depart", pays: str | None = None
) -> DataFrame:
    """QRY12: journeys by station of departure or arrival; the passenger total is a constant 0."""
    fk = "gare_arrivee_id" if type == "arrivee" else "gare_depart_id"
    return traffic_of(_partials(facts, fk, []), fk, dim_gare, pays)


def traffic_of(partials: DataFrame, fk: str, dim_gare: DataFrame, pays: str | None = None) -> DataFrame:
    """QRY12 from counts by station."""
    wanted = where_all(dim_gare, contains(F.col("country"), pays))
    labels = {"gare": "name", "ville": "city", "pays": "country"}
    merged = _rolled_up(partials, fk, wanted, "gare_id", labels, [])
    return merged.orderBy(F.desc("nb_trajets"), *labels).select(
        *labels, F.lit(0.0).alias("total_passengers"), "nb_trajets"
    )


def operator_performance(
    facts: DataFrame, dim_operateur: DataFrame, operateur: str | None = None
) -> DataFrame:
    """QRY13: mean speed, duration and distance by operator, fastest first."""
    return performance_of(_partials(facts, "operator_id", PERFORMANCE), dim_operateur, operateur)


def performance_of(partials: DataFrame, dim_operateur: DataFrame, operateur: str | None = None) -> DataFrame:
    """QRY13 from sums and counts by operator."""
    measure = PERFORMANCE
    wanted = where_all(dim_operateur, contains(F.col("agency_name"), operateur))
    merged = _rolled_up(
        partials,
        "operator_id",
        wanted,
        "agency_id",
        {"operateur": "agency_name"},
        measure,
    )
    return merged.orderBy(_mean("average_speed").desc_nulls_first(), "operateur").select(
        "operateur",
        rounded_or_zero(_mean("average_speed"), 1).alias("vitesse_moyenne_kmh"),
        rounded_or_zero(_mean("duree_minutes"), 1).alias("duree_moyenne_minutes"),
        rounded_or_zero(_mean("distance_km"), 1).alias("distance_moyenne_km"),
        "nb_trajets",
    )


def network_summary(facts: DataFrame) -> DataFrame:
    """QRY14: one row of totals, also over no facts at all."""
    return facts.agg(
        F.count(F.lit(1)).alias("total_trajets"),
        rounded_or_zero(F.sum("emissions_co2"), 2).alias("total_emissions_co2_kg"),
        F.lit(0.0).alias("total_passengers"),
        rounded_or_zero(F.avg("distance_km"), 1).alias("distance_moyenne_km"),
        rounded_or_zero(F.avg("duree_minutes"), 1).alias("duree_moyenne_minutes"),
        rounded_or_zero(F.avg("average_speed"), 1).alias("vitesse_moyenne_kmh"),
    )


def summary_of(partials: DataFrame) -> DataFrame:
    """QRY14 from sums and counts; of no rows too."""
    mean = {m: F.try_divide(F.sum(f"s_{m}"), F.sum(f"n_{m}")) for m in PERFORMANCE}
    return partials.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_trajets"),
        rounded_or_zero(F.sum("s_emissions_co2"), 2).alias("total_emissions_co2_kg"),
        F.lit(0.0).alias("total_passengers"),
        rounded_or_zero(mean["distance_km"], 1).alias("distance_moyenne_km"),
        rounded_or_zero(mean["duree_minutes"], 1).alias("duree_moyenne_minutes"),
        rounded_or_zero(mean["average_speed"], 1).alias("vitesse_moyenne_kmh"),
    )
