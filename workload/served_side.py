"""Listings and statistics from the serving tables, after a load and a second one that changes a part of the facts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.operators.staging import scratch_path
from railloom.plans import serving
from railloom.sources.zones import Release, Zone
from workload import views
from workload.catalogue import register, rounded
from workload.read_side import EMISSIONS
from workload.views import Tables

WIDTH = 2000  # small, so that the test tables have many ranges


def served(t: Tables) -> Release:
    """The journeys of all orders: first without the dear ones and with other distances, then as they are."""
    zone = Zone(t.spark, f"served_{uuid.uuid4().hex[:8]}", scratch_path(t.spark, "served")).create()
    facts = views.journey(t)
    dear, near = F.col("distance_km") > 450, F.col("fact_id") < 100
    first = facts.where(~dear).withColumn("distance_km", F.when(near, F.lit(1.0)).otherwise(F.col("distance_km")))
    for version in (first, facts):
        with zone.draft() as draft:
            serving.refresh(draft, version, WIDTH)
    return zone.release()


@register(
    f"SELECT {EMISSIONS} FROM (SELECT agency_name AS label, emissions_co2 FROM v_journey"
    " JOIN v_operator ON operator_id = agency_id) GROUP BY label",
    (views.SQL_STAR,),
)
def served_emissions(t: Tables) -> DataFrame:
    """QRY11 from maintained sums and counts."""
    return serving.emissions(served(t), views.operator(t), views.route(t))


@register(
    f"""SELECT count(*) AS total_trajets, {rounded('coalesce(sum(emissions_co2), 0)', 2)} AS total_emissions_co2_kg,
    CAST(0 AS DOUBLE) AS total_passengers, {rounded('coalesce(avg(distance_km), 0)', 1)} AS distance_moyenne_km,
    {rounded('coalesce(avg(duree_minutes), 0)', 1)} AS duree_moyenne_minutes,
    {rounded('coalesce(avg(average_speed), 0)', 1)} AS vitesse_moyenne_kmh FROM v_journey""",
    (views.SQL_STAR,),
)
def served_summary(t: Tables) -> DataFrame:
    """QRY14 from maintained sums and counts."""
    return serving.network_summary(served(t))


@register(
    f"SELECT fact_id, train_id, {rounded('distance_km', 3)} AS distance_km FROM v_journey ORDER BY fact_id LIMIT 20 OFFSET 9980",
    (views.SQL_STAR,),
)
def served_deep_page(t: Tables) -> DataFrame:
    """O2, QRY1: page 500 of 20, out of the one range that holds it."""
    rows = serving.page(served(t), 500, 20)
    return rows.select("fact_id", "train_id", F.round("distance_km", 3).alias("distance_km"))


@register(
    "SELECT fact_id, train_id FROM v_journey WHERE list_contains(date_ids, 3) ORDER BY fact_id LIMIT 20 OFFSET 200",
    (views.SQL_STAR,),
)
def served_date_page(t: Tables) -> DataFrame:
    """Page 11 of the journeys on a date, from the inverted table."""
    return serving.page_on_date(served(t), 3, 11, 20).select("fact_id", "train_id")
