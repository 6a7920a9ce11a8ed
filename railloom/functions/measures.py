"""Numeric measures: rounding, distance, duration and emission estimates (ids A11, C16, C17, C21-C24)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railloom.functions.coerce import NUMBER, SPACE, matches, strip

# Earth radius in km, emission factor in kg per passenger-km.
EARTH_RADIUS_KM = 6371.0
CO2_KG_PER_KM = 0.014

# Mean speed in km/h by words in the carrier name, tried in this order, and the default.
CARRIER_SPEEDS = (("tgv", 280.0), ("international", 200.0), ("intercités", 140.0), ("ter", 90.0))
DEFAULT_SPEED = 150.0


def round_half_up(c: Column, digits: int) -> Column:
    """Every rounding goes through a decimal, so engines and plans agree on values near a tie."""
    return F.round(c.cast("decimal(38,6)"), digits).cast("double")


def rounded_or_zero(c: Column, digits: int) -> Column:
    """NULL counts as 0, then round."""
    return round_half_up(F.coalesce(c, F.lit(0.0)), digits)


def coordinates(c: Column) -> Column:
    """C16: 'lat, lon' to struct<lat, lon>, NULL unless both parse. Further parts are ignored."""
    both = matches(c, f"{NUMBER}{SPACE},{SPACE}{NUMBER}(?:{SPACE},.*)?")
    lat = strip(F.substring_index(c, ",", 1)).try_cast("double")
    lon = strip(F.substring_index(F.substring_index(c, ",", 2), ",", -1)).try_cast("double")
    return F.when(both, F.struct(lat.alias("lat"), lon.alias("lon")))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """C17: great-circle distance in km, two digits."""
    chord = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    bounded = F.when(chord > 1, 1.0).otherwise(chord)  # rounding may pass 1; least() would lose NULL
    return round_half_up(
        2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(bounded), F.sqrt(1 - bounded)), 2
    )


def carrier_speed(carrier: Column) -> Column:
    """Mean speed by the first matching word of the carrier name."""
    name = F.lower(strip(carrier))
    (word, speed), *rest = CARRIER_SPEEDS
    chosen = F.when(name.contains(word), speed)
    for word, speed in rest:
        chosen = chosen.when(name.contains(word), speed)
    return chosen.otherwise(DEFAULT_SPEED)


def estimated_minutes(carrier: Column, distance_km: Column) -> Column:
    """Distance over the carrier's mean speed, in minutes; NULL without a positive distance."""
    return F.when(
        distance_km > 0, round_half_up(distance_km / carrier_speed(carrier) * 60, 1)
    )


def estimated_emissions(distance_km: Column) -> Column:
    """Kg of CO2 per passenger for a distance."""
    return distance_km * F.lit(CO2_KG_PER_KM)
