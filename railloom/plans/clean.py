"""Cleaning jobs from landed tables to the clean zone (ids D1-D5). Narrow plans without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.functions import clock, coerce, measures
from railloom.operators import columns, predicates, reshape
from railloom.operators.columns import SOURCE_ORDER
from railloom.sources import catalog
from railloom.sources.catalog import CubeSpec, NightEntity


class CubeShapeError(ValueError):
    """A composite key of the cube does not have as many parts as the header names."""


def _wanted_period(name: str, since: int | None) -> bool:
    year = name[:4]
    return since is None or not year.isdigit() or int(year) >= since


def melt_cube(raw: DataFrame, since: int | None = None) -> DataFrame:
    """Wide cube to long rows; periods before ``since`` are not even read."""
    wide = columns.trimmed_names(raw)
    first, *rest = [c for c in wide.columns if c != SOURCE_ORDER]
    dims, time = reshape.parse_cube_header(first)
    periods = [c for c in rest if _wanted_period(c, since)]
    ids = [first, *columns.present(wide, [SOURCE_ORDER])]
    long = reshape.unpivot(wide.select(*[F.col(f"`{c}`") for c in [*ids, *periods]]), ids, periods, time, "raw_value")
    return (
        reshape.split_key(long, first, dims)
        .withColumn("obs_value", coerce.first_number(F.col("raw_value")))
        .drop("raw_value")
    )


def check_cube(raw: DataFrame) -> None:
    """The widest composite key must have exactly the parts the header names."""
    wide = columns.trimmed_names(raw)
    first = wide.columns[0]
    dims, _ = reshape.parse_cube_header(first)
    widest = reshape.max_parts(wide, first).head()["max_parts"]
    if widest is not None and widest != len(dims):
        raise CubeShapeError(f"{widest} key parts for {len(dims)} dimensions")


def clean_cube(raw: DataFrame, spec: CubeSpec) -> DataFrame:
    """Long form, unwanted dimensions dropped, text stripped, wanted rows kept.

    A cell without a number keeps its row with a NULL value.
    """
    long = melt_cube(raw, spec.since).drop(*spec.drop)
    return predicates.keep_rules(columns.strip_strings(long), spec.keep)


def clean_cube_or_empty(raw: DataFrame, spec: CubeSpec) -> DataFrame | None:
    """D1 with the shape checks: a cube that cannot be read as one gives no table."""
    try:
        check_cube(raw)
        return clean_cube(raw, spec)
    except (reshape.HeaderError, CubeShapeError):
        return None


def clean_night_entity(df: DataFrame, entity: NightEntity) -> DataFrame:
    """The typed columns and constants of the entity, and its rejected rows out."""
    casts = (
        (entity.timestamps, clock.timestamp_from_text),
        (entity.clocks, clock.loose_time_of_day),
        (entity.strict_clocks, clock.hour_minute),
        (entity.doubles, coerce.to_double),
    )
    typed = {c: cast(F.col(c)) for names, cast in casts for c in columns.present(df, names)}
    # a duration stays text: as a time of day, 24 hours and more would be lost
    for c in columns.present(df, entity.durations):
        text = coerce.strip(F.col(c))
        typed[c] = F.when(clock.duration_minutes(F.col(c)).isNotNull(), text)
    for c, value in entity.constants.items():
        typed[c] = F.lit(value)
    df = df.withColumns(typed) if typed else df
    rejects = [
        predicates.differs(F.col(c), v) for c, v in entity.reject.items() if c in df.columns
    ]
    return predicates.where_all(df, *rejects)


def clean_stations(raw: DataFrame) -> DataFrame:
    """D3: station register."""
    return predicates.require(
        columns.select_present(raw, catalog.STATION_COLUMNS), catalog.STATION_MANDATORY
    )


def clean_timetables(raw: DataFrame) -> DataFrame:
    """D3: station timetables; only complete rows."""
    return predicates.require_all(raw)


def clean_carbon(raw: DataFrame) -> DataFrame:
    """Carbon comparison of train and plane."""
    named = columns.trimmed_names(raw)
    kept = predicates.require(
        columns.select_present(named, catalog.CARBON_COLUMNS), catalog.CARBON_MANDATORY
    )
    return kept.withColumns(
        {c: coerce.to_double(F.col(f"`{c}`")) for c in columns.present(kept, catalog.CARBON_MEASURES)}
    )


def clean_emission_records(records: DataFrame) -> DataFrame:
    """Emission records with an estimated travel time."""
    kept = records.drop(*catalog.EMISSION_DROPPED)
    carrier = columns.optional(kept, "transporteur", "string")
    distance = columns.optional(kept, "distance_entre_les_gares", "double")
    if dict(kept.dtypes).get("distance_entre_les_gares") == "string":
        distance = coerce.to_double(distance)
    return kept.withColumn(
        "duree_estimee_min", measures.estimated_minutes(carrier, distance.cast("double"))
    )
