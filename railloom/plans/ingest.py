"""Landed files to the clean zone (ids D16, S15).

A damaged entry costs itself, not its table: what cannot be parsed goes to the table ``quarantine`` with file and position,
and the table is loaded from the rest, unless more than a given share of it is damaged.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railloom.plans import clean
from railloom.plans.intermodal import intermodal_star
from railloom.sources import landed
from railloom.sources.catalog import CUBES, NIGHT_ENTITIES, NightEntity
from railloom.sources.zones import Zone

log = logging.getLogger(__name__)

INTERMODAL = "intermodal"
SNAPSHOT_TABLES = ("dim_gare", "dim_operateur", "dim_route", "dim_train", "dim_date", "fact_trajet_train")


@dataclass(frozen=True)
class Landing:
    """Where the landed files are. ``night_lines`` says that entities are landed as JSON lines."""

    root: str
    night_lines: bool = False
    files: dict[str, str] = field(default_factory=dict)
    most_bad: float = 0.05  # share of damaged entries above which a source is skipped

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.files.get(name, name)}"


QUARANTINE, PLACE = "quarantine", ("source", "file", "block", "line")


@dataclass(frozen=True)
class Parsed:
    """Rows of a table, and the entries of its source that could not be parsed."""

    rows: DataFrame
    sound: DataFrame
    bad: DataFrame


Job = tuple[str, Callable[[], "DataFrame | Parsed | dict[str, DataFrame] | None"]]


def _entity(spark: SparkSession, landing: Landing, entity: NightEntity) -> Parsed:
    read = landed.line_rows if landing.night_lines else landed.keyed_rows
    found = read(spark, landing.path(entity.file))
    return Parsed(clean.clean_night_entity(landed.sound_records(found), entity), found.where("row IS NOT NULL"), landed.bad_records(found))


def jobs(spark: SparkSession, landing: Landing) -> Iterable[Job]:
    """One job per source, in load order."""
    for spec in CUBES:
        yield (
            spec.table,
            lambda s=spec: clean.clean_cube_or_empty(
                landed.read_cube(spark, landing.path(f"{s.dataset}.tsv")), s
            ),
        )
    for entity in NIGHT_ENTITIES:
        yield entity.table, lambda e=entity: _entity(spark, landing, e)
    yield (
        INTERMODAL,
        lambda: intermodal_star(landed.read_unknown_dialect(spark, landing.path("intermodal.csv"))),
    )
    yield (
        "gares_europeennes",
        lambda: clean.clean_stations(
            landed.read_sniffed(spark, landing.path("gares_europeennes.csv"))
        ),
    )
    yield (
        "horaires_des_gares",
        lambda: clean.clean_timetables(
            landed.read_sniffed(spark, landing.path("horaires_des_gares.csv"))
        ),
    )
    yield (
        "co2_emissions",
        lambda: clean.clean_carbon(landed.read_delimited(spark, landing.path("co2_emissions.csv"), ";")),
    )
    yield (
        "sncf_emissions",
        lambda: clean.clean_emission_records(
            landed.complete_records(landed.read_pages(spark, landing.path("sncf_emissions")))
        ),
    )


def _load(zone: Zone, name: str, job: Callable, most_bad: float) -> tuple[dict[str, str], DataFrame | None]:
    """Outcome per table, and the damaged entries if there are any.

    A table is merged into the zone; several tables are one snapshot, which replaces the one before, as the ids inside a
    snapshot are positions in its file and mean nothing to another version of it.
    """
    bad = None
    try:
        made = job()
        if isinstance(made, dict):
            if all(df.isEmpty() for df in made.values()):
                return dict.fromkeys(made, "empty"), None
            zone.replace(made)
            return dict.fromkeys(made, "loaded"), None
        if isinstance(made, Parsed):
            n_bad = made.bad.count()
            if n_bad:
                bad = made.bad.select(F.lit(name).alias("source"), "*")
                n = made.sound.count() + n_bad
                if n_bad > most_bad * n and n_bad > 1:
                    raise ValueError(f"{n_bad} of {n} entries cannot be parsed")
            made = made.rows
        return {name: "loaded" if zone.load(name, made) is not None else "empty"}, bad
    except (PySparkException, Py4JJavaError, ValueError) as error:  # a failing task arrives as the second
        log.warning("source %s skipped: %s", name, error)
        return dict.fromkeys(SNAPSHOT_TABLES if name == INTERMODAL else [name], "skipped"), bad


def ingest(spark: SparkSession, landing: Landing, zone: Zone, at_once: int = 4) -> dict[str, str]:
    """Load every source; a source that fails is skipped and reported, the others go on.

    Spark reports most errors when a job runs, so the guard covers the load, not only the reading. The sources do not
    depend on each other, so some are loaded at once. Damaged entries of all sources are kept in ``quarantine``, each once
    however often its file is loaded. One damaged entry, such as the end of a file that breaks off, never skips a source.
    """
    outcome: dict[str, str] = {}
    damaged: list[DataFrame] = []
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(_load, zone, name, job, landing.most_bad) for name, job in jobs(spark, landing)]
        for done in running:
            found, bad = done.result()
            outcome |= found
            damaged += [] if bad is None else [bad]
    if damaged:
        zone.upsert(QUARANTINE, reduce(DataFrame.unionByName, damaged), list(PLACE))
    return outcome


def manifest_urls(manifests: DataFrame, names: dict[str, str]) -> DataFrame:
    """Table name and url of the first CSV resource, for the datasets that are wanted."""
    wanted = manifests.where(F.col("id").isin(*names))
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return landed.first_csv_resource(wanted).select(
        F.try_element_at(table, F.col("id")).alias("table"), "url"
    )
