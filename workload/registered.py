"""Imports every query module, so that the registry is complete."""

from workload import ingest_side, landed_side, modelling, read_side, scalar_side, served_side, whole_run  # noqa: F401
from workload.catalogue import ORACLES, QUERIES  # noqa: F401
