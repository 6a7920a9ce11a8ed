from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from railloom.session import local_session  # noqa: E402
from railloom.sources.zones import Zone  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests",
        "4",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def zone(spark, tmp_path):
    return Zone(spark, f"z_{uuid.uuid4().hex[:8]}", str(tmp_path / "zone")).create()


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    data = [tuple(r) for r in df.collect()]
    return data if order == ("as is",) else sorted(data, key=repr)


def values(df, column):
    return [r[column] for r in df.collect()]
