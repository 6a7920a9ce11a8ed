"""Every registered query against its SQL in DuckDB, on the smallest scale factor."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402
from workload import registered  # noqa: E402
import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.oracle(SF)


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registered.QUERIES) == set(registered.ORACLES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "total_emissions_co2", "moyenne_emissions_co2", "nb_trajets"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toArrow()
    want = con.execute(entry.oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert check.canonical(got) == check.canonical(want)
    assert check.types(got) == check.types(want)
