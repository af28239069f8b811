"""Every registered query against its SQL, and the plans they must have."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as spark_entry  # noqa: E402
from check import canonical, connect  # noqa: E402
from helpers import plan  # noqa: E402

# Queries of the optional training-data package have tests of their own.
QUERIES = {n: q for n, q in spark_entry.queries().items() if n in spark_entry.catalog.QUERIES}
SQL = {n: s for n, s in spark_entry.oracle_sql().items() if n in QUERIES}
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY and not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf, name):
    got, expected = QUERIES[name](spark, sf).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


def test_flagship(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0 and "velocity_deficit_pct" in df.columns


@pytest.mark.parametrize("name", sorted(n for n in SQL if n[0] in "pfjatv" and not n.startswith("st")))
def test_no_python_in_the_plan(spark, sf, name):
    text = plan(QUERIES[name](spark, sf), "simple")
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_top_k_is_not_a_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan(QUERIES["t01_latest_silver"](spark, sf), "simple")


def test_scans_read_only_needed_columns(spark, sf):
    text = plan(QUERIES["p01_norm_icao24"](spark, sf))
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "event_id" in schema and "props" not in schema and "value" not in schema


@pytest.mark.parametrize("name", ["f06_last_days", "f09_today", "f04_gold_eligible", "t01_latest_silver_nulls_first"])
def test_day_filter_goes_below_the_exchange(spark, sf, name):
    """Only the wanted days are hashed and sorted by record id."""
    text = plan(QUERIES[name](spark, sf), "simple")
    above = text[: text.index("WindowGroupLimit")]
    assert all("recorded_date" not in line for line in above.splitlines() if "Filter" in line)


@pytest.mark.parametrize("name, scans", [("f01_flight_contract", 1), ("s02_bounding_box", 1), ("a07_run_metrics", 2)])
def test_tables_are_read_once(spark, sf, name, scans):
    assert plan(QUERIES[name](spark, sf), "simple").count("FileScan") == scans
