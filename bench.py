"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (folder of the tables), ``BENCH_CPUS`` (cores),
``BENCH_RUNS`` (timed runs after one warm-up; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from aerocell.operators import enrich, gold, maintenance, reports  # noqa: E402
from aerocell.plans import catalog  # noqa: E402
from aerocell.plans import fixtures as fx  # noqa: E402
from aerocell.plans.pipeline import tagged_flights  # noqa: E402
from aerocell.schemas import GOLD, SILVER  # noqa: E402
from aerocell.session import local_session, materialise, scratch_database  # noqa: E402
from aerocell.sources import tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Registered queries, from the raw tables to the result.
FROM_RAW = [
    "s01_parse_state_payload",
    "p08_geohash_encode",
    "f01_flight_contract",
    "j01_enrich",
    "j02_latest_weather",
    "a01_gold_matrix",
    "a03_hourly_trends",
    "a05_explore_kpis",
    "t01_latest_silver",
    "d01_insert_ignore",
    "d02_upsert_gold",
    "st1_stream_pipeline",
]


def on_stored_tables(spark) -> dict:
    """Single operators over tables at rest."""
    database = scratch_database(spark)
    tables.create_tables(spark, database)
    silver, matrix = f"{database}.silver", f"{database}.gold"
    weather = materialise(fx.weather(spark, SF_DIR), "weather")
    flights = materialise(tagged_flights(fx.flights_raw(spark, SF_DIR)), "flights")
    tables.write_table(fx.silver(spark, SF_DIR), silver, SILVER)
    tables.write_table(gold.gold_matrix(spark.table(silver)), matrix, GOLD)
    delta = gold.gold_matrix(spark.table(silver).filter(F.col("recorded_date") >= F.lit(fx.UPSERT_FROM)))
    delta = materialise(delta, "delta")
    return {
        "stored_enrich": lambda: enrich.enrich(flights, weather, ("cycle_id", "geohash"), weather_order=()),
        "stored_gold_matrix": lambda: gold.gold_matrix(spark.table(silver)),
        "stored_gold_one_day": lambda: gold.gold_matrix(spark.table(silver), fx.FLAGSHIP_DAY),
        "stored_hourly_trends": lambda: reports.hourly_trends(spark.table(matrix), fx.AS_OF),
        "stored_latest_silver": lambda: reports.latest_silver(spark.table(silver)),
        "stored_upsert_gold": lambda: maintenance.upsert_gold(spark, matrix, delta, stored=True),
    }


def run(action) -> float:
    started = time.perf_counter()
    result = action()
    if hasattr(result, "write"):
        result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def measure(action) -> float:
    run(action)
    return round(statistics.median(run(action) for _ in range(RUNS)), 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    timings = {}
    for name, action in on_stored_tables(spark).items():
        timings[name] = measure(action)
    for name in FROM_RAW:
        timings[name] = measure(lambda query=catalog.QUERIES[name]: query(spark, SF_DIR))
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(Path(SF_DIR).name.removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
