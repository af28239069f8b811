import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from helpers import UTC, plan, silver_of, silver_row

from aerocell.operators import gold, maintenance, reports
from aerocell.schemas import GOLD_KEYS, GOLD_SCHEMA, SILVER
from aerocell.sources import tables

DAY = dt.date(2027, 5, 19)


def at(hour, minute=0, day=8):
    return dt.datetime(2027, 5, day, hour, minute, tzinfo=UTC)


STORM = dict(
    convective_risk_score=75.0, precipitation_mm=4.0, wind_speed_mps=15.0, wind_gusts_mps=25.0, cloud_cover_pct=90.0,
)


def test_known_row(spark):
    rows = [
        silver_row(1, icao24="a1", velocity_mps=180.0, baro_altitude_m=8000.0, weather_recorded_at=at(14, 15), **STORM),
        silver_row(2, icao24="a2", velocity_mps=170.0, baro_altitude_m=9000.0, weather_recorded_at=at(14, 45), **STORM),
    ]
    result = gold.gold_matrix(silver_of(spark, rows), DAY)
    assert result.columns == GOLD_SCHEMA.names
    row = result.collect()
    assert len(row) == 1
    r = row[0]
    assert (r["total_active_flights"], r["total_cruising_flights"], r["flights_impacted_count"]) == (2, 2, 2)
    assert (r["avg_velocity_mps"], r["velocity_deficit_pct"]) == (175.0, 23.91)
    assert r["weather_condition_category"] == "SEVERE_STORM" and r["min_visibility_m"] == 10000.0
    assert r["window_end"] - r["window_start"] == dt.timedelta(hours=1)


def two_decimals(x):
    return float(Decimal(repr(round(x, 6))).quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_matrix_equals_brute_force_with_a_hot_cell(spark):
    rng = random.Random(11)
    rows = []
    for n in range(2000):
        rows.append(
            silver_row(
                n,
                icao24=f"a{rng.randrange(40)}",
                # A third of the reports in one cell.
                geohash="dr5r" if n % 3 == 0 else rng.choice(["dr72", "gcps", "u09t"]),
                recorded_date=dt.date(2027, 5, rng.choice([7, 8])),
                weather_recorded_at=rng.choice([None, at(rng.randrange(24), rng.randrange(60))]),
                velocity_mps=rng.choice([None, round(rng.uniform(50, 300), 2)]),
                baro_altitude_m=rng.choice([None, 2999.0, 3000.0, 9000.0]),
                convective_risk_score=rng.choice([10.0, 50.0, 70.0]),
                precipitation_mm=rng.choice([None, 0.5, 0.1]),
                visibility_m=rng.choice([None, 2000.0, 9000.0]),
            )
        )
    expected = {}
    for r in rows:
        if r["weather_recorded_at"] is None or r["velocity_mps"] is None:
            continue
        rain, sight = r["precipitation_mm"], r["visibility_m"]
        if r["convective_risk_score"] >= 60:
            kind = "SEVERE_STORM"
        elif rain is not None and rain >= 0.5:
            kind = "MODERATE_RAIN"
        elif sight is not None and sight < 3000:
            kind = "LOW_VISIBILITY"
        else:
            kind = "CLEAR"
        start = r["weather_recorded_at"].replace(minute=0, tzinfo=None)
        expected.setdefault((start, r["geohash"], kind, r["recorded_date"]), []).append(r)
    got = {tuple(r[k] for k in GOLD_KEYS): r for r in gold.gold_matrix(silver_of(spark, rows)).collect()}
    assert got.keys() == expected.keys()
    for key, members in expected.items():
        r = got[key]
        mean = sum(m["velocity_mps"] for m in members) / len(members)
        assert r["total_active_flights"] == len({m["icao24"] for m in members})
        assert r["total_cruising_flights"] == sum((m["baro_altitude_m"] or 0) >= 3000 for m in members)
        assert r["flights_impacted_count"] == sum(m["convective_risk_score"] >= 50 for m in members)
        assert r["avg_velocity_mps"] == two_decimals(mean)
        assert r["velocity_deficit_pct"] == two_decimals((230 - mean) / 230 * 100)
        assert r["max_precipitation_mm"] == max(m["precipitation_mm"] or 0.0 for m in members)
        assert r["min_visibility_m"] == min(m["visibility_m"] or 10000.0 for m in members)


def test_days_prune_partitions(spark, database):
    rows = [silver_row(n, recorded_date=dt.date(2027, 5, 1 + n % 10)) for n in range(40)]
    tables.write_table(silver_of(spark, rows), f"{database}.silver", SILVER)
    matrix = gold.gold_matrix(spark.table(f"{database}.silver"), [DAY, dt.date(2027, 5, 20)])
    text = plan(matrix)
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "recorded_date" in filters and "2027-05-19" in filters
    columns = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "callsign" not in columns and "squawk" not in columns


def _gold(spark, table):
    return {tuple(r[k] for k in GOLD_KEYS): r["avg_velocity_mps"] for r in spark.table(table).collect()}


def test_upsert_replaces_inserts_and_keeps_stale_keys(spark, database):
    silver, target = f"{database}.silver", f"{database}.gold"
    first = [silver_row(1, velocity_mps=100.0), silver_row(2, geohash="gcps", recorded_date=dt.date(2027, 5, 7))]
    tables.write_table(silver_of(spark, first), silver, SILVER)
    assert maintenance.refresh_gold(spark, silver, target, [DAY, dt.date(2027, 5, 7)]) == 2
    before = _gold(spark, target)
    # The cell turns stormy and a second aircraft appears: a new key, the old one stays.
    delta = gold.gold_matrix(silver_of(spark, [silver_row(3, velocity_mps=150.0, **STORM), silver_row(4, velocity_mps=120.0)]))
    for _ in range(2):
        assert maintenance.upsert_gold(spark, target, delta) == 2
        after = _gold(spark, target)
        assert len(after) == 3
        assert {k[2]: v for k, v in after.items() if k[3] == DAY} == {"CLEAR": 120.0, "SEVERE_STORM": 150.0}
        # A day the delta does not touch is left alone.
        assert [v for k, v in after.items() if k[3] != DAY] == [v for k, v in before.items() if k[3] != DAY]


def test_empty_delta_changes_nothing(spark, database):
    silver, target = f"{database}.silver", f"{database}.gold"
    tables.write_table(silver_of(spark, [silver_row(1)]), silver, SILVER)
    maintenance.refresh_gold(spark, silver, target, DAY)
    assert maintenance.refresh_gold(spark, silver, target, dt.date(2020, 1, 1)) == 0
    assert len(_gold(spark, target)) == 1


def test_failed_lookup_scores_clear_but_stays_out_of_the_matrix(spark):
    rows = [silver_row(1, weather_recorded_at=None, convective_risk_score=0.0), silver_row(2)]
    df = silver_of(spark, rows)
    assert gold.gold_matrix(df).count() == 1
    shown = reports.explorer_rows(df).collect()
    assert {r["hazard_category"] for r in shown} == {"CLEAR"}
