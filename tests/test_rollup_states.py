"""Mergeable rollup states: exactness after late loads, repeated loads, sketch errors."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from urbanpulse.operators import rollup_states as R
from urbanpulse.operators.kpis import kpi_weather_impact
from urbanpulse.operators.rollups import agg_hourly_congestion


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def fact(spark):
    start = datetime(2024, 3, 1)
    data = []
    for k in range(6_000):
        at = start + timedelta(minutes=(k * 37) % 4_000)
        data.append((f"V{(k * k) % 900}", f"R{1 + k % 5}00", ["CBD", "HARBOR"][k % 2], None if k % 50 == 0 else (k * 7919) % 181,
                     None if k % 70 == 0 else 1 + k % 5, ["RAIN", "FOG", None][k % 3], at, at.date(), at.hour, k % 4))
    return spark.createDataFrame(data, "vehicle_id string, road_id string, city_zone string, speed_kmh int, congestion_level int, "
                                       "weather string, event_ts timestamp, event_date date, event_hour int, load int").persist()


@pytest.fixture(scope="module")
def roads(spark):
    return spark.createDataFrame([("R100", 100), ("R200", 100), ("R300", 60), ("R400", 50)], "road_id string, speed_limit_kmh int")


def test_late_loads_merge_to_a_recomputation(spark, fact, roads, scratch_dir):
    path = f"{scratch_dir}/states"
    for load in (3, 1, 0, 2, 1):  # out of order, one of them twice
        R.write_load(R.partial_states(fact.where(F.col("load") == load), roads), path, f"load-{load}")
    states = R.read_states(spark, path)
    want = agg_hourly_congestion(fact, roads)
    assert rows(R.hourly_from_states(states).select(want.columns)) == rows(want)
    weather = kpi_weather_impact(fact)
    assert rows(R.weather_from_states(states).select(weather.columns)) == rows(weather)
    folded = f"{scratch_dir}/folded"
    R.compact_states(states, folded)
    assert spark.read.parquet(folded).count() == states.select(*R.STATE_KEYS).distinct().count() < states.count()
    assert rows(R.hourly_from_states(spark.read.parquet(folded)).select(want.columns)) == rows(want)


def test_a_late_load_reads_no_closed_hour(spark, fact, roads, scratch_dir):
    """A load of late rows adds partitions of its own; no file that was there is touched."""
    import os
    path = f"{scratch_dir}/states"
    R.write_load(R.partial_states(fact.where("load < 3"), roads), path, "first")

    def stored():
        return {f: os.path.getmtime(f.removeprefix("file://")) for f in spark.read.parquet(path).inputFiles()}

    before = stored()
    late = fact.where("load = 3")
    R.write_load(R.partial_states(late, roads), path, "late")
    after = stored()
    assert all(after[f] == t for f, t in before.items()) and len(after) > len(before)
    assert "first" not in R.partial_states(late, roads)._jdf.queryExecution().executedPlan().toString()


def test_sketches_lie_within_their_error(spark, fact, roads):
    states = R.partial_states(fact, roads)
    parts = R.merge_states(states, ["city_zone", "event_date"])  # merged twice, as after a compaction
    for keys in (["city_zone"], []):
        got = R.estimates(parts, keys).collect()
        exact = {r[0] if keys else None: r for r in fact.groupBy(*keys).agg(
            F.countDistinct("vehicle_id").alias("n"), F.collect_list("speed_kmh").alias("s")).collect()}
        for r in got:
            want = exact[r["city_zone"] if keys else None]
            assert abs(r["vehicles"] - want["n"]) <= max(2, 0.05 * want["n"])  # three standard errors
            speeds = sorted(want["s"])
            for name, p in (("speed_q1", 0.25), ("speed_median", 0.5), ("speed_q3", 0.75)):
                below = sum(s < r[name] for s in speeds) / len(speeds)
                upto = sum(s <= r[name] for s in speeds) / len(speeds)
                assert below - 0.034 <= p <= upto + 0.034


def test_edges(spark, roads, scratch_dir):
    """One row has no deviation; no rows give no states; null speeds and levels count as nothing."""
    schema = "vehicle_id string, road_id string, city_zone string, speed_kmh int, congestion_level int, weather string, event_date date, event_hour int"
    one = spark.createDataFrame([("v", "R900", None, None, None, "FOG", date(2024, 1, 1), 3),
                                 ("w", "R100", None, 50, 4, "RAIN", date(2024, 1, 1), 3)], schema)
    states = R.partial_states(one, roads)
    got = {r["weather"]: r for r in R.weather_from_states(states).collect()}
    assert got["FOG"]["avg_speed_kmh"] is None and got["FOG"]["observation_volume"] == 1
    assert got["RAIN"]["speed_variance"] is None and got["RAIN"]["avg_speed_kmh"] == 50
    want = agg_hourly_congestion(one, roads)
    assert rows(R.hourly_from_states(states).select(want.columns)) == rows(want)
    assert R.hourly_from_states(R.partial_states(one.limit(0), roads)).count() == 0
