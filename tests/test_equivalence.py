"""Random vehicles: windows = row-by-row fold = chunked windows = runs with carried state."""

from datetime import datetime, timedelta, timezone

import pytest
from brute import event_tuples, fleet, folded, lane_rows, split_trips, telemetry, trip_tuples
from pyspark.sql import functions as F

from tripweave import engine
from tripweave import profiles as P
from tripweave.operators.report import gap_sessions

LATER = "2030-01-01 00:00:00"


@pytest.fixture(scope="module")
def random_rows(spark):
    df = telemetry(spark, fleet(seed=11)).persist()
    return df, lane_rows(df)


@pytest.mark.parametrize("profile", [P.UNIFIED, P.UNIFIED.but(close_coords="at_end", dedupe_samples=True)])
def test_windows_equal_fold(random_rows, profile):
    df, rows = random_rows
    trips, events = folded(rows, profile)
    assert trips and trip_tuples(engine.trips(df, profile)) == trips
    assert len(events) > 300 and event_tuples(engine.events(df, profile)) == events


@pytest.mark.parametrize("profile", [P.LEGACY, P.LEGACY_FLUSH])
def test_idle_split_equals_lists(random_rows, profile):
    df, rows = random_rows
    assert trip_tuples(engine.trips(df, profile)) == split_trips(rows, profile)


def test_idle_split_on_long_stops(spark):
    rows = fleet(seed=5, vehicles=40, rows=80, steps=(30, 60, 120, 299, 300, 301, 450))
    df = telemetry(spark, [r for r in rows if r["power"] != 0 or r["ts"].second % 3 == 0]).persist()
    want = split_trips(lane_rows(df), P.LEGACY)
    assert trip_tuples(engine.trips(df, P.LEGACY)) == want
    assert any(s[4] == 0.0 for s in want) and len(want) > 100


def one_hot_vehicle(spark):
    """One vehicle holds more than a third of all rows, half of them at two instants."""
    rows = fleet(seed=3, vehicles=12, rows=40)
    hot = fleet(seed=4, vehicles=1, rows=2000, steps=(0, 0, 0, 1, 20, 60, 60, 120, 300, 500))
    while len(hot) < 250:
        hot += [dict(r, ts=r["ts"] + timedelta(seconds=3)) for r in hot]
    hot = hot[:400]
    same = [dict(hot[100], power=2, speed=7.0)] * 120
    return telemetry(spark, rows + hot + same)


@pytest.mark.parametrize("profile", [P.UNIFIED, P.LEGACY])
def test_hot_vehicle_in_chunks(spark, profile):
    df = one_hot_vehicle(spark).persist()
    want, events = folded(lane_rows(df), profile)
    if profile is P.LEGACY:
        want = split_trips(lane_rows(df), profile)
    assert trip_tuples(engine.trips(df, profile, hot_rows=60)) == want
    if profile is P.UNIFIED:
        assert event_tuples(engine.events(df, profile, hot_rows=60)) == events


def runs(df, cuts, profile, with_events, hot_rows=None):
    """Closed trips and events of consecutive runs that end at the cuts."""
    carry, trips, events = None, [], []
    low = None
    for high in [*cuts, None]:
        part = df
        if low is not None:
            part = part.filter(F.col(P.TIMESTAMP) >= F.lit(low))
        if high is not None:
            part = part.filter(F.col(P.TIMESTAMP) < F.lit(high))
        step = engine.step(
            carry, part, now=None if high else LATER, profile=profile, with_events=with_events, hot_rows=hot_rows
        )
        trips += trip_tuples(step.trips)
        events += event_tuples(step.events) if with_events else []
        carry = step.carry.checkpoint()
        low = high
    assert carry.isEmpty()
    return sorted(trips), sorted(events)


CUTS = [datetime(2026, 1, 1, 2, 10, tzinfo=timezone.utc), datetime(2026, 1, 1, 5, 30, tzinfo=timezone.utc)]


def test_runs_with_carried_state_equal_one_run(random_rows):
    df, rows = random_rows
    assert runs(df, CUTS, P.UNIFIED, True) == folded(rows, P.UNIFIED)


def test_legacy_runs_equal_one_run(random_rows):
    df, rows = random_rows
    assert runs(df, CUTS, P.LEGACY, False)[0] == split_trips(rows, P.LEGACY)


def test_hot_runs_with_carried_state(spark):
    df = one_hot_vehicle(spark).persist()
    cut = [datetime(2026, 1, 1, 2, 30, tzinfo=timezone.utc)]
    assert runs(df, cut, P.UNIFIED, True, hot_rows=60) == folded(lane_rows(df), P.UNIFIED)


def test_now_ends_overdue_trips_only(spark):
    base = datetime(2026, 1, 1, 8)
    place = dict(vin="V", power=2, lon=7.0, lat=8.0)
    df = telemetry(spark, [dict(place, ts=base, speed=3.0), dict(place, ts=base + timedelta(minutes=5), speed=0.0)])
    at_limit = engine.step(None, df, now="2026-01-01 08:20:00")
    assert at_limit.trips.isEmpty() and at_limit.carry.count() == 1
    over = engine.step(None, df, now="2026-01-01 08:20:00.000001")
    assert over.carry.isEmpty()
    ends = {r.event_name: r.end_lon for r in over.events.collect()}
    assert ends == {"CREEP_RUN_EVENT": 7.0, "LOW_SPEED_EVENT": 7.0, "PARK_AFTER_RUN_EVENT": 0.0}


def test_daily_runs_can_be_repeated(spark, random_rows):
    from tripweave.plans import daily
    from tripweave.session import scratch_dir

    df, rows = random_rows
    root = scratch_dir(spark)
    low = df.filter(F.col(P.TIMESTAMP) < F.lit(CUTS[0]))
    high = df.filter(F.col(P.TIMESTAMP) >= F.lit(CUTS[0]))
    for _ in range(2):
        daily.run_day(spark, low, root, "d1", None)
    for _ in range(2):
        daily.run_day(spark, high, root, "d2", "d1", now=LATER)
    trips, events = folded(rows, P.UNIFIED)
    assert trip_tuples(spark.read.parquet(f"{root}/trips")) == trips
    assert event_tuples(spark.read.parquet(f"{root}/events")) == events
    daily.run_day(spark, high.limit(0), root, "d2", None, now=LATER)  # without rows the day is empty
    assert spark.read.parquet(f"{root}/trips").filter("day = 'd2'").isEmpty()


def test_stretches_of_a_hot_vehicle(spark):
    """Against a walk through the rows: gaps of exactly the limit, times before 1970, one vehicle with most rows."""
    base, limit = datetime(1969, 12, 31, 20, tzinfo=timezone.utc), timedelta(minutes=15)
    steps = (0, 0, 1, 60, 899, 900, 901, 5_000)
    rows = []
    for vin, n in (("HOT", 3_000), ("A", 300), ("B", 1), (None, 40)):
        at = base
        for k in range(n):
            at += timedelta(seconds=steps[(k * k + k // 7) % len(steps)], microseconds=k % 2)
            rows += [(vin, at)] * (20 if vin == "HOT" else 1)
    rows += [("A", None), ("C", None)]
    df = spark.createDataFrame(rows, f"{P.VIN} string, {P.TIMESTAMP} timestamp").repartition(5)
    want = []
    for vin in {v for v, _ in rows}:
        for at in sorted(t for v, t in rows if v == vin and t):
            if want and want[-1][0] == vin and at - want[-1][2] <= limit:
                want[-1][2:] = [at, want[-1][3] + 1]
            else:
                want.append([vin, at, at, 1])
    micros = lambda t: (t - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    found = gap_sessions(df).selectExpr(P.VIN, "unix_micros(first_ts)", "unix_micros(last_ts)", "n_rows")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((v, micros(a), micros(b), n)) for v, a, b, n in want)
    assert gap_sessions(df.limit(0)).isEmpty()


def test_stretches_are_summed_up_before_the_exchange(spark):
    """No more rows of the hot vehicle are exchanged than slots, however many rows it has."""
    df = spark.range(200_000).selectExpr(f"'HOT' AS {P.VIN}", f"timestamp_millis(id * 100) AS {P.TIMESTAMP}")
    plan = gap_sessions(df)._jdf.queryExecution().executedPlan().toString()
    below = plan.rsplit("Exchange hashpartitioning", 1)[1]
    assert "partial_min" in below and "partial_count" in below and "Session" not in plan and "Python" not in plan
    assert [tuple(r) for r in gap_sessions(df).select(P.VIN, "n_rows").collect()] == [("HOT", 200_000)]
