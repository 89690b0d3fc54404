"""Single rules at their limits."""

import hashlib
from datetime import datetime, timedelta

import pytest
from brute import clock, event_tuples, folded, lane_rows, telemetry, trip_tuples

from tripweave import engine
from tripweave import profiles as P

BASE = datetime(2026, 3, 1, 8)


def rows_of(vin, *steps):
    """Steps are (seconds, power, speed[, extra])."""
    return [
        dict(vin=vin, ts=BASE + timedelta(seconds=s), power=p, speed=v, **(more[0] if more else {}))
        for s, p, v, *more in steps
    ]


def spans(df, base=BASE):
    us = int((base - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    return [((a - us) / 1e6, (b - us) / 1e6, n) for _, a, b, _, _, n in trip_tuples(df)]


CASES = {
    "gap_exact": ([(0, 2, 1.0), (900, 2, 1.0)], [(0, 900, 3)]),
    "gap_over": ([(0, 2, 1.0), (10, 2, 1.0), (910.000001, 2, 1.0), (920, 2, 1.0)], [(0, 10, 3), (910.000001, 920, 3)]),
    "hang_exact": ([(0, 2, 1.0), (10, 0, 0.0), (500, 1, 0.0), (910, 2, 0.0), (920, 2, 0.0)], [(0, 920, 6)]),
    "hang_over": ([(0, 2, 1.0), (10, 0, 0.0), (500, 1, 0.0), (910.000001, 2, 0.0), (920, 2, 0.0)],
                  [(0, 10, 3), (910.000001, 920, 3)]),
    "on_and_off": ([(0, 0, 5.0), (100, 0, 5.0), (950, 0, 5.0), (1700, 1, 0.0), (1900, 2, 0.0), (1910, 2, 0.0)],
                   [(0, 950, 6), (1900, 1910, 3)]),
    "null_power_is_neutral": ([(0, 2, 0.0), (60, None, 0.0), (120, 0, 0.0)], [(0, 120, 4)]),
    "neutral_does_not_resume": ([(0, 2, 0.0), (60, 0, 0.0), (120, 1, 0.0), (180, 1, 0.0)], [(0, 60, 3)]),
    "null_and_nan_speed": ([(0, 2, None), (60, 2, float("nan")), (120, 0, 0.0)], [(0, 120, 4)]),
    "one_row": ([(0, 2, 9.0)], []),
    "rows_before_on": ([(0, 1, 0.0), (60, 0, 0.0), (120, 2, 0.0), (180, 0, 0.0)], [(120, 180, 3)]),
    "moving_power_off": ([(0, 2, 3.0), (600, 0, 3.0), (1200, 0, 3.0), (1800, 0, 0.0)], [(0, 1200, 5)]),
}


@pytest.mark.parametrize("name", CASES)
def test_trip_limits(spark, name):
    steps, expected = CASES[name]
    df = telemetry(spark, rows_of(name, *steps))
    assert spans(engine.trips(df)) == expected
    assert folded(lane_rows(df), P.UNIFIED)[0] == trip_tuples(engine.trips(df))


def test_equal_times_follow_the_tie(spark):
    rows = rows_of("T", (0, 2, 5.0), (60, 0, 0.0), (60, 2, 7.0), (120, 0, 0.0))
    assert spans(engine.trips(telemetry(spark, rows))) == [(0, 120, 6)]
    assert spans(engine.trips(telemetry(spark, [rows[0], rows[2], rows[1], rows[3]]))) == [(0, 60, 4)]


def events_of(spark, steps, profile=P.UNIFIED):
    return clock(engine.events(telemetry(spark, rows_of("E", *steps)), profile), None)


def test_event_bridges_a_hang(spark):
    steps = [(0, 2, 0.0, dict(trunk=1)), (60, 0, 0.0, dict(trunk=1)), (120, 1, 0.0, dict(trunk=0)),
             (180, 2, 0.0, dict(trunk=1)), (240, 2, 0.0, dict(trunk=0)), (300, 0, 0.0, dict(trunk=0))]
    found = [e for e in events_of(spark, steps) if e[1] == "TRUNK_EVENT"]
    assert found == [("E", "TRUNK_EVENT", "08:00:00", "08:04:00")]


def test_creep_of_exactly_the_minimum(spark):
    short = [(0, 2, 5.0), (299, 2, 50.0), (400, 0, 0.0)]
    exact = [(0, 2, 5.0), (300, 2, 50.0), (400, 0, 0.0)]
    assert not [e for e in events_of(spark, short) if e[1] == "CREEP_RUN_EVENT"]
    assert [e for e in events_of(spark, exact) if e[1] == "CREEP_RUN_EVENT"]


def test_before_run_only_if_the_first_row_stands(spark):
    stands = [(0, 2, 0.0, dict(lon=1.0, lat=2.0)), (60, 2, 5.0, dict(lon=3.0, lat=4.0)), (90, 0, 0.0, dict(lon=5.0, lat=6.0))]
    moves = [(0, 2, 5.0), (60, 2, 5.0), (90, 0, 0.0)]
    df = engine.events(telemetry(spark, rows_of("E", *stands))).filter("event_name = 'PARK_BEFORE_RUN_EVENT'")
    assert [tuple(r) for r in df.select("start_lon", "start_lat", "end_lon", "end_lat").collect()] == [(3.0, 4.0, 3.0, 4.0)]
    assert not [e for e in events_of(spark, moves) if e[1] == "PARK_BEFORE_RUN_EVENT"]


def test_closing_coordinates(spark):
    steps = [(0, 2, 5.0, dict(lon=1.0, lat=1.0)), (60, 2, 0.0, dict(lon=2.0, lat=2.0)), (5000, 1, 0.0, dict(lon=9.0, lat=8.0))]
    df = telemetry(spark, rows_of("E", *steps))

    def end(profile, rows=df):
        after = engine.events(rows, profile).filter("event_name = 'PARK_AFTER_RUN_EVENT'")
        return [tuple(r) for r in after.select("start_lon", "end_lon", "end_lat").collect()]

    assert end(P.UNIFIED) == [(9.0, 9.0, 8.0)]
    assert end(P.UNIFIED.but(close_coords="at_end")) == [(2.0, 2.0, 2.0)]
    silent = telemetry(spark, rows_of("E", *steps[:2]))
    assert end(P.UNIFIED, silent) == [(0.0, 0.0, 0.0)]


def test_trip_id_text(spark):
    for fraction, text in ((0, "2026-03-01 08:00:00"), (120_000, "2026-03-01 08:00:00.120000")):
        rows = [dict(vin="V", ts=BASE + timedelta(microseconds=fraction), power=2, speed=1.0),
                dict(vin="V", ts=BASE + timedelta(seconds=60), power=2, speed=1.0)]
        found = engine.trips(telemetry(spark, rows)).first().trip_id
        assert found == hashlib.md5(f"V_{text}".encode()).hexdigest()


def test_missing_columns(spark):
    from tripweave.sources.telemetry import normalize

    raw = spark.createDataFrame([("V", BASE)], "vin string, timestamp timestamp")
    row = normalize(raw).first()
    assert (row[P.POWER], row[P.SPEED], row[P.LON], row["trunk_door_status"]) == (0, 0.0, 0.0, 0)
    with pytest.raises(ValueError, match=P.POWER):
        normalize(raw, require=(P.POWER, P.SPEED))


def test_all_events_of_the_catalogue(spark):
    assert len(P.EVENT_NAMES) == 23 == len(set(P.EVENT_NAMES))
    flags = [f for f in P.FLAGS]
    rows = [(f"V{i}", BASE + timedelta(seconds=60 * n), 2, 0.0, *[int(g == f and n < 2) for g in flags])
            for i, f in enumerate(flags) for n in range(3)]
    from tripweave.sources.telemetry import normalize

    ddl = f"vin string, timestamp timestamp, {P.POWER} int, {P.SPEED} double, " + ", ".join(f"{f} int" for f in flags)
    events = engine.events(normalize(spark.createDataFrame(rows, ddl)))
    found = {r.event_name for r in events.select("event_name").collect()}
    assert found == {r.name for r in P.SWITCH_EVENTS + P.SEAT_EVENTS} | {"PARK_RUNNING_EVENT"}
    assert event_tuples(events)
