"""The scenario vehicles with their hand-derived trips and events."""

from datetime import datetime, timedelta

import pytest
from brute import clock, telemetry, walk

from tripweave import engine
from tripweave import profiles as P
from tripweave.operators import report


def at(text, day="2026-05-30"):
    return datetime.fromisoformat(f"{day} {text}")


def half_minutes(vin, start, rows):
    return [dict(vin=vin, ts=start + timedelta(seconds=30 * i), lon=120.0, lat=30.0, **r) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def unified(spark):
    base, off = at("08:00:00"), dict(power=0, speed=0.0)
    one = [dict(power=2, speed=5.0, trunk=0)] * 12 + [dict(power=2, speed=0.0, trunk=1)] * 8 + [off]
    two = [dict(power=2, speed=5.0, heat=int(i == 5)) for i in range(9)] + [dict(power=2, speed=45.0)] * 2 + [off]
    three = half_minutes("VIN_003", base, [dict(power=2, speed=20.0)] * 5)
    three += half_minutes("VIN_003", at("08:32:30"), [dict(power=2, speed=30.0)] * 5 + [off])
    rows = half_minutes("VIN_001", base, one) + half_minutes("VIN_002", base, two) + three
    rows += [dict(vin=f"VIN_00{i}", ts=at("10:00:00"), lon=0.0, lat=0.0, **off) for i in (1, 2, 3)]
    return telemetry(spark, rows)


def test_unified_trips(unified):
    assert clock(engine.trips(unified), None) == [
        ("VIN_001", "DRIVING", "08:00:00", "08:10:00", 5.0, round(65 / 22, 6), 22),
        ("VIN_002", "DRIVING", "08:00:00", "08:05:30", 45.0, round(140 / 13, 6), 13),
        ("VIN_003", "DRIVING", "08:00:00", "08:02:00", 20.0, 20.0, 6),
        ("VIN_003", "DRIVING", "08:32:30", "08:35:00", 30.0, round(180 / 7, 6), 7),
    ]


def test_unified_events(unified):
    assert clock(engine.events(unified), None) == sorted([
        ("VIN_001", "CREEP_RUN_EVENT", "08:00:00", "08:06:00"),
        ("VIN_001", "LOW_SPEED_EVENT", "08:00:00", "08:06:00"),
        ("VIN_001", "PARK_AFTER_RUN_EVENT", "08:05:30", "08:10:00"),
        ("VIN_001", "PARK_RUNNING_EVENT", "08:06:00", "08:10:00"),
        ("VIN_001", "TRUNK_EVENT", "08:06:00", "08:10:00"),
        ("VIN_002", "LOW_SPEED_EVENT", "08:00:00", "08:04:30"),
        ("VIN_002", "MEDIUM_SPEED_EVENT", "08:04:30", "08:05:30"),
        ("VIN_002", "PARK_AFTER_RUN_EVENT", "08:05:00", "08:05:30"),
        ("VIN_003", "LOW_SPEED_EVENT", "08:00:00", "08:02:00"),
        ("VIN_003", "LOW_SPEED_EVENT", "08:32:30", "08:35:00"),
        ("VIN_003", "PARK_AFTER_RUN_EVENT", "08:34:30", "08:35:00"),
    ])


def test_noise_vehicles_give_one_trip_each(spark):
    rows = []
    for v in range(5, 101):
        steps = [dict(power=2, speed=float((v * 7 + i * 13) % 60)) for i in range(10)] + [dict(power=0, speed=0.0)]
        rows += half_minutes(f"VIN_{v:03d}", at("08:00:00"), steps)
        rows.append(dict(vin=f"VIN_{v:03d}", ts=at("10:00:00"), power=0, speed=0.0))
    trips = engine.trips(telemetry(spark, rows))
    assert trips.count() == 96
    assert trips.select("trip_id").distinct().count() == 96


def test_trip_profile(spark):
    def m(n):
        return at("08:00:00", "2026-10-01") + timedelta(minutes=n)

    def row(vin, n, power, speed):
        return dict(vin=vin, ts=m(n), power=power, speed=float(speed))

    rows = [row("NORMAL", 0, 2, 0)] + [row("NORMAL", n, 2, 40) for n in range(1, 10)]
    rows += [row("NORMAL", 10, 2, 0), row("NORMAL", 11, 0, 0)]
    rows += [row("IDLE", 0, 2, 30)] + [row("IDLE", n, 2, 0) for n in range(1, 20)]
    rows += [row("IDLE", 20, 2, 20), row("IDLE", 21, 0, 0)]
    rows += [row("STOP", 0, 2, 50), row("STOP", 5, 0, 0), row("STOP", 13, 2, 30), row("STOP", 20, 0, 0)]
    rows += [row("GONE", 0, 2, 30), row("GONE", 5, 2, 15)]
    assert clock(engine.trips(telemetry(spark, rows), P.TRIP), None) == [
        ("GONE", "DRIVING", "08:00:00", "08:05:00", 30.0, 25.0, 3),
        ("IDLE", "DRIVING", "08:00:00", "08:21:00", 30.0, round(80 / 23, 6), 23),
        ("NORMAL", "DRIVING", "08:00:00", "08:11:00", 40.0, round(360 / 13, 6), 13),
        ("STOP", "DRIVING", "08:00:00", "08:20:00", 50.0, round(160 / 6, 6), 6),
    ]


@pytest.fixture(scope="module")
def scenarios(spark):
    rows = []

    def drive(vin, start, *legs):
        moment = start
        for minutes, power, speed in legs:
            if power is None:
                moment += timedelta(minutes=minutes)
                continue
            rows.extend(walk(moment, minutes, power, speed, vin=vin))
            moment += timedelta(minutes=minutes)
        return moment

    base = at("08:00:00", "2026-05-20")

    def off(vin, moment):
        rows.append(dict(vin=vin, ts=moment, power=0, speed=0.0))
        return moment

    off("A", drive("A", base, (10, 2, 45), (3, 2, 0), (10, 2, 40)))
    off("B", drive("B", base, (5, 2, 0)))
    off("C", drive("C", base, (10, 2, 35), (20, 2, 0), (10, 2, 50)))
    stop = off("D", drive("D", base, (20, 2, 60)))
    off("D", drive("D", stop + timedelta(minutes=3), (10, 2, 55)))
    gone = drive("E", base, (15, 2, 30), (1, 2, 0), (120, None, None))
    rows.append(dict(vin="E", ts=gone, power=2, speed=0.0))
    stop = off("F", drive("F", base, (10, 2, 35)))
    off("F", drive("F", stop + timedelta(minutes=1), (10, 2, 40)))
    off("G", drive("G", at("23:45:00", "2026-05-19"), (30, 2, 45)))
    rows.append(dict(vin="Y", ts=at("20:00:00", "2026-05-19"), power=2, speed=9.0))
    rows.append(dict(vin="Y", ts=at("20:05:00", "2026-05-19"), power=0, speed=0.0))
    return telemetry(spark, rows)


EXPECTED_LEGACY = [
    ("A", "DRIVING", "08:00:00", "08:23:00", 45.0, 35.8),
    ("B", "PARKING", "08:00:00", "08:05:00", 0.0, 0.0),
    ("C", "DRIVING", "08:00:00", "08:09:00", 35.0, 14.807692),
    ("C", "DRIVING", "08:29:00", "08:40:00", 50.0, 45.454545),
    ("C", "PARKING", "08:09:00", "08:29:00", 0.0, 0.0),
    ("D", "DRIVING", "08:00:00", "08:33:00", 60.0, 54.852941),
    ("E", "DRIVING", "08:00:00", "08:15:00", 30.0, 28.235294),
    ("F", "DRIVING", "08:00:00", "08:21:00", 40.0, 34.375),
    ("G", "DRIVING", "23:45:00", "00:15:00", 45.0, 43.59375),
]


def test_legacy_scenarios(scenarios):
    of_day = report.of_day(engine.trips(scenarios, P.LEGACY_FLUSH), "2026-05-20")
    assert [r[:6] for r in clock(of_day, None)] == EXPECTED_LEGACY
    kept = report.of_day(engine.trips(scenarios, P.LEGACY), "2026-05-20")
    extra = set(r[:6] for r in clock(kept, None)) - set(EXPECTED_LEGACY)
    assert extra == {("E", "PARKING", "10:16:00", "10:16:00", 0.0, 0.0)}


def test_report(scenarios):
    trips = report.of_day(engine.trips(scenarios, P.LEGACY_FLUSH), "2026-05-20")
    shown = report.presented(trips).collect()
    assert [(r.vin, r.start_text) for r in shown] == sorted((r.vin, r.start_text) for r in shown)
    first = shown[0]
    assert (first.start_text, first.end_text, first.max_speed, first.avg_speed, first.minutes) == (
        "05-20 08:00:00", "05-20 08:23:00", 45.0, 35.8, 23.0
    )
    assert {r.trip_type: r["count"] for r in report.count_by_type(trips).collect()} == {"DRIVING": 7, "PARKING": 2}
