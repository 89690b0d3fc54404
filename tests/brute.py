"""Row-by-row results to compare the window queries with, and makers of test rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone
from itertools import groupby

import pandas as pd

from tripweave import profiles as P

EPOCH = datetime(1970, 1, 1)
# Short names of the columns that test rows set.
SHORT = {"power": P.POWER, "speed": P.SPEED, "lon": P.LON, "lat": P.LAT, "trunk": "trunk_door_status",
         "heat": "driv_seat_heat_sts", "ivi": "ivi_power_status"}


def telemetry(spark, rows, tie=None):
    """Canonical telemetry of dict rows with ``vin``, ``ts`` and short names."""
    from tripweave.sources.telemetry import normalize

    used = [k for k in SHORT if any(k in r for r in rows)]
    kind = {"speed": "double", "lon": "double", "lat": "double"}
    ddl = "vin string, timestamp timestamp, n long" + "".join(f", {SHORT[k]} {kind.get(k, 'int')}" for k in used)
    data = [
        (r["vin"], r["ts"].replace(tzinfo=timezone.utc), n, *[r.get(k) for k in used]) for n, r in enumerate(rows)
    ]
    return normalize(spark.createDataFrame(data, ddl), tie="n")


def walk(start, minutes, power, speed, **more):
    """One row a minute."""
    return [dict(ts=start + timedelta(minutes=i), power=power, speed=float(speed), **more) for i in range(minutes)]


def fleet(seed, vehicles=30, rows=60, steps=(0, 1, 30, 60, 240, 299, 300, 301, 600, 899, 900, 901, 1500)):
    """Random vehicles whose silences lie around the limits, some rows at equal times."""
    rng = random.Random(seed)
    out = []
    for v in range(vehicles):
        at = datetime(2026, 1, 1) + timedelta(seconds=rng.randrange(3600))
        for _ in range(rng.randrange(1, rows)):
            out.append(
                dict(
                    vin=f"R{v:03d}", ts=at,
                    power=rng.choice([2, 2, 1, None, 0]),
                    speed=rng.choice([0.0, 0.0, 0.0, None, 5.0, 10.0, 15.0, 40.0, 41.5, 100.0, 150.0]),
                    lon=round(rng.uniform(100, 130), 3), lat=round(rng.uniform(20, 50), 3),
                    trunk=rng.choice([0, 1, None]), heat=rng.choice([0, 0, 1]), ivi=rng.choice([1, 1, 0]),
                )
            )
            at += timedelta(seconds=rng.choice(steps), microseconds=rng.choice([0, 0, 0, 1]))
    return out


def lane_rows(telemetry_df):
    from tripweave.operators.segment import lanes

    return lanes(telemetry_df).orderBy("vin", "t", "tie").collect()


def trips_as_lists(rows, profile):
    """Each vehicle's trips as lists of (row, counts twice), with the row that ends the trip, if any.

    Rows that switch on divide a vehicle's rows into parts. A part is active up to its first row that switches off, or
    to the first long silence. Parts belong together unless a silence, or too long a time off, lies between.
    """
    for vin, group in groupby(rows, key=lambda r: r.vin):
        group = list(group)
        heads = [i for i, r in enumerate(group) if r.is_on]
        trip, before = [], None
        for head, after in zip(heads, [*heads[1:], len(group)]):
            part = group[head:after]
            silent = next((i for i in range(1, len(part)) if part[i].t - part[i - 1].t > profile.gap_us), len(part))
            active = part[: next((i + 1 for i, r in enumerate(part[:silent]) if r.is_off), silent)]
            hung = active[-1].is_off
            goes_on = before is not None and before[0] and not (before[1] and part[0].t - before[2] > profile.hang_us)
            if trip and not goes_on:
                yield vin, trip, before[3] or part[0]
                trip = []
            doubled = not trip or before[1]
            trip += [(r, doubled and i == 0) for i, r in enumerate(active)]
            # What ends the trip inside this part, and whether the next part still joins it.
            late = next((r for r in part[len(active) : silent] if hung and r.t - active[-1].t > profile.hang_us), None)
            ender = late or (part[silent] if silent < len(part) else None)
            joined = ender is None and after < len(group) and group[after].t - part[-1].t <= profile.gap_us
            before = (joined, hung, active[-1].t, ender)
        if trip:
            yield vin, trip, before[3]


def measured(vin, start, end, samples):
    return (vin, start, end, max(samples), round(sum(samples) / len(samples), 6), len(samples))


def lasting(start, end, profile):
    return start < end or profile.keep_zero_length and start == end


def samples_of(trip, profile):
    return [r.speed for r, doubled in trip for _ in range(2 if doubled and not profile.dedupe_samples else 1)]


def events_of(trip, ender, profile):
    """(kind, start, end, positions): stretches of rows on which a bit is set, and the rests before and after driving."""
    active = [r for r, _ in trip]
    last = active[-1]
    lon, lat = (last.lon, last.lat) if profile.close_coords == "at_end" else (ender.lon, ender.lat) if ender else (0.0, 0.0)
    out = []
    for bit in range(len(P.TRACKED_EVENTS)):
        at = 0
        for holds, stretch in groupby(active, key=lambda r: r.mask >> bit & 1):
            stretch = list(stretch)
            at += len(stretch)
            if holds:
                end = (active[at].t, active[at].lon, active[at].lat) if at < len(active) else (last.t, lon, lat)
                out.append((bit, stretch[0].t, end[0], stretch[0].lon, stretch[0].lat, *end[1:]))
    moving = [r for r in active if r.speed > 0]
    if moving:
        first = moving[0]
        out.append((P.BEFORE_BIT, active[0].t, first.t, first.lon, first.lat, first.lon, first.lat))
        out.append((P.AFTER_BIT, moving[-1].t, last.t, lon, lat, lon, lat))
    return [e for e in out if e[1] < e[2] and e[2] - e[1] >= P.EVENT_MIN_SECONDS[e[0]] * 1_000_000]


def folded(rows, profile):
    """Trips and events of lane rows, from lists."""
    trips, events = [], []
    for vin, trip, ender in trips_as_lists(rows, profile):
        start, end = trip[0][0].t, trip[-1][0].t
        if lasting(start, end, profile):
            trips.append(measured(vin, start, end, samples_of(trip, profile)))
        events += [(vin, start, P.EVENT_NAMES[b], s, e, *at) for b, s, e, *at in events_of(trip, ender, profile)]
    return sorted(trips), sorted(events)


def pieces_of(trip, profile):
    """(first place, start) of each piece of a trip, from its moving rows: a rest that lasts too long after one begins a piece
    of its own at that row's time, and driving after too long a rest the next one at the time of the row before."""
    t = [r.t for r, _ in trip]
    moving = [i for i, (r, _) in enumerate(trip) if r.speed > 0]
    cuts = [(0, t[0])]
    for begin, after in zip([None, *moving], [*moving, len(trip)]):
        resting = begin is None
        if begin is not None:
            stop = next((i for i in range(begin + 1, after) if t[i] - t[begin] > profile.idle_us), None)
            resting = stop is not None
            cuts += [(stop, t[begin])] if resting else []
        if resting and 0 < after < len(trip) and not trip[after][1] and t[after] - cuts[-1][1] > profile.idle_us:
            cuts.append((after, t[after - 1]))
    return cuts


def split_trips(rows, profile):
    """Trips with idle splitting, as lists of samples."""
    out = []
    for vin, trip, _ in trips_as_lists(rows, profile):
        cuts = pieces_of(trip, profile)
        ends = [start for _, start in cuts[1:]] + [trip[-1][0].t]
        for n, ((place, start), end) in enumerate(zip(cuts, ends)):
            until = cuts[n + 1][0] if n + 1 < len(cuts) else len(trip)
            samples = samples_of(trip[place:until], profile)
            if n and trip[place][1]:
                samples = samples[1:]  # a cut row counts once
            if until < len(trip) and trip[until][1]:
                samples.append(trip[until][0].speed)  # a row that resumes and cuts leaves a sample behind
            if lasting(start, end, profile):
                out.append(measured(vin, start, end, samples))
    return sorted(out)


def trip_tuples(df):
    cols = "vin", "unix_micros(start_time)", "unix_micros(end_time)", "max_speed", "round(avg_speed, 6)", "samples"
    return sorted(tuple(r) for r in df.selectExpr(*cols).collect())


def event_tuples(df):
    cols = ("vin", "unix_micros(trip_start)", "event_name", "unix_micros(start_time)", "unix_micros(end_time)",
            "start_lon", "start_lat", "end_lon", "end_lat")
    return sorted(tuple(r) for r in df.selectExpr(*cols).collect())


def clock(df, day):
    """(vin, type, start, end, max, average) with times of day, sorted."""
    kind = "trip_type" if "trip_type" in df.columns else "event_name"
    measures = ["max_speed", "round(avg_speed, 6) AS avg_speed", "samples"] if kind == "trip_type" else []
    rows = df.selectExpr("vin", kind, "start_time", "end_time", *measures).toPandas()
    out = []
    for r in rows.itertuples(index=False):
        start, end = (pd.Timestamp(x) for x in r[2:4])
        out.append((r[0], r[1], start.strftime("%H:%M:%S"), end.strftime("%H:%M:%S"), *r[4:]))
    return sorted(out)
