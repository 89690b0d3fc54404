"""The library's entry points for batch work.

Every function takes canonical telemetry (see ``sources.telemetry.normalize``).
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tripweave import profiles as P
from tripweave import schemas
from tripweave.functions.expressions import trip_id
from tripweave.operators import carry as state
from tripweave.operators import skew
from tripweave.operators.carry import Step
from tripweave.operators.events import event_rows
from tripweave.operators.segment import lanes
from tripweave.operators.trips import still_open, trip_rows


_RESULT = schemas.RESULT.fieldNames()


def _micros(now: datetime | str | None) -> int | None:
    """A moment as microseconds; without a zone it is UTC."""
    if now is None:
        return None
    at = datetime.fromisoformat(now) if isinstance(now, str) else now
    at = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at
    return (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def trips(telemetry: DataFrame, profile: P.Profile = P.UNIFIED, hot_rows: int | None = skew.HOT_ROWS) -> DataFrame:
    """All trips; one still open at the end of the input ends at its last active row."""
    work = skew.plan(lanes(telemetry), None, hot_rows)
    return trip_rows(work.measured(profile), profile)


def events(telemetry: DataFrame, profile: P.Profile = P.UNIFIED, hot_rows: int | None = skew.HOT_ROWS) -> DataFrame:
    """All sub-events, each with the id of its trip."""
    work = skew.plan(lanes(telemetry), None, hot_rows)
    return event_rows(work.paired(profile))


def step(
    carry: DataFrame | None,
    telemetry: DataFrame,
    now: datetime | str | None = None,
    profile: P.Profile = P.UNIFIED,
    with_events: bool = True,
    hot_rows: int | None = skew.HOT_ROWS,
    keep: bool = False,
) -> Step:
    """One incremental run: state and new rows in; closed trips, closed events, new state out.

    ``now`` ends open trips that have been silent, or switched off, beyond the limit. The
    results share two intermediate tables (trips and events, both far smaller than the rows);
    ``keep`` persists these, for callers that write more than one result. ``release`` them then.
    """
    return step_lanes(carry, lanes(telemetry), now, profile, with_events, hot_rows, keep)


def step_lanes(
    carry: DataFrame | None,
    rows: DataFrame,
    now: datetime | str | None = None,
    profile: P.Profile = P.UNIFIED,
    with_events: bool = True,
    hot_rows: int | None = skew.HOT_ROWS,
    keep: bool = False,
) -> Step:
    """``step`` for rows that ``lanes`` has reduced already."""
    now_us = _micros(now)
    heads = None if carry is None else state.heads(carry)
    work = skew.plan(rows, heads, hot_rows)
    measured = work.measured(profile, outlook=True)
    paired = work.paired(profile, end_open=False, now_us=now_us) if with_events else None
    kept = tuple(df.persist(StorageLevel.DISK_ONLY) for df in (measured, paired) if df is not None) if keep else ()
    closed = trip_rows(measured.filter(f"NOT {still_open(profile, now_us)}"), profile)
    return Step(
        closed,
        None if paired is None else event_rows(paired),
        state.snapshot(measured, paired, profile, now_us),
        kept,
    )


def result_rows(trips: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Trips and events in one row shape, told apart by ``row_type``."""
    blank = "CAST(null AS STRING) AS phase", "CAST(null AS TIMESTAMP) AS last_speed_ts", "CAST(null AS STRING) AS state_speeds"
    place = ("start_lon", "start_lat", "end_lon", "end_lat")
    rows = trips.selectExpr(
        "*",
        "'TRIP' AS row_type",
        "end_time AS last_ts",
        *blank,
        *[f"CAST(null AS DOUBLE) AS {c}" for c in place],
    ).select(*_RESULT)
    if events is None:
        return rows
    return rows.unionByName(
        events.selectExpr(
            "*",
            "'EVENT' AS row_type",
            "event_name AS trip_type",
            "end_time AS last_ts",
            "0.0D AS max_speed",
            "0.0D AS avg_speed",
            *blank,
        ).select(*_RESULT)
    )


def state_rows(carry: DataFrame) -> DataFrame:
    """Carried state in the result row shape, as ``STATE`` rows.

    The trip's start and the switch-off stand in ``start_time`` and ``end_time``. The speed
    samples are not listed: the carry table holds their sum, weight and maximum.
    """
    return carry.selectExpr(
        f"{trip_id(P.VIN, 'trip_start')} AS trip_id",
        P.VIN,
        "'STATE' AS row_type",
        "trip_type",
        "phase",
        "trip_start AS start_time",
        "hang_start AS end_time",
        *[f"CAST(null AS DOUBLE) AS {c}" for c in _RESULT[7:13]],
        "last_ts",
        "last_speed_ts",
        "CAST(null AS STRING) AS state_speeds",
    ).select(*_RESULT)


def short_rows(results: DataFrame) -> DataFrame:
    """The 11 columns of the profiles that have no trip id and no positions."""
    return results.select(*schemas.SHORT_RESULT.fieldNames())
