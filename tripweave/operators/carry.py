"""Carried state: closed trips leave, open ones wait for the next run.

``step`` consumes the state of the run before and the new rows, and gives closed trips, closed
events and the state for the next run. State enters the windows as one head row per vehicle,
so a run reads new rows only, however long a trip has been open.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from tripweave import profiles as P
from tripweave import schemas
from tripweave.functions.expressions import EVENT_NAME
from tripweave.operators.segment import HEAD, NEVER
from tripweave.operators.trips import still_open

OPEN_EVENTS = schemas.CARRY["open_events"].dataType.simpleString()

def heads(carry: DataFrame) -> DataFrame:
    """Carried state as head rows, one per vehicle with an open trip."""
    hanging = "phase = 'HANG_OFF'"
    last_active = f"unix_micros(IF({hanging}, hang_start, last_ts))"
    mask = " + ".join(
        f"IF(open_events['{rule.name}'] IS NOT NULL, {1 << bit}, 0)" for bit, rule in enumerate(P.TRACKED_EVENTS)
    )
    return carry.filter("phase IN ('ACTIVE', 'HANG_OFF')").selectExpr(
        P.VIN,
        f"{HEAD} AS pos",
        "unix_micros(last_ts) AS t",
        "0L AS tie",
        "end_lon AS lon",
        "end_lat AS lat",
        f"IF({hanging}, {NEVER}, {last_active}) AS h_live",
        f"{last_active} AS h_island",
        f"{last_active} AS h_last_active",
        "unix_micros(trip_start) AS h_trip",
        "unix_micros(trip_start) * 4 AS h_piece",
        "unix_micros(trip_start) AS h_start",
        "unix_micros(last_speed_ts) AS h_moved",
        f"{hanging} AS h_hanging",
        "speed_sum AS h_speed_sum",
        "speed_weight AS h_speed_weight",
        "speed_max AS h_speed_max",
        f"{mask} AS h_mask",
        f"coalesce(open_events, CAST(map() AS {OPEN_EVENTS})) AS h_open",
    )


def snapshot(measured: DataFrame, paired: DataFrame | None, profile: P.Profile, now_us: int | None) -> DataFrame:
    """State rows of the vehicles whose last trip is still open.

    ``measured`` needs its outlook columns; ``paired`` are the trips' events, of which the
    unfinished ones are carried (at most one per kind and vehicle).
    """
    state = measured.filter(still_open(profile, now_us)).selectExpr(
        P.VIN,
        "IF(last.hanging, 'HANG_OFF', 'ACTIVE') AS phase",
        "IF(max_speed > 0, 'DRIVING', 'PARKING') AS trip_type",
        "timestamp_micros(start_t) AS trip_start",
        "IF(last.hanging, timestamp_micros(end_t), null) AS hang_start",
        "timestamp_micros(last_t) AS last_ts",
        "timestamp_micros(last_moved) AS last_speed_ts",
        "speed_sum",
        "speed_weight",
        "max_speed AS speed_max",
        "last.lon AS end_lon",
        "last.lat AS end_lat",
    )
    if paired is None:
        return state.selectExpr("*", f"CAST(null AS {OPEN_EVENTS}) AS open_events")
    place = "struct(timestamp_micros(start_t) AS start_time, start_lon AS lon, start_lat AS lat)"
    unfinished = (
        paired.filter("end_t IS NULL")
        .selectExpr(P.VIN, f"struct({EVENT_NAME} AS key, {place} AS value) AS entry")
        .groupBy(P.VIN)
        .agg({"entry": "collect_list"})
        .selectExpr(P.VIN, f"CAST(map_from_entries(`collect_list(entry)`) AS {OPEN_EVENTS}) AS open_events")
    )
    return state.join(unfinished, P.VIN, "left")


class Step(NamedTuple):
    """Closed trips, closed events (if asked for) and the state for the next run."""

    trips: DataFrame
    events: DataFrame | None
    carry: DataFrame
    kept: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()
