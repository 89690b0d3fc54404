"""The T+1 run: yesterday's state and today's rows in, three tables out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tripweave import engine
from tripweave import profiles as P
from tripweave.sources.streams import state_table

TRIPS, EVENTS, STATE = "trips", "events", "state"


def day_path(root: str, table: str, day: str) -> str:
    return f"{root}/{table}/day={day}"


def state_path(root: str, day: str) -> str:
    return day_path(root, STATE, day)


def run_day(
    spark: SparkSession,
    telemetry: DataFrame,
    root: str,
    day: str,
    day_before: str | None,
    now: datetime | str | None = None,
    profile: P.Profile = P.UNIFIED,
    with_events: bool = True,
) -> None:
    """Writes the day's closed trips and events, and the state for the day after.

    Each table has a partition per day that a repeated run replaces, also by no rows; the state
    of the day before is only read. So a run may fail anywhere and be repeated.
    """
    carry = state_table(spark, state_path(root, day_before)) if day_before else None
    step = engine.step(carry, telemetry, now, profile, with_events, keep=True)
    try:
        for table, rows in ((TRIPS, step.trips), (EVENTS, step.events)):
            if rows is None:
                continue
            rows.write.mode("overwrite").parquet(day_path(root, table, day))
        step.carry.write.mode("overwrite").parquet(state_path(root, day))
    finally:
        step.release()
