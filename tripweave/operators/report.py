"""Filters, presentation and counts on result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave import profiles as P


def only_trips(results: DataFrame) -> DataFrame:
    return results.filter(F.col("row_type") == "TRIP")


def only_events(results: DataFrame) -> DataFrame:
    return results.filter(F.col("row_type") == "EVENT")


def without_row_type(results: DataFrame) -> DataFrame:
    return results.drop("row_type")


def of_day(trips: DataFrame, day: str) -> DataFrame:
    """Trips that end on or after ``day``; those that began before it stay whole."""
    return trips.filter(F.col("end_time") >= F.lit(day).cast("timestamp"))


def of_vehicle(rows: DataFrame, vin: str) -> DataFrame:
    return rows.filter(F.col(P.VIN) == vin)


def except_vehicle(rows: DataFrame, vin: str) -> DataFrame:
    return rows.filter(F.col(P.VIN) != vin)


def minutes(start: Column, end: Column) -> Column:
    return F.round((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60, 1)


def presented(trips: DataFrame) -> DataFrame:
    """Readable trips: short times, rounded speeds, length in minutes, by vehicle and start."""
    return trips.select(
        P.VIN,
        "trip_type",
        F.date_format("start_time", "MM-dd HH:mm:ss").alias("start_text"),
        F.date_format("end_time", "MM-dd HH:mm:ss").alias("end_text"),
        F.round("max_speed", 2).alias("max_speed"),
        F.round("avg_speed", 2).alias("avg_speed"),
        minutes(F.col("start_time"), F.col("end_time")).alias("minutes"),
    ).orderBy(P.VIN, "start_text")


def count_by_type(trips: DataFrame) -> DataFrame:
    return trips.groupBy("trip_type").count()


def with_parent(events: DataFrame, trips: DataFrame) -> DataFrame:
    """Events beside their trip's type and time."""
    parent = trips.select(
        "trip_id",
        F.col("trip_type").alias("parent_type"),
        F.col("start_time").alias("parent_start"),
        F.col("end_time").alias("parent_end"),
    )
    return events.join(parent, "trip_id")


def gap_sessions(telemetry: DataFrame, gap: str = "15 minutes") -> DataFrame:
    """Stretches of a vehicle's rows without a long silence (batch or stream): vin, first_ts, last_ts, n_rows.

    A silence of exactly ``gap`` does not cut. Rows without a time are left out.
    In batch, rows of one slot of time as long as ``gap`` are always of one stretch, so they are summed up before they are
    exchanged; a vehicle of very many rows then has a row for each slot, not more than its time span divided by ``gap``. A
    stream merges what its tasks hold of a vehicle before the exchange (see ``session``).
    """
    if telemetry.isStreaming:
        merged = telemetry.groupBy(P.VIN, F.session_window(P.TIMESTAMP, gap).alias("stretch"))
        return merged.agg(F.min(P.TIMESTAMP).alias("first_ts"), F.max(P.TIMESTAMP).alias("last_ts"), F.count("*").alias("n_rows")).drop("stretch")
    at, long = F.unix_micros(P.TIMESTAMP), F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {gap})")
    slots = (
        telemetry.filter(F.col(P.TIMESTAMP).isNotNull())
        .groupBy(P.VIN, (at - F.pmod(at, long)).alias("slot"))
        .agg(F.min(P.TIMESTAMP).alias("first_ts"), F.max(P.TIMESTAMP).alias("last_ts"), F.count("*").alias("n_rows"))
    )
    in_order = Window.partitionBy(P.VIN).orderBy("slot")
    silence = F.unix_micros("first_ts") - F.unix_micros(F.lag("last_ts").over(in_order))
    cut = slots.withColumn("cut", (silence > long).cast("int"))
    numbered = cut.withColumn("stretch", F.sum(F.coalesce("cut", F.lit(0))).over(in_order))
    whole = numbered.groupBy(P.VIN, "stretch").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_rows").alias("n_rows"))
    return whole.drop("stretch")
