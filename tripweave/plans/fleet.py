"""The ``events`` table read as vehicle telemetry.

Every user is a vehicle. Time is compressed 40-fold, so that gaps lie around the 15 minute
limits, and floored to whole seconds, which leaves some rows of a vehicle at equal times;
``event_id`` orders those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave import profiles as P
from tripweave.sources.telemetry import normalize

EPOCH_US = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC
SQUEEZE_US = 40_000_000

# One rule per flag on the number in props, written alike for Spark and DuckDB.
FLAG_RULES = {
    "ivi_power_status": "k % 2",
    "trunk_door_status": "CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END",
} | {
    flag: f"CASE WHEN k % {n} < {max(1, n // 2)} THEN 1 ELSE 0 END"
    for n, flag in enumerate(P.FLAGS[2:], start=3)
}
POWER_RULE = "CASE event_type WHEN 'signup' THEN 2 WHEN 'error' THEN 0 WHEN 'click' THEN 1 END"
SPEED_RULE = "CASE WHEN event_type IN ('view', 'purchase') THEN value ELSE 0.0 END"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_raw(events: DataFrame) -> DataFrame:
    """Telemetry columns, not yet normalised."""
    seconds = f"floor((unix_micros(CAST(ts AS TIMESTAMP)) - {EPOCH_US}) / {SQUEEZE_US})"
    columns = {
        "event_id": "event_id",
        P.VIN: "'V' || user_id",
        P.TIMESTAMP: f"timestamp_micros({EPOCH_US} + {seconds} * 1000000)",
        P.POWER: POWER_RULE,
        P.SPEED: SPEED_RULE,
        P.LON: "120.0D + k / 100.0D",
        P.LAT: "30.0D + user_id / 1000.0D",
    } | FLAG_RULES
    numbered = events.selectExpr("*", r"CAST(regexp_extract(props, r'(\d+)', 1) AS INT) AS k")
    return numbered.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(as_raw(events_table(spark, sf_dir)), tie="event_id")
