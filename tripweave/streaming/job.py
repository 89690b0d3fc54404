"""The trip job: one operator over a realtime topic or a bounded table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave import profiles as P
from tripweave import schemas
from tripweave.sinks.tables import Writer, split_tables
from tripweave.sources import streams
from tripweave.sources.telemetry import CONTENT, REASON, judged, rejected_results, renamed
from tripweave.streaming.bounded import BoundedRuns
from tripweave.streaming.trips import SLICE_SECONDS, as_results, found_stream

# Trigger of each mode: run to the end of what is there, or look every ten seconds.
TRIGGERS = {"offline": {"availableNow": True}, "realtime": {"processingTime": "10 seconds"}}


@dataclass(frozen=True)
class JobConfig:
    """Where rows come from and where results go."""

    checkpoint_root: str
    write: Writer
    profile: P.Profile = P.UNIFIED
    delay: str = "10 minutes"
    slice_seconds: int = SLICE_SECONDS
    table: str = ""
    table_format: str = "paimon"
    servers: str = ""
    topic: str = ""
    starting_offsets: str = "latest"
    wire_schema: str = schemas.WIRE_DDL
    mapping: dict[str, str] = field(default_factory=lambda: dict(schemas.WIRE_MAPPING))
    tie: str | None = None
    trips_table: str = "ads_trip_summary"
    events_table: str | None = "ads_trip_event_detail"
    rejected_table: str | None = "ads_trip_rejected"
    # State that a T+1 run left, for a job that starts anew: it goes on from there.
    carry: str | None = None


def state_root(config: JobConfig, mode: str) -> str:
    """What one bounded run leaves for the next."""
    return f"{config.checkpoint_root}/trip_{mode}_state"


def checkpoint_path(config: JobConfig, mode: str) -> str:
    return f"{config.checkpoint_root}/trip_{mode}"


def source(spark: SparkSession, mode: str, config: JobConfig) -> DataFrame:
    """Canonical telemetry of the mode's source, with the reason of rows that cannot be placed."""
    if mode == "offline":
        raw = streams.table_stream(spark, config.table, config.table_format)
    elif mode == "realtime":
        text = streams.kafka_stream(spark, config.servers, config.topic, config.starting_offsets)
        decoded = streams.decode_json(text, config.wire_schema)
        raw = renamed(decoded, config.mapping)
    else:
        raise ValueError(f"mode must be one of {', '.join(TRIGGERS)}, not {mode!r}")
    return judged(raw, tie=config.tie)


def start(
    telemetry: DataFrame,
    mode: str,
    config: JobConfig,
    on_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Starts the query that writes trips and events of streaming telemetry.

    A bounded stream is run by the batch engine (``bounded``), a topic by keyed state. Telemetry of ``judged`` has rejected
    rows besides, which get a table of their own.
    """
    callback = on_batch or split_tables(config.write, config.trips_table, config.events_table, mode, config.rejected_table, keep=False)
    carry = streams.state_table(telemetry.sparkSession, config.carry) if config.carry else None
    if mode == "offline":
        results, callback = telemetry, BoundedRuns(state_root(config, mode), callback, config.profile, config.delay, carry=carry)
    else:
        placed = telemetry.filter(f"{REASON} IS NULL").drop(REASON, CONTENT) if REASON in telemetry.columns else telemetry
        results = found_stream(placed, config.profile, config.delay, config.slice_seconds, carry)
        if REASON in telemetry.columns:
            left = telemetry.filter(f"{REASON} IS NOT NULL").select(P.VIN, P.TIMESTAMP, P.SPEED, P.LON, P.LAT, REASON, CONTENT)
            results = results.unionByName(left, allowMissingColumns=True)
        callback = _kept_narrow(callback)
    return (
        results.writeStream.foreachBatch(callback)
        .option("checkpointLocation", checkpoint_path(config, mode))
        .trigger(**TRIGGERS[mode])
        .start()
    )


def _kept_narrow(callback: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Keeps a batch of what the stream found as it is, far narrower than result rows, and hands result rows on."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if REASON in batch.columns:
                placed = as_results(batch.filter(f"{REASON} IS NULL")).withColumn(CONTENT, F.lit(None).cast("string"))
                callback(placed.unionByName(rejected_results(batch.filter(f"{REASON} IS NOT NULL"))), batch_id)
            else:
                callback(as_results(batch), batch_id)
        finally:
            batch.unpersist()

    return on_batch


def run_trip_job(spark: SparkSession, mode: str, config: JobConfig) -> StreamingQuery:
    """Source, operator and sink of a mode; the caller waits for or stops the query."""
    return start(source(spark, mode, config), mode, config)
