"""Sinks of result rows: two tables per micro-batch, or one folder of files."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tripweave.operators.report import only_events, only_trips, without_row_type
from tripweave.sources.telemetry import CONTENT, REJECTED

LOG = logging.getLogger(__name__)

BATCH = "batch_id"
JOB = "job"
Writer = Callable[[DataFrame, str, int], None]


def file_writer(folder: str, fmt: str = "parquet") -> Writer:
    """Writes each batch of each job into a partition of its own; a repeated batch replaces itself.

    Jobs count their batches on their own, so rows that name their job (see ``split_tables``) are
    kept apart by it. A job that starts anew without its checkpoint needs another name or folder.
    """

    def write(rows: DataFrame, table: str, batch_id: int) -> None:
        (
            rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
            .write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*[c for c in (JOB, BATCH) if c == BATCH or c in rows.columns])
            .save(f"{folder}/{table}")
        )

    return write


def jdbc_writer(url: str, driver: str, database: str, options: Mapping[str, str] | None = None) -> Writer:
    """Appends each batch by JDBC.

    A repeated batch is appended again: the batch id and the key (trip_id, trip_type,
    start_time) are in every row, for the warehouse to replace duplicates by.
    """

    def write(rows: DataFrame, table: str, batch_id: int) -> None:
        (
            rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
            .write.format("jdbc")
            .option("driver", driver)
            .option("url", url)
            .option("dbtable", f"{database}.{table}")
            .options(**(options or {}))
            .mode("append")
            .save()
        )

    return write


def split_tables(write: Writer, trips: str = "ads_trip_summary", events: str | None = "ads_trip_event_detail", job: str | None = None, rejected: str | None = None, keep: bool = True):
    """Per-batch callback: trips to one table, events to another, rejected rows to a third if it is named.

    ``events=None`` writes trips only, and keeps their ``row_type``. A batch without rows of a
    kind writes nothing for it. With ``job``, rows carry that name in a column. The rows of each kind are
    counted in one pass and logged. ``keep=False``: the caller keeps what the rows are made of, so they are not kept again.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if keep:
            batch.persist()
        try:
            plain = batch.drop(CONTENT)
            parts = {trips: ("TRIP", only_trips(plain) if not events else without_row_type(only_trips(plain)))}
            if events:
                parts[events] = ("EVENT", without_row_type(only_events(plain)))
            if rejected and CONTENT in batch.columns:
                left = batch.filter(F.col("row_type") == REJECTED)
                parts[rejected] = (REJECTED, left.select("vin", F.col("trip_type").alias("reason"), F.col("start_time").alias("timestamp"), F.col("max_speed").alias("speed"), CONTENT))
            counts = {r.row_type: r["count"] for r in batch.groupBy("row_type").count().collect()}  # a row for each kind
            LOG.info("batch %d of %s: %s", batch_id, job or "a job", counts)
            for table, (kind, rows) in parts.items():
                if counts.get(kind):
                    write(rows.withColumn(JOB, F.lit(job)) if job else rows, table, batch_id)
        finally:
            if keep:
                batch.unpersist()

    return on_batch


def csv_stream(results: DataFrame, path: str, files_per_batch: int | None = None) -> DataStreamWriter:
    """CSV files with a header. ``files_per_batch=1`` puts a (small) batch into one file."""
    if files_per_batch:
        results = results.coalesce(files_per_batch)
    return results.writeStream.format("csv").option("header", True).option("path", path).outputMode("append")
