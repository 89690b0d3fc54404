"""Batch and streaming sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave import schemas


def table_stream(
    spark: SparkSession,
    table: str,
    fmt: str = "paimon",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A lake table as a stream; the format's connector must be on the class path.

    Formats that know no schema of their own (files) need ``schema``.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    return (reader.schema(schema) if schema else reader).load(table)


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A topic as a stream of one text column ``json_str``."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**(options or {}))
        .load()
        .select(F.col("value").cast("string").alias("json_str"))
    )


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str = schemas.TELEMETRY,
    files_per_batch: int | None = 1,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A parquet folder as a stream, ``files_per_batch`` files in each micro-batch."""
    reader = spark.readStream.schema(schema).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def decode_json(raw: DataFrame, ddl: str = schemas.WIRE_DDL, column: str = "json_str") -> DataFrame:
    """JSON text to columns; text that does not parse is kept in ``bad_row``.

    Works on batch and streaming frames. Good rows have a null ``bad_row``.
    """
    full = f"{ddl}, bad_row STRING"
    parsed = F.from_json(
        F.col(column), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad_row"}
    )
    return raw.select(parsed.alias("j")).select("j.*")


def state_table(spark: SparkSession, path: str) -> DataFrame:
    """Carried state of the previous run."""
    return spark.read.schema(schemas.CARRY).parquet(path)
