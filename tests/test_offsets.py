"""The log that streams read by offsets."""

import json

import pytest
from pyspark.sql import functions as F

from tripweave.session import scratch_dir
from tripweave.sources.offsets import Log, LogReader, append, log_stream


def messages(spark, first, end, vin="A"):
    return spark.range(first, end).select("id", F.concat_ws(" ", F.lit(vin), "id").alias("value"))


def drained(spark, log, folder, starting_offsets):
    """All messages that a query has read after one more start: (partition, offset, text)."""
    query = (
        log_stream(spark, log, starting_offsets)
        .writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted(tuple(r) for r in spark.read.parquet(f"{folder}/rows").collect())


def test_a_restart_goes_on_from_the_checkpoint(spark):
    """One vehicle, several segments and appends, more partitions later: every message once, numbers without gaps."""
    root = scratch_dir(spark)
    log, folder = f"{root}/log", f"{root}/query"
    ends = append(messages(spark, 0, 100), log, ["id"], partitions=3, segment=10)
    assert sum(ends.values()) == 100 and max(ends.values()) < 60
    first = drained(spark, log, folder, "earliest")
    assert sorted(t for _, _, t in first) == sorted(f"A {i}" for i in range(100))
    append(messages(spark, 100, 150), log, ["id"], partitions=5, segment=7)
    append(messages(spark, 150, 150), log, ["id"], partitions=5)
    ends = append(messages(spark, 150, 170), log, ["id"], partitions=2)
    rows = drained(spark, log, folder, "earliest")
    assert sorted(t for _, _, t in rows) == sorted(f"A {i}" for i in range(170))
    assert [(p, o) for p, o, _ in rows] == [(int(p), o) for p, end in sorted(ends.items()) for o in range(end)]
    assert set(first) < set(rows)
    assert drained(spark, log, folder, "earliest") == rows


def test_given_offsets(spark):
    root = scratch_dir(spark)
    log = f"{root}/log"
    ends = append(messages(spark, 0, 60), log, ["id"], partitions=3, segment=8)
    every = drained(spark, log, f"{root}/all", "earliest")
    given = json.dumps({"0": 5, "1": -1, "2": -2})
    assert drained(spark, log, f"{root}/given", given) == [r for r in every if r[0] == 2 or (r[0] == 0 and r[1] >= 5)]
    reader = lambda start: LogReader({"path": log, "startingoffsets": start})
    assert reader(json.dumps({"0": 5})).initialOffset() == {"0": 5, "1": 0, "2": 0}
    assert reader("latest").initialOffset() == ends == reader("latest").latestOffset()
    assert reader("latest").partitions(ends, ends) == []
    for wrong in ({"0": 61}, {"7": 1}, {"0": -3}):
        with pytest.raises(ValueError):
            reader(json.dumps(wrong)).initialOffset()


def test_an_append_that_failed_midway_is_replaced(spark):
    """Its files are there, its offsets are not: nobody reads it, and the next append takes its place."""
    root = scratch_dir(spark)
    log = f"{root}/log"
    append(messages(spark, 0, 20), log, ["id"], partitions=2)
    lost = messages(spark, 20, 40, "lost").select(F.lit(0).alias("partition"), F.lit(0).alias("segment"), F.col("id").alias("offset"), F.col("value").cast("binary"))
    lost.write.partitionBy("partition", "segment").parquet(f"{log}/append=1")
    assert len(drained(spark, log, f"{root}/query", "earliest")) == 20
    append(messages(spark, 20, 30), log, ["id"], partitions=2)
    assert len(Log(log).appends()) == 2
    rows = drained(spark, log, f"{root}/query", "earliest")
    assert sorted(t for _, _, t in rows) == sorted(f"A {i}" for i in range(30))


def test_no_messages(spark):
    root = scratch_dir(spark)
    assert Log(f"{root}/log").ends() == {}
    assert LogReader({"path": f"{root}/log", "startingoffsets": "earliest"}).initialOffset() == {}
