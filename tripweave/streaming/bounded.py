"""Bounded streams by the batch engine: each micro-batch is one incremental run.

A micro-batch's rows join those that still wait, the watermark moves on, and the rows it has passed go through
``engine.step`` with the carried state; silent trips end at the watermark. What a run leaves for the next
is kept in tables named by batch, so a batch that is repeated reads what its predecessor left and
replaces what it wrote itself. No row passes through Python, and a vehicle of very many rows is split as in any run.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave import engine
from tripweave import profiles as P
from tripweave.operators import skew
from tripweave.operators.segment import lanes
from tripweave.sources.streams import state_table
from tripweave.sources.telemetry import CONTENT, REASON, rejected_results

ROWS, CARRY, CLOCK = "lanes", "carry", "clock"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class BoundedRuns:
    """A callback for ``foreachBatch`` over canonical telemetry that hands result rows on.

    ``root``: folder of the tables between runs, shared by all executors; a query that starts anew needs a new one.
    ``on_results``: gets result rows and the batch id. ``delay``: how far the watermark stays behind the latest row.
    Rows at or before the watermark of the batch before are late and left out, as the stream's operator does. If
    the rows say why some cannot be placed (``sources.telemetry.judged``), those come out as result rows of their own.
    ``carry``: state that an earlier run left, which the first batch goes on from.
    """

    def __init__(
        self,
        root: str,
        on_results: Callable[[DataFrame, int], None],
        profile: P.Profile = P.UNIFIED,
        delay: str = "10 minutes",
        hot_rows: int | None = skew.HOT_ROWS,
        carry: DataFrame | None = None,
    ) -> None:
        self._carry = carry
        self._root, self._on_results, self._profile, self._delay, self._hot_rows = root, on_results, profile, delay, hot_rows

    def path(self, table: str, batch_id: int) -> str:
        return f"{self._root}/{table}/batch={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        judged = batch if REASON in batch.columns else batch.withColumns({REASON: F.lit(None).cast("string"), CONTENT: F.lit(None).cast("string")})
        before, passed = self._carry, None
        if batch_id > 0:
            passed = spark.read.parquet(self.path(CLOCK, batch_id - 1)).first().passed_us
            before = state_table(spark, self.path(CARRY, batch_id - 1))
        judged = lanes(judged, keep_time=True, also=(REASON, CONTENT))
        fresh, late = judged, F.lit(False)
        if passed is not None:
            late = F.col(REASON).isNull() & (F.unix_micros(P.TIMESTAMP) <= passed)
            waiting = spark.read.schema(judged.schema).parquet(self.path(ROWS, batch_id - 1))
            fresh = judged.filter(~late).unionByName(waiting.filter(F.col(REASON).isNull() & (F.unix_micros(P.TIMESTAMP) > passed)))
        # Written once, and only what the windows need: what follows reads it several times.
        fresh.write.mode("overwrite").parquet(self.path(ROWS, batch_id))
        rows = spark.read.schema(judged.schema).parquet(self.path(ROWS, batch_id))
        placed, rejected = rows.filter(F.col(REASON).isNull()), rows.filter(F.col(REASON).isNotNull())

        reached = placed.agg(F.unix_micros(F.date_trunc("MILLISECOND", F.max(P.TIMESTAMP)) - F.expr(f"INTERVAL {self._delay}")).alias("us")).first().us
        passed = max((x for x in (passed, reached) if x is not None), default=None)
        results = rejected_results(rejected.withColumnsRenamed({"speed": P.SPEED, "lon": P.LON, "lat": P.LAT}))
        if passed is None:
            step = None
            carry = before if before is not None else spark.createDataFrame([], engine.schemas.CARRY)
        else:
            known = placed.filter(F.unix_micros(P.TIMESTAMP) <= passed)
            step = engine.step_lanes(before, known.drop(P.TIMESTAMP, REASON, CONTENT), EPOCH + timedelta(microseconds=passed), self._profile, hot_rows=self._hot_rows, keep=True)
            carry = step.carry
            results = engine.result_rows(step.trips, step.events).withColumn(CONTENT, F.lit(None).cast("string")).unionByName(results)
        try:
            self._on_results(results, batch_id)
            carry.write.mode("overwrite").parquet(self.path(CARRY, batch_id))
        finally:
            if step is not None:
                step.release()
        spark.createDataFrame([(passed,)], "passed_us long").coalesce(1).write.mode("overwrite").parquet(self.path(CLOCK, batch_id))
        # A repeated batch needs its predecessor only.
        for table in (ROWS, CARRY, CLOCK):
            _delete(spark, self.path(table, batch_id - 2))


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
