"""Sinks that merge: a row replaces the one of the same trip, kind and start, and a batch written again changes nothing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.sinks.tables import BATCH, JOB, Writer

#: What names a row; columns that a table lacks are left out.
KEY = ("trip_id", "row_type", "trip_type", "start_time")
DAY = "day"
#: Who wrote a row says nothing about the row itself.
WRITERS = (BATCH, JOB)


def _key(rows: DataFrame) -> list[str]:
    return [c for c in KEY if c in rows.columns]


def _same(names: list[str]) -> list[Column]:
    return [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names]


def latest(rows: DataFrame) -> DataFrame:
    """One row for each key: that of the latest batch, then of the latest end, then the largest by its columns.

    An aggregate that is combined before its exchange, so that a key of very many rows is no matter.
    """
    key = _key(rows)
    rank = F.struct(*[c for c in (BATCH, "end_time") if c in rows.columns], *[c for c in rows.columns if c not in (BATCH, "end_time", *key)])
    whole = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), rank).alias("row"))
    return whole.select("row.*")


def unseen(batch: DataFrame, target: DataFrame) -> DataFrame:
    """The batch's rows that the target does not hold just as they are, whoever wrote them."""
    columns = [c for c in batch.columns if c not in WRITERS and c in target.columns]
    return batch.alias("a").join(target.alias("b"), _same(columns), "left_anti")


def _file(spark: SparkSession, folder: str, name: str = "", delete: bool = False) -> bool:
    """Whether a file is there; with ``delete``, it is taken away."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}" if name else folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.delete(place, True) if delete else system.exists(place)


def merge_writer(folder: str, fmt: str = "parquet") -> Writer:
    """Merges each batch into a table of files by day of ``start_time``; the table holds one row for each key.

    Only the days that the batch brings something new for are read whole and written again. The new days are written beside
    the table before it is touched: if the job ends in between, the batch that Spark repeats puts these in
    place instead of merging anew, so a job that broke off must come back before another writes to the table.
    Columns that only the batch or only the table has are null for the rows of the other. The days of a batch (not its rows) are known to the driver.
    """

    def write(rows: DataFrame, table: str, batch_id: int) -> None:
        spark, target = rows.sparkSession, f"{folder}/{table}"
        writer = rows.select(JOB if JOB in rows.columns else F.lit("")).first()
        if writer is None:
            return
        aside = f"{folder}/{table}_merging/{writer[0]}-{batch_id}"
        if not _file(spark, aside, "_SUCCESS"):
            batch = latest(rows.withColumns({BATCH: F.lit(batch_id).cast("long"), DAY: F.to_date("start_time")}))
            merged = _merged(batch, spark.read.format(fmt).load(target)) if _file(spark, target) else batch
            if merged is None:
                return
            merged.write.format(fmt).mode("overwrite").save(aside)
        ready = spark.read.format(fmt).load(aside)
        ready.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).save(target)
        # A batch that is written again from here on finds its rows in place.
        _file(spark, aside, delete=True)

    return write


def _merged(batch: DataFrame, table: DataFrame) -> DataFrame | None:
    """The rows of all days that the batch changes, as they should be afterwards; none if it changes nothing."""
    table = table.withColumn(DAY, F.col(DAY).cast("date"))
    days = [r[0] for r in batch.select(DAY).distinct().collect()]  # a value for each day
    new = unseen(batch, _of_days(table, days))
    days = [r[0] for r in new.select(DAY).distinct().collect()]
    if not days:
        return None
    key = [DAY, *_key(batch)]
    new, old = _of_days(new, days), _of_days(table, days)
    kept = old.alias("a").join(new.select(*key).alias("b"), _same(key), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def _of_days(rows: DataFrame, days: list) -> DataFrame:
    """Pruned by partition; rows without a start have a partition of their own."""
    known = F.col(DAY).isin([d for d in days if d is not None])
    return rows.filter(known | F.col(DAY).isNull() if None in days else known)


def read_merged(spark: SparkSession, folder: str, table: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{folder}/{table}").drop(DAY)


def jdbc_merge_writer(url: str, driver: str, database: str, options: Mapping[str, str] | None = None) -> Writer:
    """Appends by JDBC the rows that the warehouse does not hold just as they are; ``latest`` of the table is the merge.

    The table is read between the batch's first and last start only, by its database. A batch written again appends nothing
    and a corrected row comes in beside the older one with a later batch id; where the warehouse keeps unique keys it
    replaces it. The table must exist.
    """

    def of(rows, table: str):
        """A reader or writer of the table."""
        return rows.format("jdbc").option("driver", driver).option("url", url).option("dbtable", f"{database}.{table}").options(**(options or {}))

    def write(rows: DataFrame, table: str, batch_id: int) -> None:
        batch = latest(rows.withColumn(BATCH, F.lit(batch_id).cast("long")))
        held = within(of(rows.sparkSession.read, table).load(), batch)
        of(unseen(batch, held).write, table).mode("append").save()

    return write


def within(table: DataFrame, batch: DataFrame) -> DataFrame:
    """The table's rows that start between the batch's first and last start, by filters that reach its source."""
    start = F.unix_micros("start_time")
    first, last, open_rows = batch.agg(F.min(start), F.max(start), F.count_if(start.isNull())).first()
    held = F.lit(False) if first is None else F.col("start_time").between(F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last)))
    return table.filter(held | F.col("start_time").isNull() if open_rows else held)
