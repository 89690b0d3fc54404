"""Small helpers that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import os
import sys
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.session import scratch_dir

#: The white space that contracts name, as the inside of a character class.
SPACES = " \t-\r"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, so that they need no copy of it."""
    context = spark.sparkContext
    if getattr(context, "_tripweave_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    # The driver serves the file as long as the application lives.
    archive = os.path.join(context._temp_dir, "tripweave_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for base, _, names in os.walk(os.path.join(top, "tripweave")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    out.write(path, os.path.relpath(path, top))
    context.addPyFile(archive)
    context._tripweave_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, *partition_by: str) -> DataFrame:
    """Writes `df` as a table in the shared folder and reads it back.

    The table cuts the lineage: a lost executor costs no second pass over the texts.
    """
    path = scratch_dir(df.sparkSession)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._tripweave_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `staged` has written, once nothing reads them any more."""
    for table in tables:
        session = table.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(table._tripweave_path)
        path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Blocks of so many bytes are taken from the system one by one, so that it gets them back when they are freed.
OWN_BLOCK = 1 << 20


def give_back() -> None:
    """Returns freed memory to the system: a Python worker lives on between stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):
            library = ctypes.CDLL(None)
            library.mallopt(-3, OWN_BLOCK)  # M_MMAP_THRESHOLD
            library.malloc_trim(0)


@contextlib.contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Inside, jobs hand batches of at most so many rows to Python; the session's own setting holds again after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


_MEMORY: dict = {}
_USED: list = []


def kept_by_worker(key, make: Callable):
    """What a Python worker keeps from task to task under `key`; that of another operator or setting goes first.

    Workers live on from stage to stage, so that two operators' memories would add up.
    """
    _USED.append(key)
    if key not in _MEMORY:
        _MEMORY.clear()
        give_back()
        _MEMORY[key] = make()
    return _MEMORY[key]


def text_batches(fn: Callable[[pa.RecordBatch], pa.RecordBatch | list]) -> Callable:
    """A function for mapInArrow that applies `fn` to each batch and drops empty results.

    What another operator has kept in the worker, and `fn` does not ask for, goes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _USED.clear()
                out = fn(batch)
                if not _USED:
                    _MEMORY.clear()
                yield from out if isinstance(out, list) else [out]
                del out
                give_back()

    return run


def join_counted(rows: DataFrame, table: DataFrame, key: str, count: str, least_hot: int = 1_000) -> DataFrame:
    """`rows` left-joined with a table that has one row for each `key`, among them how many rows hold it (`count`).

    Keys of at least `least_hot` rows and a hundred-thousandth of all are broadcast, which are a hundred thousand at most; rows
    with such a key or a null key are dealt at random, so that no task gets all rows of a key. Other keys meet by shuffle.
    """
    payload = [c for c in table.columns if c != key]
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = table.filter(F.col(count) >= max(least_hot, total // 100_000)).select(F.col(key).alias("__hot_key"), F.struct(*payload).alias("__hot"))
    cold = table.filter(F.col(count) < max(least_hot, total // 100_000)).select(F.col(key).alias("__cold_key"), F.struct(*payload).alias("__cold"), F.lit(0).cast("long").alias("__cold_salt"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot_key"), "left")
    apart = F.col("__hot_key").isNotNull() | F.col(key).isNull()
    marked = marked.withColumn("__salt", F.when(apart, F.xxhash64(F.monotonically_increasing_id()).bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long")))
    joined = marked.join(cold, (F.col(key) == F.col("__cold_key")) & (F.col("__salt") == F.col("__cold_salt")), "left")
    found = F.coalesce("__hot", "__cold")
    return joined.select(*(F.col(f"`{c}`") for c in rows.columns), *(found[c].alias(c) for c in payload))


def blank(text: Column) -> Column:
    """Null text as the empty text."""
    return F.coalesce(text, F.lit(""))


def unit_hash(*columns: Column) -> Column:
    """A number in [0, 1) from md5, the same in any SQL engine: its first 13 hexadecimal digits."""
    digits = F.substring(F.md5(F.concat_ws("|", *columns).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI as Spark's settings name it; a bare path is local."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


def single_threaded() -> None:
    """Keeps libraries inside a task to the one core that Spark counts for it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("OMP_NUM_THREADS", "1")
