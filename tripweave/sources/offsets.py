"""A log of messages on shared storage that a stream reads by offsets, as it would read a topic.

Each message has a partition and a number in it, without gaps from 0. The log grows by appends, each a folder of its own with
segments by partition; an append counts only once its list of offsets is written, and one that failed midway is
replaced by the next. The stream plans from these small lists; tasks read the segments, each a range of offsets.
A query that starts again goes on from its checkpoint, so that nothing is lost or read twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tripweave.session import ship_helpers

FORMAT = "tripweave_log"
#: Messages of one segment, which one task reads, unless an append says otherwise; and of one batch inside the task.
SEGMENT, BATCH = 1_000_000, 10_000
EARLIEST, LATEST = -2, -1


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder as Spark names it; a bare path is local."""
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return pafs.LocalFileSystem(), uri.removeprefix("file:")


class Log:
    """What appends the log holds: of each, by partition, the first offset, the one after the last, and the messages of a segment."""

    def __init__(self, root: str) -> None:
        self._files, self._root = _open(root)
        self._known: dict[int, dict[str, list[int]]] = {}

    def appends(self) -> list[dict[str, list[int]]]:
        while True:
            path = f"{self._root}/offsets/{len(self._known)}.json"
            if self._files.get_file_info(path).type != pafs.FileType.File:
                return [self._known[n] for n in sorted(self._known)]
            with self._files.open_input_stream(path) as f:
                self._known[len(self._known)] = json.loads(f.read())

    def ends(self) -> dict[str, int]:
        """By partition the offset after its last message."""
        out: dict[str, int] = {}
        for append in self.appends():
            out.update({p: end for p, (_, end, _) in append.items()})
        return dict(sorted(out.items()))

    def publish(self, offsets: dict[str, list[int]]) -> None:
        n = len(self.appends())
        self._files.create_dir(f"{self._root}/offsets", recursive=True)
        with self._files.open_output_stream(f"{self._root}/offsets/{n}.part") as f:
            f.write(json.dumps(offsets, sort_keys=True).encode())
        self._files.move(f"{self._root}/offsets/{n}.part", f"{self._root}/offsets/{n}.json")


def append(messages: DataFrame, root: str, order: Sequence[str], partitions: int = 8, segment: int = SEGMENT) -> dict[str, int]:
    """Adds the column ``value`` of all rows to the log and returns the ends of its partitions.

    ``order``: columns that tell rows apart; rows are dealt to partitions by their hash, so that a vehicle of very many rows
    fills no partition, and numbered by them. One writer at a time; ``partitions`` and ``segment``, the messages that one task
    reads, may change from append to append.
    """
    spark, log = messages.sparkSession, Log(root)
    ends, n = log.ends(), len(log.appends())
    base = F.lit(0).cast("long")
    for p, end in ends.items():
        base = F.when(F.col("partition") == int(p), F.lit(end).cast("long")).otherwise(base)
    numbered = messages.withColumn("partition", F.pmod(F.xxhash64(*order), partitions).cast("int"))
    number = F.row_number().over(Window.partitionBy("partition").orderBy(*order)) - 1
    rows = numbered.select("partition", F.col("value").cast("binary").alias("value"), number.cast("long").alias("number"))
    rows = rows.select("partition", F.floor(F.col("number") / segment).alias("segment"), (F.col("number") + base).alias("offset"), "value")
    path = f"{root}/append={n}"
    rows.write.mode("overwrite").partitionBy("partition", "segment").parquet(path)
    counted = spark.read.schema(rows.schema).parquet(path).groupBy("partition").count().collect()  # one row for each partition
    firsts = {str(r.partition): ends.get(str(r.partition), 0) for r in counted}
    log.publish({p: [firsts[p], firsts[p] + r["count"], segment] for p, r in zip(firsts, counted)})
    return log.ends()


@dataclass
class Range(InputPartition):
    """Messages ``first`` up to ``end`` of one segment."""

    folder: str
    partition: int
    first: int
    end: int


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self._root, self._from = options["path"], options.get("startingoffsets", "latest")
        self._log = None

    def _ends(self) -> dict[str, int]:
        self._log = self._log or Log(self._root)
        return self._log.ends()

    def initialOffset(self) -> dict:
        ends = self._ends()
        if self._from in ("earliest", "latest"):
            return {p: 0 if self._from == "earliest" else end for p, end in ends.items()}
        given = {str(p): int(at) for p, at in json.loads(self._from).items()}
        for p, at in given.items():
            if not EARLIEST <= at <= ends.get(p, 0):
                raise ValueError(f"partition {p} of the log has no offset {at}")
        places = {EARLIEST: lambda p: 0, LATEST: lambda p: ends.get(p, 0)}
        starts = {p: places[at](p) if at < 0 else at for p, at in given.items()}
        return dict(sorted(({p: 0 for p in ends} | starts).items()))

    def latestOffset(self) -> dict:
        return self._ends()

    def partitions(self, start: dict, end: dict) -> Sequence[Range]:
        self._ends()
        out = []
        for n, held in enumerate(self._log.appends()):
            for p, (first, after, size) in held.items():
                low, high = max(first, start.get(p, 0)), min(after, end.get(p, 0))
                for segment in range((low - first) // size, -(-(high - first) // size) if low < high else 0):
                    begins = first + segment * size
                    folder = f"{self._root}/append={n}/partition={p}/segment={segment}"
                    out.append(Range(folder, int(p), max(low, begins), min(high, begins + size)))
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        files, folder = _open(partition.folder)
        for info in files.get_file_info(pafs.FileSelector(folder)):
            if not info.path.endswith(".parquet"):
                continue
            with files.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(BATCH, columns=["offset", "value"]):
                    at = batch.column("offset")
                    batch = batch.filter(pc.and_(pc.greater_equal(at, partition.first), pc.less(at, partition.end)))
                    place = pa.array([partition.partition] * batch.num_rows, pa.int32())
                    yield pa.RecordBatch.from_arrays([place, batch.column("offset"), batch.column("value")], names=["partition", "offset", "value"])

    def __getstate__(self) -> dict:
        # A file system stays where it was opened.
        return self.__dict__ | {"_log": None}


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "partition int, offset long, value binary"

    def streamReader(self, schema) -> LogReader:
        return LogReader(dict(self.options))


def log_stream(spark: SparkSession, root: str, starting_offsets: str = "latest") -> DataFrame:
    """The log as a stream of ``partition``, ``offset`` and the text column ``json_str``, as a topic gives it.

    ``starting_offsets``: "earliest", "latest", or JSON of the first offset by partition (-2 earliest, -1 latest; partitions
    that are not named are read from their start). It holds for a query's first start only.
    """
    ship_helpers()
    spark.dataSource.register(LogSource)
    rows = spark.readStream.format(FORMAT).option("startingOffsets", starting_offsets).load(root)
    return rows.select("partition", "offset", F.col("value").cast("string").alias("json_str"))
