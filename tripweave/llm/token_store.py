"""Token ids of documents in raw shard files with a perfect-hash index, for keyed access in constant time.

A store is a folder:

- `shards/*.ids`: the ids of documents in ascending key order, as they are (little-endian, 2 bytes where the vocabulary
  allows it, else 4), then the documents' lengths (8 bytes each) and a footer of four 8-byte numbers: documents, ids,
  bytes an id, mark.
- `manifest`: a Parquet table with a row for each shard: name, order, first position, ids, documents. Only files that it
  names belong to the store, so what a lost or repeated task has left behind does no harm.
- `index/*.mph`, named in the table `parts`: keys are dealt by hash to parts of a bounded number of keys; each part has a
  minimal perfect hash and, by slot, the key's fingerprint (the other 64 bits of its hash), shard, place in the shard,
  ids before it in the store, ids, documents and last shard.

A key is the text form of the id column; null counts as a key of its own and comes first. Rows that repeat a key lie next
to each other and have one entry, which spans them all, over several shards if need be.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.llm.common import blank, filesystem, ship
from tripweave.llm.perfect_hash import PerfectHash
from tripweave.llm.tokens import encoder

MARK = 0x5457544F4B454E53
FOOTER = 32
#: Ids after which a task begins a new shard file.
SHARD_IDS = 128 << 20
#: Keys of one index part, on average.
PART_KEYS = 1 << 16
#: Bytes of ids in one batch of rows read.
READ_BYTES = 8 << 20
NULL_KEY = "\x00"
VALUES = {"shard": "<u4", "place": "<u8", "start": "<u8", "n_tokens": "<u8", "copies": "<u8", "last": "<u4"}
ENTRY = np.dtype([("fingerprint", "<u8"), *VALUES.items()])
PARTS = "part long, n_parts long, file string, n_keys long"


def _key(id_col: str) -> Column:
    """An id as text; null is NULL_KEY, and ids that begin like it get one more, so that no two ids share a key."""
    text = F.col(id_col).cast("string")
    return F.coalesce(F.when(text.startswith(NULL_KEY), F.concat(F.lit(NULL_KEY), text)).otherwise(text), F.lit(NULL_KEY))


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.concat(key, F.lit("\x01")))


def key_hashes(key: object) -> tuple[int, int]:
    """The two hashes of one key, as Spark's xxhash64 has them."""
    raw = NULL_KEY.encode() if key is None else str(key).encode()
    raw = NULL_KEY.encode() + raw if key is not None and raw.startswith(NULL_KEY.encode()) else raw
    return xxhash.xxh64_intdigest(raw, 42), xxhash.xxh64_intdigest(raw + b"\x01", 42)


class _ShardWriter:
    """Writes one task's documents into shard files, a new one after SHARD_IDS ids."""

    def __init__(self, folder: str, dtype: str, shard_ids: int) -> None:
        self.folder, self.dtype, self.shard_ids = folder, np.dtype(dtype), shard_ids
        context = TaskContext.get()
        self.prefix = f"{context.partitionId():06d}" if context else "000000"
        self.attempt, self.rolled, self.out = uuid.uuid4().hex[:12], 0, None
        self.fs, self.path = filesystem(folder)

    def add(self, ids: bytes) -> tuple[str, int, int]:
        """Name of the file, place of the document in it, ids."""
        if self.out is not None and self.at >= self.shard_ids:
            self.close()
        if self.out is None:
            self.name = f"{self.prefix}-{self.rolled:04d}-{self.attempt}.ids"
            self.rolled, self.at, self.lengths = self.rolled + 1, 0, []
            self.fs.create_dir(self.path, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", buffer_size=1 << 20)
        self.out.write(ids)
        n, place = len(ids) // self.dtype.itemsize, self.at
        self.at += n
        self.lengths.append(n)
        return self.name, place, n

    def close(self) -> None:
        if self.out is not None:
            self.out.write(np.array(self.lengths, "<u8").tobytes())
            self.out.write(np.array([len(self.lengths), self.at, self.dtype.itemsize, MARK], "<u8").tobytes())
            self.out.close()
            self.out = None


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", spaced: bool = False, dtype: str = "<u2", shard_ids: int = SHARD_IDS, part_keys: int = PART_KEYS) -> None:
    """Encodes every whole text and writes the store.

    tokenizer: path of the tokenizer's file on the executors. end_id: put after each document's ids, if any.
    A null text counts as empty: its document has just the end id. Other columns of `docs` don't matter. A table without
    rows gives a store without shards. Texts, not ids, are exchanged once, by key range; rows of one key may lie on
    both sides of a range's border.
    """
    spark = docs.sparkSession
    ship(spark)
    tail = b"" if end_id is None else np.array([end_id], dtype).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, words = _ShardWriter(f"{path}/shards", dtype, shard_ids), encoder(tokenizer, spaced, dtype)
        for batch in batches:
            rows = []
            for ids, borders in words.encode_all(batch.column("text")):
                for low, high in zip(borders[:-1].tolist(), borders[1:].tolist()):
                    rows.append(writer.add(ids[low:high].tobytes() + tail))
            names, places, counts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(names, pa.string()), pa.array(places, pa.int64()), pa.array(counts, pa.int64())],
                names=["key", "file", "place", "n_tokens"],
            )
        writer.close()

    ordered = docs.select(F.col(id_col).alias("id"), blank(F.col(text_col)).alias("text"))
    ordered = ordered.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    ordered.select(_key("id").alias("key"), "text").mapInArrow(write, "key string, file string, place long, n_tokens long").write.option("compression", "zstd").parquet(f"{path}/entries")
    entries = spark.read.schema("key string, file string, place long, n_tokens long").parquet(f"{path}/entries")

    # A row for each shard: as few as there are files of SHARD_IDS ids or tasks.
    shards = entries.groupBy("file").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.split("file", "-")[0].cast("long"), "file")
    shards = shards.select((F.row_number().over(order) - 1).alias("shard"), "file", "n_tokens", "n_docs", (F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("first"))
    shards.write.parquet(f"{path}/manifest")
    manifest = spark.read.schema(shards.schema).parquet(f"{path}/manifest")

    placed = entries.join(manifest.select("file", "shard", "first"), "file")
    keys = placed.groupBy("key").agg(F.min(F.struct("shard", "place", (F.col("first") + F.col("place")).alias("start"))).alias("at"), F.max("shard").alias("last"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("copies"))
    n_parts = max(1, -(-(manifest.agg(F.sum("n_docs")).first()[0] or 0) // part_keys))
    a, b = _hashes(F.col("key"))
    dealt = keys.select(a.alias("a"), b.alias("b"), "at.shard", "at.place", "at.start", "n_tokens", "copies", "last", F.pmod(a, F.lit(n_parts)).alias("part"))
    dealt.groupBy("part").applyInArrow(lambda part: _write_part(part, f"{path}/index", n_parts), PARTS).write.parquet(f"{path}/parts")


def _write_part(table: pa.Table, folder: str, n_parts: int) -> pa.Table:
    a, b = (table.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
    mph = PerfectHash.build(a, b)
    slot = mph.slots(a, b)
    entries = np.zeros(len(a), ENTRY)
    entries["fingerprint"][slot] = b
    for name in VALUES:
        entries[name][slot] = table.column(name).to_numpy()
    out = io.BytesIO()
    out.write(mph.to_bytes())
    np.save(out, entries)
    part = table.column("part")[0].as_py()
    name = f"{part:08d}-{uuid.uuid4().hex[:12]}.mph"
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{name}") as file:
        file.write(out.getvalue())
    return pa.table({"part": [part], "n_parts": [n_parts], "file": [name], "n_keys": [len(a)]})


def _read(path: str, offset: int = 0, size: int | None = None) -> bytes:
    fs, where = filesystem(path)
    with fs.open_input_file(where) as file:
        file.seek(offset)
        return file.read() if size is None else file.read(size)


class Part:
    """One part of the index."""

    def __init__(self, raw: bytes) -> None:
        file = io.BytesIO(raw)
        self.mph, self.entries = PerfectHash.from_file(file), np.load(file)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of keys, and whether the fingerprints agree (else the key isn't in the store)."""
        if not len(self.entries):
            return np.zeros(len(a), ENTRY), np.zeros(len(a), bool)
        entries = self.entries[np.minimum(self.mph.slots(a, b), len(self.entries) - 1)]
        return entries, entries["fingerprint"] == b


def _parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARTS).parquet(f"{path}/parts")


def lookup(spark: SparkSession, path: str, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Entries of the distinct keys of `keys` that the store has: (key, shard, place, start, n_tokens, copies, last)."""
    some = _parts(spark, path).first()
    a, b = _hashes(F.col("key"))
    asked = keys.select(_key(id_col).alias("key")).distinct()
    asked = asked.select("key", a.alias("a"), b.alias("b"), F.pmod(a, F.lit(some.n_parts if some else 1)).alias("part"))
    asked = asked.join(_parts(spark, path).select("part", "file"), "part")

    def find(table: pa.Table) -> pa.Table:
        part = Part(_read(f"{path}/index/{table.column('file')[0].as_py()}"))
        entries, known = part.find(*(table.column(c).to_numpy().view(np.uint64) for c in ("a", "b")))
        found = {name: pa.array(entries[name][known].astype(np.int64)) for name in VALUES}
        return pa.table({"key": table.column("key").filter(pa.array(known)), **found})

    return asked.groupBy("part").applyInArrow(find, "key string, " + ", ".join(f"{name} long" for name in VALUES))


def read_store(spark: SparkSession, path: str, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents of `keys`, read from the shards by way of the index.

    A row for each stored document: key, start (ids of all documents before it), n_tokens, ids (binary, unsigned
    little-endian 32-bit). A key is the id as text, as `_key` gives it. Keys that the store lacks give no row, a key asked for twice gives its documents once.
    """
    manifest = spark.read.parquet(f"{path}/manifest")
    found = lookup(spark, path, keys, id_col)
    spans = found.select("key", "start", "n_tokens", F.explode(F.sequence("shard", "last")).alias("shard"))
    low = F.greatest(F.col("start"), F.col("first"))
    high = F.least(F.col("start") + F.col("n_tokens"), F.col("first") + F.col("shard_ids"))
    spans = spans.join(manifest.select(F.col("shard").cast("long").alias("shard"), "file", "first", F.col("n_tokens").alias("shard_ids")), "shard")
    spans = spans.select("key", "file", "first", (low - F.col("first")).alias("low"), (high - F.col("first")).alias("high"))
    ordered = spans.repartition("file").sortWithinPartitions("file", "low")
    return ordered.mapInArrow(lambda batches: _documents(batches, path), "key string, start long, n_tokens long, ids binary")


class _Shard:
    """An open shard: document borders and a window of ids that moves forward."""

    def __init__(self, path: str) -> None:
        fs, where = filesystem(path)
        self.file = fs.open_input_file(where)
        size = self.file.size()
        self.file.seek(size - FOOTER)
        n_docs, self.n_ids, width, mark = (int(x) for x in np.frombuffer(self.file.read(FOOTER), "<u8"))
        if mark != MARK:
            raise ValueError(f"{path} is not a complete shard")
        self.dtype = np.dtype(f"<u{width}")
        self.file.seek(self.n_ids * width)
        self.borders = np.concatenate([[0], np.cumsum(np.frombuffer(self.file.read(8 * n_docs), "<u8").astype(np.int64))])
        self.low, self.window = 0, np.zeros(0, self.dtype)

    def ids(self, low: int, high: int) -> np.ndarray:
        if low < self.low or high > self.low + len(self.window):
            width = self.dtype.itemsize
            self.file.seek(low * width)
            self.low, self.window = low, np.frombuffer(self.file.read(max(high - low, READ_BYTES // width) * width), self.dtype)
            self.window = self.window[: self.n_ids - low]
        return self.window[low - self.low : high - self.low]


def _documents(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    name, shard, rows, held = None, None, [], 0

    def out() -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["key", "start", "n_tokens", "ids"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["file"] != name:
                name, shard = row["file"], _Shard(f"{path}/shards/{row['file']}")
            begin, end = np.searchsorted(shard.borders, [row["low"], row["high"]])
            if row["low"] == row["high"]:  # documents without any id
                begin, end = np.searchsorted(shard.borders, row["low"]), np.searchsorted(shard.borders, row["low"], "right") - 1
            for low, high in zip(shard.borders[begin:end].tolist(), shard.borders[begin + 1 : end + 1].tolist()):
                ids = shard.ids(low, high).astype("<u4").tobytes()
                rows.append((row["key"], row["first"] + low, high - low, ids))
                held += len(ids)
                if held >= READ_BYTES:
                    yield out()
                    rows, held = [], 0
    if rows:
        yield out()
