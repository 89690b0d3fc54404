"""Packing of tokenised documents into sequences of bounded length by the sum of squares.

Only documents longer than a sequence are cut. A piece goes where the sum over all residual gaps of the squared number of
open sequences with that gap becomes smallest, which keeps sequences of many different gaps open and so finds a close fit
for whatever comes. The choice needs the counts by gap alone: a table of `capacity` numbers, whatever the number of
sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import blank, rows_per_batch, ship, staged, text_batches
from tripweave.llm.tokens import encoder

#: Texts that a task holds at a time.
BATCH_ROWS = 1_500
#: Pieces packed together in one task, on average: some 100 bytes each.
GROUP_PIECES = 1 << 16
#: Orders to try: pieces below this part of the capacity, and the share of them that waits for the end.
ORDERS = ((0.3, 0.2), (0.4, 0.7), (1.0, 1.0))


def placing_order(lengths: np.ndarray, capacity: int, below: float, share: float) -> np.ndarray:
    """Random order, with a share of the small pieces held back to the end, where they fill gaps longest first.

    With many pieces the rule does best on arrivals in random order, which keep a mix of gaps; with few, longest first.
    """
    rng = np.random.default_rng(0)
    held = (lengths < below * capacity) & (rng.random(len(lengths)) < share)
    last = np.flatnonzero(held)
    return np.concatenate([rng.permutation(np.flatnonzero(~held)), last[np.argsort(-lengths[last], kind="stable")]])


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece: the fewest sequences of those that ORDERS give."""
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tried = (sum_of_squares(lengths, capacity, placing_order(lengths, capacity, *order)) for order in ORDERS)
    return min(tried, key=lambda found: found[0].max())


def sum_of_squares(lengths: np.ndarray, capacity: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed in this order.

    Of places that leave the same sum, the fullest sequence is taken, and an open one before a new one.
    """
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    opened = 0
    # counts[g] open sequences have a gap of g. At 0 it stands for closing one, which adds no square.
    counts = np.zeros(capacity + 1)
    counts[0] = -0.5
    removed = np.full(capacity + 1, np.inf)  # -counts where there are any
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in order.tolist():
        size = int(lengths[i])
        if size >= capacity:
            bins[i], opened = opened, opened + 1
            continue
        change = counts[: capacity - size] + removed[size:capacity]
        best = int(change.argmin()) if len(change) else 0
        if len(change) and change[best] + 0.5 <= counts[capacity - size]:
            gap = best + size
            at = stacks[gap].pop()
            counts[gap] -= 1
            removed[gap] = -counts[gap] if counts[gap] else np.inf
        else:
            gap, at, opened = capacity, opened, opened + 1
        bins[i], offsets[i] = at, capacity - gap
        left = gap - size
        if left:
            stacks[left].append(at)
            counts[left] += 1
            removed[left] = -counts[left]
    return bins, offsets


def cut_into_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", dtype: str = "<u2") -> DataFrame:
    """Tokenises whole texts (null: empty), adds the end id and cuts what is longer than `capacity`.

    (uid, doc_id, piece, start, length, ids, ids_crc32): all pieces are full but perhaps a document's first; ids are
    little-endian bytes of `dtype`, the checksum is of unsigned 32-bit ids; `uid` tells pieces apart.
    """
    names = ("doc_id", "piece", "start", "length", "ids", "ids_crc32")
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    tail = np.array([end_id], dtype)

    def pieces(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        found, keys, at = [], batch.column("doc_id").to_pylist(), 0
        for flat, borders in encoder(tokenizer, True, dtype).encode_all(batch.column("text")):
            out: list[list] = [[] for _ in names]
            for low, high in zip(borders[:-1].tolist(), borders[1:].tolist()):
                ids = np.append(flat[low:high], tail)
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    piece = ids[a:b]
                    for column, value in zip(out, (keys[at], number, a, b - a, piece.tobytes(), zlib.crc32(piece.astype("<u4").tobytes()))):
                        column.append(value)
                at += 1
            found.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=list(names)))
        return found

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), blank(F.col(text_col)).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long"
    return rows.mapInArrow(text_batches(pieces), schema).withColumn("uid", F.monotonically_increasing_id())


def place(pieces: DataFrame, capacity: int, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces (uid, length and further columns, all carried along).

    Pieces are dealt to groups of a bounded size by a hash of their uid, so that each group is a random sample and packs
    as well as the whole does; each group is packed in one task. `pieces` must be a table that gives the same rows when it
    is read again. Repeated rows have uids of their own, so no group is hot.
    """
    n_groups = max(1, -(-pieces.count() // group_pieces))
    names = pieces.columns

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        order = np.argsort(table.column("uid").to_numpy(), kind="stable")
        bins, offsets = np.empty_like(lengths), np.empty_like(lengths)
        bins[order], offsets[order] = pack_lengths(lengths[order], capacity)
        group = table.column("__group")[0].as_py()
        return table.select(names).append_column("sequence_id", pa.array((group << 32) + bins)).append_column("offset", pa.array(offsets))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    dealt = pieces.withColumn("__group", F.pmod(F.xxhash64("uid"), F.lit(n_groups)))
    return dealt.groupBy("__group").applyInArrow(pack, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", group_pieces: int = GROUP_PIECES) -> tuple[DataFrame, DataFrame]:
    """Tokenises, cuts and packs documents.

    Returns the pieces with their ids, and their places: (uid, doc_id, piece, start, length, ids_crc32, sequence_id,
    offset). A null or empty text is one piece, its end id. Each of several rows with one id is packed. Null ids stay
    null. Other columns of `docs` are not looked at. A table without rows gives no pieces.
    """
    ship(docs.sparkSession)
    with rows_per_batch(docs.sparkSession, BATCH_ROWS):
        pieces = staged(cut_into_pieces(docs, tokenizer, capacity, end_id, id_col, text_col))
    return pieces, place(pieces.drop("ids"), capacity, group_pieces)


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, doc_ids, lengths): each sequence's ids in order and the documents they come from."""
    both = places.select("uid", "sequence_id", "offset", "doc_id", "length").join(pieces.select("uid", "ids"), "uid")
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))  # at most `capacity` pieces
    return both.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("n_tokens"),
        F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
        F.transform("parts", lambda p: p["length"]).alias("lengths"),
    )
