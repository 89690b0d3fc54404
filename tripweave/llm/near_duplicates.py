"""Exact Jaccard self-join of documents on word shingles by adaptive multi-match prefixes, and its connected components.

Two documents link when 100 * shared shingles >= 80 * all shingles of the two. Equal sets are one class. The join runs in
steps, each of which passes on every class that may still have a partner:

1. Shingles in hash order: two classes that link share at least `more` of the first n - needed + more, for any `more`. A
   class keeps its place only if so many of its first shingles occur in other classes at all. Every task settles shingles
   that several of its own classes share; the rest meets by hash range, so that a shingle that a third of all documents
   hold is one entry for each task.
2. For what is left, the texts are read again and the whole sets kept. A counting table of bounded size estimates how many
   classes hold a shingle; shingles are then ordered by it, rarest first, and the prefix is lengthened for classes whose
   prefix is in many others, who must then share more of it.
3. Classes with a common prefix shingle meet in groups, by their most frequent one first. In a group, each class is compared
   with all that are not yet connected to it. After a few rounds most links are found, and pairs that share a prefix
   shingle, are not connected and have not met are compared one by one.

Texts with fewer words than a shingle count as one shingle; without words they have none and link with nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import discard, give_back, join_counted, ship, staged, text_batches
from tripweave.llm.words import groups_of

WORDS, PERCENT = 5, 80
#: Step 1 lengthens prefixes by this share of the set, and asks for as many more matches.
LENGTHENED = 0.05
#: First shingles that meet in one task of step 1, on average.
RANGE_TOKENS = 1_000_000
#: The counting table of step 2, and the most bits of the filter that names step 1's classes to the second reading.
COUNTERS_LOG2, FILTER_LOG2 = 20, 26
#: Estimated candidates of a prefix beyond which it is lengthened.
COSTLY = 2_000
#: Groups that a class meets others in, and the most classes and shingles of one group; larger ones are dealt anew at random.
ROUNDS, CHUNK_CLASSES, CHUNK_TOKENS = 3, 2_048, 1_500_000
#: Meetings of classes that are broadcast, some 30 bytes each; more are joined by exchange.
BROADCAST_MEETINGS = 2_000_000
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def needed(n: np.ndarray) -> np.ndarray:
    """The least overlap of a set of n with any set that it links with: the partner is no smaller than the overlap."""
    return -(-n * PERCENT // 100)


#: By byte: its value with A-Z as a-z and none zero, and whether it is white space.
BYTE_VALUES = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64) + np.uint64(1)
BYTE_SPACES = np.isin(np.arange(256), [32, *range(9, 14)])


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, ODD[0]))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts in a row, and where each text begins (one more border at the end).

    A hash is a polynomial in the word's bytes, worked out for all words at once.
    """
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    seen = ~BYTE_SPACES[data]
    begins = np.flatnonzero(seen & ~np.concatenate([[False], seen[:-1]]))
    text_starts = np.cumsum([0] + [len(r) + 1 for r in raw])
    borders = np.searchsorted(begins, text_starts)
    if not len(begins):
        return np.zeros(0, np.uint64), borders
    at = np.flatnonzero(seen)
    word = np.cumsum(np.diff(at, prepend=-2) > 1) - 1
    place = at - begins[word]
    with np.errstate(over="ignore"):
        terms = BYTE_VALUES[data[at]] * _powers(int(place.max()) + 1)[place]
    return _mixed(np.add.reduceat(terms, np.flatnonzero(place == 0))), borders


def _sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, borders = word_hashes(texts)
    size = np.diff(borders)
    out = [np.zeros(0, np.uint64)] * len(texts)
    with np.errstate(over="ignore"):
        for i in np.flatnonzero((size > 0) & (size < WORDS)).tolist():
            some = words[borders[i] : borders[i + 1]]
            out[i] = _mixed((some * np.array(ODD[: len(some)])).sum(keepdims=True) + np.uint64(len(some)) * ODD[4])
        last = max(len(words) - WORDS + 1, 0)
        rolled = _mixed(reduce(np.add, (words[k : last + k] * ODD[k] for k in range(WORDS))))
    for i in np.flatnonzero(size >= WORDS).tolist():
        out[i] = np.unique(rolled[borders[i] : borders[i + 1] - WORDS + 1])
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * ODD[1]
        x = (x ^ (x >> np.uint64(27))) * ODD[2]
        return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    return [s for part in groups_of(texts) for s in _sets(texts[part])]


def _signature(tokens: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


def _joined(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(b) // 8 for b in blobs], np.int64)
    return np.frombuffer(b"".join(blobs), np.uint64), sizes


# Step 1 ---------------------------------------------------------------------------------------------------------------


def _described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, sig, first): size and signature of each document's set, and its first shingles in hash order."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").to_pylist())
        n = np.array([len(s) for s in sets], np.int64)
        length = np.minimum(n, n - needed(n) + 1 + (LENGTHENED * n).astype(np.int64))
        first = [s[:k].tobytes() for s, k in zip(sets, length.tolist())]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(map(_signature, sets), pa.binary()), pa.array(first, pa.binary())], names=["doc_id", "n", "sig", "first"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(text_batches(run), "doc_id long, n long, sig binary, first binary")


def _met_elsewhere(described: DataFrame) -> DataFrame:
    """(half, met): by the first half of a signature, how many of its first shingles may occur in another class, if any.

    Where copies of a class lie in several batches, some shingles count more than once, which keeps a class too many.
    """
    total = described.agg(F.sum(F.length("first") / 8)).first()[0] or 0
    ranges = max(1, -(-int(total) // RANGE_TOKENS))

    def deal(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        by = {s[:8]: f for s, f in zip(batch.column("sig").to_pylist(), batch.column("first").to_pylist()) if s}
        if not by:
            return []
        sigs = np.frombuffer(b"".join(by), np.uint64)
        tokens, sizes = _joined(list(by.values()))
        owner = np.repeat(np.arange(len(sigs)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        begins = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] ^ np.uint64(1)))
        many = np.diff(np.append(begins, len(tokens))) > 1  # every class is here once
        settled = np.bincount(owner[np.repeat(many, np.diff(np.append(begins, len(tokens))))], minlength=len(sigs))
        # Of a shingle that several classes here share, one entry is enough, without an owner to be told.
        kept, told = tokens[begins], np.where(many, len(sigs), owner[begins])
        place = (kept >> np.uint64(32)).astype(np.int64) * ranges >> 32
        cuts = np.searchsorted(place, np.arange(ranges + 1))
        rows = []
        for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:  # a range is sent the signatures of its own entries, not those of the batch
                owners, local = np.unique(told[a:b], return_inverse=True)
                own = owners[owners < len(sigs)]
                rows.append((r, kept[a:b].tobytes(), local.astype("<u4").tobytes(), sigs[own].tobytes(), None))
        some = np.flatnonzero(settled)
        rows.append((-1 - int(sigs[0] % np.uint64(ranges)), b"", b"", sigs[some].tobytes(), settled[some].astype("<u4").tobytes()))
        types = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["range", "tokens", "told", "sigs", "settled"])]

    def meet(table: pa.Table) -> pa.Table:
        sigs = [np.frombuffer(s, np.uint64) for s in table.column("sigs").to_pylist()]
        if table.column("range")[0].as_py() < 0:
            counts = np.concatenate([np.frombuffer(s, "<u4") for s in table.column("settled").to_pylist()]).astype(np.int64)
            return pa.table({"half": np.concatenate(sigs).view(np.int64), "n": counts})
        tokens = np.concatenate([np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()])
        # Entries without an owner stand for several classes.
        own = [np.append(s, np.uint64(0))[np.frombuffer(t, "<u4")] for s, t in zip(sigs, table.column("told").to_pylist())]
        several = np.concatenate([np.frombuffer(t, "<u4") == len(s) for s, t in zip(sigs, table.column("told").to_pylist())])
        own = np.concatenate(own)
        order = np.lexsort((own, tokens))
        tokens, own, several = tokens[order], own[order], several[order]
        fresh = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (own[1:] != own[:-1]) | several[1:] | several[:-1]]) if len(tokens) else np.zeros(0, bool)
        tokens, own, several = tokens[fresh], own[fresh], several[fresh]
        begins = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] ^ np.uint64(1)))
        sizes = np.diff(np.append(begins, len(tokens)))
        shared = np.repeat((sizes > 1) | np.logical_or.reduceat(several, begins), sizes)
        halves, counts = np.unique(own[shared & ~several], return_counts=True)
        del tokens, own, several, order, fresh, shared
        give_back()
        return pa.table({"half": halves.view(np.int64), "n": counts})

    dealt = described.filter("sig is not null").select("sig", "first").mapInArrow(text_batches(deal), "range long, tokens binary, told binary, sigs binary, settled binary")
    counted = dealt.groupBy("range").applyInArrow(meet, "half long, n long")
    return counted.groupBy("half").agg(F.sum("n").alias("met"))


# Step 2 ---------------------------------------------------------------------------------------------------------------


def _named_by(halves: DataFrame, column: str) -> np.ndarray:
    """A bit for each value of `column`, 2 ** FILTER_LOG2 at most: a test that misses none and passes few others."""
    bits = int(np.clip(np.ceil(np.log2(16 * max(1, halves.count()))), 16, FILTER_LOG2))
    place = F.shiftrightunsigned(column, 64 - bits)
    words = halves.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros((1 << bits) // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _passes(table: np.ndarray, halves: np.ndarray) -> np.ndarray:
    place = halves >> np.uint64(65 - (len(table) * 64).bit_length())
    return (table[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _whole_sets(docs: DataFrame, text_col: str, alive: DataFrame) -> DataFrame:
    """(rid, sig, n, tokens) of each class that step 1 keeps, and of few others that its filter lets pass."""
    sent = docs.sparkSession.sparkContext.broadcast(_named_by(alive, "half"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = {_signature(s): s for s in shingle_sets(batch.column("text").to_pylist()) if len(s)}
        halves = np.frombuffer(b"".join(s[:8] for s in sets), np.uint64)
        kept = [item for item, passes in zip(sets.items(), _passes(sent.value, halves).tolist()) if passes]
        columns = [[s for s, _ in kept], [len(t) for _, t in kept], [t.tobytes() for _, t in kept]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.binary()))], names=["sig", "n", "tokens"])

    sets = docs.select(F.col(text_col).alias("text")).mapInArrow(text_batches(run), "sig binary, n long, tokens binary")
    classes = sets.groupBy("sig", "n").agg(F.first("tokens").alias("tokens"))
    return staged(classes.withColumn("rid", F.monotonically_increasing_id()))


@dataclass
class Counters:
    """Classes by shingle, counted in a power of two of places by hash: never too few for a shingle."""

    counts: np.ndarray
    costly: int

    def estimated(self, tokens: np.ndarray) -> np.ndarray:
        return self.counts[(tokens >> np.uint64(65 - len(self.counts).bit_length())).astype(np.int64)]


def _counters(classes: DataFrame, log2: int, costly: int) -> Counters:
    shift, places = np.uint64(64 - log2), 1 << log2

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, _ = _joined(batch.column("tokens").to_pylist())
        counts = np.bincount((tokens >> shift).astype(np.int64), minlength=places)
        at = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    found = classes.select("tokens").mapInArrow(text_batches(run), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(places, np.int64)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return Counters(out, costly)


def _prefixes(tokens: np.ndarray, sizes: np.ndarray, counters: Counters) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some sets in a row: all shingles rarest first, lengths of short and of lengthened prefixes, and the matches asked.

    A prefix whose shingles others are estimated to hold `costly` times is lengthened by a twentieth of the set, one with ten
    times as many by a tenth.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    estimated = counters.estimated(tokens)
    order = np.lexsort((tokens, estimated, owner))
    short = sizes - needed(sizes) + 1
    rank = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    cost = np.bincount(owner, weights=np.where(rank < np.repeat(short, sizes), estimated[order] - 1, 0), minlength=len(sizes))
    more = (sizes * np.where(cost > 10 * counters.costly, 0.1, np.where(cost > counters.costly, 0.05, 0.0))).astype(np.int64)
    return tokens[order], short, short + more, 1 + more


# Step 3 ---------------------------------------------------------------------------------------------------------------


def _postings(classes: DataFrame, counters) -> DataFrame:
    """(token, rid, n, rank) of short prefixes; ranks count from 0 in the order of the prefix."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, sizes = _joined(batch.column("tokens").to_pylist())
        tokens, short, _, _ = _prefixes(tokens, sizes, counters.value)
        rank = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        inside = rank < np.repeat(short, sizes)
        rid = np.repeat(batch.column("rid").to_numpy(), sizes)[inside]
        return pa.RecordBatch.from_arrays([pa.array(tokens[inside].view(np.int64)), pa.array(rid), pa.array(np.repeat(sizes, sizes)[inside]), pa.array(rank[inside])], names=["token", "rid", "n", "rank"])

    return classes.select("rid", "tokens").mapInArrow(text_batches(run), "token long, rid long, n long, rank long")


class _Group:
    """Sets that are compared with each other."""

    def __init__(self, blobs: list[bytes], counters: Counters) -> None:
        tokens, self.n = _joined(blobs)
        ordered, _, long, self.more = _prefixes(tokens, self.n, counters)
        distinct, self.flat = np.unique(ordered, return_inverse=True)
        self.starts, self.long = np.cumsum(self.n) - self.n, long
        self.marked = np.zeros(len(distinct), bool)

    def _overlaps(self, x: int, ys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Shingles that x has in common with each y, among their first `lengths`."""
        mine = self.flat[self.starts[x] : self.starts[x] + lengths[x]]
        self.marked[mine] = True
        sizes = lengths[ys]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ys] - (ends - sizes), sizes) + np.arange(ends[-1])
        run = np.concatenate([[0], np.cumsum(self.marked[self.flat[at]])])
        self.marked[mine] = False
        return run[ends] - run[ends - sizes]

    def links(self, x: int, ys: np.ndarray) -> np.ndarray:
        n = self.n[ys]
        ys = ys[(100 * n >= PERCENT * self.n[x]) & (100 * self.n[x] >= PERCENT * n)]
        if len(ys):
            ys = ys[self._overlaps(x, ys, self.long) >= np.minimum(self.more[x], self.more[ys])]
        if len(ys):
            both = self._overlaps(x, ys, self.n)
            ys = ys[100 * both >= PERCENT * (self.n[x] + self.n[ys] - both)]
        return ys

    def stars(self) -> list[tuple[int, int]]:
        """For each connected part, its other members with the first; a member is compared with all not yet connected."""
        out, left = [], np.arange(len(self.n))
        while len(left) > 1:
            root, left = int(left[0]), left[1:]
            waiting = [root]
            while waiting and len(left):
                found = self.links(waiting.pop(), left)
                if len(found):
                    out += [(root, y) for y in found.tolist()]
                    waiting += found.tolist()
                    left = np.setdiff1d(left, found, assume_unique=True)
        return out


def _edges(pairs: list[tuple[int, int]], rids: np.ndarray) -> pa.Table:
    at = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table({"a": rids[at[:, 0]], "b": rids[at[:, 1]]})


def _meetings(shared: DataFrame) -> DataFrame:
    """(rid, token, chunk): up to ROUNDS groups of each class, by its prefix shingles in the most others."""
    keys = shared.groupBy("rid", "n").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("df")).alias("df"), "token"))), 1, ROUNDS).alias("first"))  # a class's own prefix
    keys = keys.select("rid", "n", F.explode("first.token").alias("token"))
    sizes = keys.groupBy("token").agg(F.count("*").alias("m"), F.sum("n").alias("tokens")).filter("m > 1")
    chunks = F.ceil(F.greatest(F.col("m") / CHUNK_CLASSES, F.col("tokens") / CHUNK_TOKENS))
    return keys.join(sizes, "token").select("rid", "token", F.pmod(F.xxhash64("rid", "token"), chunks).alias("chunk"))


def _met_in_groups(classes: DataFrame, meetings: DataFrame, counters) -> DataFrame:
    def connect(table: pa.Table) -> pa.Table:
        table = table.sort_by("rid")
        edges = _edges(_Group(table.column("tokens").to_pylist(), counters.value).stars(), table.column("rid").to_numpy())
        give_back()
        return edges

    # Rows of three numbers: so few are broadcast, so that the sets are exchanged once and not twice.
    small = meetings.count() <= BROADCAST_MEETINGS
    return classes.select("rid", "tokens").join(F.broadcast(meetings) if small else meetings, "rid").groupBy("token", "chunk").applyInArrow(connect, "a long, b long")


def _not_met(shared: DataFrame, meetings: DataFrame, parts: DataFrame) -> DataFrame:
    """(a, b): classes of different parts that share a prefix shingle, may link by size and have been in no common group."""
    groups = meetings.groupBy("rid").agg(F.collect_list(F.xxhash64("token", "chunk")).alias("groups"))  # up to ROUNDS
    rows = shared.join(parts.withColumnRenamed("node", "rid"), "rid", "left").join(groups, "rid", "left")
    rows = staged(rows.select("token", "rid", "n", "rank", F.coalesce("part", "rid").alias("part"), F.coalesce("groups", F.array().cast("array<bigint>")).alias("groups")))
    # Of a shingle's largest part, only pairs with other parts matter; a shingle of a single part needs nothing.
    by_part = rows.groupBy("token", "part").agg(F.count("*").alias("m"))
    largest = by_part.groupBy("token").agg(F.max_by("part", F.struct("m", "part")).alias("largest"), F.count("*").alias("parts")).filter("parts > 1").select("token", "largest")
    open_rows = staged(rows.join(largest, "token"))
    # Nothing before its first common shingle is shared, so the shorter rest bounds the overlap that a link needs.
    most = F.least(F.col("x.n") - F.col("x.rank"), F.col("y.n") - F.col("y.rank"))
    x, y = open_rows.filter("part != largest").alias("x"), open_rows.alias("y")
    may = (
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.part") != F.col("y.part"))
        & ((F.col("y.part") == F.col("y.largest")) | (F.col("x.rid") < F.col("y.rid")))
        & (100 * F.col("x.n") >= PERCENT * F.col("y.n"))
        & (100 * F.col("y.n") >= PERCENT * F.col("x.n"))
        & ((100 + PERCENT) * most >= PERCENT * (F.col("x.n") + F.col("y.n")))
        & ~F.arrays_overlap("x.groups", "y.groups")
    )
    return x.join(y, may).select(F.least("x.rid", "y.rid").alias("a"), F.greatest("x.rid", "y.rid").alias("b")).distinct()


def _verified(classes: DataFrame, pairs: DataFrame, counters) -> DataFrame:
    sets = classes.select("rid", "tokens")
    rows = pairs.join(sets.toDF("a", "mine"), "a").join(sets.toDF("b", "other"), "b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for mine, other in zip(batch.column("mine").to_pylist(), batch.column("other").to_pylist()):
            keep.append(len(_Group([mine, other], counters.value).links(0, np.array([1]))) > 0)
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("a", "b", "mine", "other").mapInArrow(text_batches(run), "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, part): the smallest node that each node of an edge is connected with.

    Smallest labels are passed on over edges and then over labels of labels, so few rounds do. Each round is a table.
    """
    both = staged(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("part")))
    while True:
        seen = both.join(labels.toDF("b", "near"), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(seen, "node").select("node", "part", F.least("part", "near").alias("low"))
        after = lower.join(labels.toDF("low", "jump"), "low").select("node", F.least("low", "jump").alias("part"), (F.least("low", "jump") != F.col("part")).alias("changed"))
        after = staged(after)
        labels = after.select("node", "part")
        if after.filter("changed").isEmpty():
            return labels


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the size of its set, and the smallest id reachable by links.

    A null text and one without words have no shingle and are their own component. Rows with equal sets are linked, also
    such that repeat an id. A null id is larger than any other; a component of null ids alone has a null component_id.
    Further columns don't matter; a table without rows gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    described = staged(_described(docs, id_col, text_col))
    half = F.col("half")
    halves = described.filter("sig is not null").select(_half(F.col("sig")).alias("half"), "n").distinct()
    alive = staged(halves.join(_met_elsewhere(described), "half").filter(F.col("met") > F.floor(F.col("n") * LENGTHENED)).select(half).distinct())
    classes = _whole_sets(docs, text_col, alive)
    counters = spark.sparkContext.broadcast(_counters(classes, COUNTERS_LOG2, COSTLY))
    postings = staged(_postings(classes, counters))
    held = staged(postings.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"))
    shared = staged(join_counted(postings, held, "token", "df").filter("df is not null"))
    meetings = staged(_meetings(shared))
    edges = staged(_met_in_groups(classes, meetings, counters))
    discard(alive, postings, held)
    # Staged, so that few pairs are seen to be few and the sets need no exchange for them.
    pairs = staged(_not_met(shared, meetings, connected(edges)))
    more = staged(_verified(classes, pairs, counters))
    discard(shared, meetings, pairs)
    parts = connected(edges.union(more))
    # A row for each class of several rows or links, with its smallest id and its rows.
    own = described.filter("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("low"), F.count("*").alias("m"))
    named = classes.select("rid", "sig").join(parts.withColumnRenamed("node", "rid"), "rid").select("sig", "part")
    known = staged(own.join(named, "sig", "left").filter("m > 1 or part is not null"))
    # As many rows as classes that link with others; one part may hold many of them, but not more than different texts.
    linked = known.filter("part is not null")
    lows = linked.groupBy("part").agg(F.min("low").alias("least"), F.count("*").alias("classes"))
    table = join_counted(linked, lows, "part", "classes").select("sig", "m", F.col("least").alias("low")).unionByName(known.filter("part is null").select("sig", "m", "low"))
    table = staged(table.withColumn("repeated", F.lit(True)))
    rows = join_counted(described.select("doc_id", "n", "sig"), table, "sig", "m")
    discard(classes, edges, more, known)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("repeated"), F.col("low")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, columns as they are, without those that a row with a smaller id stands for.

    Of each component the row with the smallest id stays. Where ids repeat or are null, rows are numbered and the smallest
    number stays. Null texts and texts without words stay; a table without rows gives none; texts are compared whole, and
    columns may have any names.
    """
    # The row travels as one struct, so that its columns' names don't matter.
    rows = docs.select(F.col(id_col).cast("long").alias("uid"), F.col(text_col).alias("text"), F.struct("*").alias("row"))
    if not rows.groupBy("uid").count().filter("count > 1 or uid is null").isEmpty():
        rows = staged(rows.withColumn("uid", F.monotonically_increasing_id()))
    found = components(rows, "uid", "text").filter("doc_id != component_id").select("doc_id")
    dropped = staged(found.withColumn("half", F.xxhash64("doc_id")))
    named = docs.sparkSession.sparkContext.broadcast(_named_by(dropped, "half"))
    # Most rows stay, and the filter tells so without an exchange of texts; those that it names are looked up.
    whole = rows.select(F.xxhash64("uid").alias("half"), "uid", "row")

    def part(wanted: bool):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array(_passes(named.value, batch.column(0).to_numpy().view(np.uint64)) == wanted))

        return whole.mapInArrow(text_batches(run), whole.schema)

    looked_up = part(True).join(dropped.select("doc_id"), F.col("uid") == F.col("doc_id"), "left_anti")
    return part(False).select("row.*").union(looked_up.select("row.*"))


def _half(sig: Column) -> Column:
    """The first 8 bytes of a signature as a number, in the byte order of numpy."""
    parts = [F.conv(F.hex(F.substring(sig, 8 - i, 1)), 16, 10).cast("long") for i in range(8)]
    return reduce(lambda high, low: F.shiftleft(high, 8).bitwiseOR(low), parts)
