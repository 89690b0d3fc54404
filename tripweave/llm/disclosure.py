"""Personal data in texts: fixed patterns, and words that give a protected value away.

Protected entities are the values that the patterns find. How strongly a word reveals one is estimated from the corpus: of the
texts that hold the word, the share that hold the entity too, anywhere in the text. The share is the chance to name the entity
for someone who knows the word, and minus its binary logarithm the information that the entity has left. What counts is the
lower end of Wilson's interval for it, so that few texts prove little: a word is generalised if at most one bit is left for some
entity (one text of one; eleven of thirteen), and removed if at most a third of a bit is (four of four). The rule depends on
the texts with the word alone, not on the size of the corpus: further texts without it change nothing. Exact copies of a
text are one observation. Words are marked at every place in every text.

Texts are read three times. The first pass takes the entities and distinct words of texts that hold entities. Entities with the
same texts are one (a list of ten thousand addresses is one entity), and a word's texts among these alone bound its share from
above. The second pass bounds the number of texts of the words that are left, each batch by itself first; for a word of a single
text the bound is exact. The third takes the places of the few words that may still reach the threshold, and from these come
their exact counts. What workers get to tell such words is a filter of FILTER_BITS for each of them, 2 ** FILTER_LOG2 bits at
most; what it lets through besides is dropped by the joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import blank, discard, give_back, join_counted, kept_by_worker, ship, staged, text_batches
from tripweave.llm.words import Grown, WordTable, groups_of

KINDS = ("email", "ip", "card", "phone")
#: Disclosure from which a word is generalised, and from which it is removed.
GENERALISE, REMOVE = 0.5, 0.8
#: Least bits of the filter for each word in it, the bits that a word sets, and the most bits of all.
FILTER_BITS, FILTER_PROBES, FILTER_LOG2 = 16, 4, 30
AFTER_AT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A number begins where no digit stands before: a match from within one would have begun earlier.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile("[0-9]")
WORD = re.compile(r"[^\W\d_]{3,}")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    doubled = (int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches without overlap, in one pass: a match begins where the run of local characters before an @ begins."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = AFTER_AT.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind and start; matches that fail a check are dropped."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGITS.search(text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p[-19:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = re.sub("[ -]", "", m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGITS.findall(m.group())) <= 15]
    return out


def outside(text: str, spans: list[Span]) -> str:
    """The text with spans blanked; places stay the same."""
    if not spans:
        return text
    out, at = [], 0
    for a, b in sorted((a, b) for _, a, b in spans):
        if b > at:
            out += [text[at : max(a, at)], " " * (b - max(a, at))]
            at = b
    return "".join([*out, text[at:]])


def entity(kind: int, value: str) -> str:
    """The value itself, however it is written."""
    return f"{KINDS[kind]}:{value.lower() if kind < 2 else ''.join(DIGITS.findall(value))}"


class _Words(WordTable):
    """By word the number of its lower-case form, and by that number the hash."""

    def __init__(self) -> None:
        super().__init__(most=400_000)

    def clear(self) -> None:
        super().clear()
        self.lower: dict[str, int] = {}
        self.number, self.hashes = Grown(1, "i8"), Grown(1, "i8")

    def learn(self, words: list[str]) -> None:
        numbers, fresh = [], []
        for w in words:
            low = w.lower()
            n = self.lower.setdefault(low, len(self.lower))
            numbers.append(n)
            if n == self.hashes.n + len(fresh):
                fresh.append(term_hash(low))
        self.number.add(np.array(numbers, np.int64)[:, None])
        self.hashes.add(np.array(fresh, np.int64).reshape(-1, 1))

    def terms(self, words: list[str]) -> np.ndarray:
        """Hashes of the lower-case forms."""
        numbers, _ = self.numbers([words])  # may replace the arrays
        return self.hashes.rows[self.number.rows[numbers, 0], 0]


def term_hash(word: str) -> int:
    n = xxhash.xxh64_intdigest(word.encode())
    return n - (n >> 63 << 64)


def _bits(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """Places in a filter of `size` bits, a power of two."""
    h = hashes.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64) for k in range(FILTER_PROBES)]


def _filter(terms: DataFrame) -> np.ndarray:
    """Filter of the distinct hashes in `terms`, as bytes of eight bits."""
    size = 1 << min(max(10, (FILTER_BITS * terms.count() - 1).bit_length()), FILTER_LOG2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(np.concatenate(_bits(batch.column(0).to_numpy(), size)))
            at, first = np.unique(bits >> 3, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.bitwise_or.reduceat(1 << (bits & 7), first) if len(first) else at)], names=["at", "byte"])

    out = np.zeros(size >> 3, np.uint8)
    for batch in terms.mapInArrow(run, "at long, byte long").toArrow().to_batches():
        np.bitwise_or.at(out, batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint8))
    return out


HELD = "part string, text long, entity string, term long"
FOUND = "part string, uid long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, spans string, text long, term long, first array<long>, last array<long>"
TYPES = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}


def _rows(ddl: str, columns: dict, size: int) -> pa.RecordBatch:
    """A batch of these columns, the others null."""
    schema = pa.schema([(name, TYPES[kind]) for name, kind in map(str.split, ddl.split(", "))])
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)


def _words() -> _Words:
    return kept_by_worker("disclosure", _Words)


def _held(texts: DataFrame) -> DataFrame:
    """Rows of three parts: `text` (each text), and of texts with entities `entity` and `term` (each once for a text)."""

    def run(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        texts, hashes = batch.column("text").to_pylist(), batch.column("hash").to_pylist()
        out = [_rows(HELD, {"part": ["text"] * len(texts), "text": hashes}, len(texts))]
        for text, key in zip(texts, hashes):
            spans = base_spans(text)
            if spans:
                entities = sorted({entity(k, text[a:b]) for k, a, b in spans})
                terms = np.unique(_words().terms(WORD.findall(outside(text, spans))))
                out += [_rows(HELD, {"part": ["entity"] * len(entities), "text": [key] * len(entities), "entity": entities}, len(entities))]
                out += [_rows(HELD, {"part": ["term"] * len(terms), "text": [key] * len(terms), "term": terms}, len(terms))]
        return out

    return texts.select("text", "hash").mapInArrow(text_batches(run), HELD)


def _held_by(bits: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Whether the filter holds these hashes."""
    if not len(own):
        return np.zeros(0, bool)
    return np.logical_and.reduce([bits[p >> 3] >> (p & 7) & 1 for p in _bits(own, 8 * len(bits))]).astype(bool)


def _bounded(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """(term, least): of words that the filter holds, a number of different texts that is not above the word's own.

    Two if texts of two kinds hold it at all, or as many as one batch has.
    """
    sent = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        texts, hashes, out = batch.column("text").to_pylist(), batch.column("hash").to_numpy(), []
        for part in groups_of(texts):
            lists = [WORD.findall(outside(t, base_spans(t))) for t in texts[part]]
            terms = _words().terms([w for words in lists for w in words])
            own, at = np.unique(terms, return_inverse=True)
            wanted = _held_by(sent.value, own)[at]
            text = np.repeat(hashes[part], [len(words) for words in lists])[wanted]
            term = terms[wanted]
            order = np.lexsort((text, term))
            term, text = term[order], text[order]
            if len(term):
                begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
                fresh = np.concatenate([[True], (term[1:] != term[:-1]) | (text[1:] != text[:-1])])
                last = np.append(begins[1:], len(term)) - 1
                columns = [term[begins], text[begins], text[last], np.add.reduceat(fresh.astype(np.int64), begins)]
                out.append(pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["term", "low", "high", "some"]))
        return out

    found = texts.select("text", "hash").mapInArrow(text_batches(run), "term long, low long, high long, some long")
    least = F.greatest(F.max("some"), F.when(F.min("low") < F.max("high"), 2).otherwise(1))
    return found.groupBy("term").agg(least.alias("least"))


def _found(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """Rows of two parts: `text` (base spans) and `place` (by text and word all places, of words that the filter holds)."""
    sent = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        uid = (context.partitionId() if context else 0) << 40
        bits = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column("text").to_pylist()
            found = [base_spans(t) for t in texts]
            counts = [[sum(s[0] == k for s in spans) for spans in found] for k in range(4)]
            written = [",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans) for spans in found]
            size = len(texts)
            yield _rows(FOUND, {"part": ["text"] * size, "uid": range(uid, uid + size), "doc_id": batch.column("doc_id"), "spans": written} | {f"n_{k}": c for k, c in zip(KINDS, counts)}, size)
            hashes = batch.column("hash").to_pylist()
            for part in groups_of(texts):
                clear = [outside(t, s) for t, s in zip(texts[part], found[part])]
                lists = [WORD.findall(t) for t in clear]
                terms = _words().terms([w for words in lists for w in words])
                own, at = np.unique(terms, return_inverse=True)
                wanted = _held_by(bits, own)[at]
                out: dict[str, list] = {c: [] for c in ("part", "uid", "text", "term", "first", "last")}
                start = 0
                for i, (text, words) in enumerate(zip(clear, lists), part.start):
                    some = np.flatnonzero(wanted[start : start + len(words)])
                    if len(some):
                        borders = [m.span() for m in WORD.finditer(text)]
                        by: dict[int, list[tuple[int, int]]] = {}
                        for j, term in zip(some.tolist(), terms[start + some].tolist()):
                            by.setdefault(term, []).append(borders[j])
                        for term, spans in by.items():
                            for column, value in zip(out.values(), ("place", uid + i, hashes[i], term, [a for a, _ in spans], [b for _, b in spans])):
                                column.append(value)
                    start += len(words)
                yield _rows(FOUND, out, len(out["part"]))
            uid += size
            give_back()

    return texts.mapInArrow(run, FOUND)


def lower_share(both: Column, texts: Column) -> Column:
    """The lower end of Wilson's interval of one standard error for `both` of so many texts."""
    return (2 * both + 1 - F.sqrt(1 + 4.0 * both * (texts - both) / texts)) / (2.0 * (texts + 1))


def candidates(held: DataFrame, threshold: float) -> DataFrame:
    """(entity, term, of_both) of pairs that reach the threshold where no text without entities has the term."""
    entities = held.filter("part = 'entity'").select("text", "entity").distinct()
    # Entities that the same texts hold are one: told by number, sum and parity of two hashes of the texts.
    far = F.xxhash64("text")
    whole = entities.groupBy("entity").agg(F.count("*").alias("n"), F.sum(F.shiftright("text", 8)).alias("sum"), F.expr("bit_xor(text)").alias("xor"), F.sum(F.shiftright(far, 8)).alias("far"))
    names = whole.select("entity", F.sha2(F.concat_ws(":", "n", "sum", "xor", "far"), 256).alias("same"))
    entities = entities.join(names, "entity").select("text", F.col("same").alias("entity")).distinct()
    terms = held.filter("part = 'term'").select("text", "term").distinct()
    both = entities.join(terms, "text").groupBy("entity", "term").agg(F.count("*").alias("of_both"))
    least = terms.groupBy("term").agg(F.count("*").alias("least"))
    return both.join(least, "term").filter(lower_share(F.col("of_both"), F.col("least")) >= threshold).select("entity", "term", "of_both")


def disclosing(pairs: DataFrame, places: DataFrame) -> DataFrame:
    """(term, disclosure, n_places) of the candidates, by the different texts that hold the term; the most for any entity."""
    of_term = places.groupBy("term", "text").agg(F.count("*").alias("n")).groupBy("term").agg(F.count("*").alias("of_term"), F.sum("n").alias("n_places"))
    disclosure = F.max(lower_share(F.col("of_both"), F.col("of_term"))).alias("disclosure")
    return pairs.join(of_term, "term").groupBy("term", "n_places").agg(disclosure)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Spans of every whole text, one row for each row of `docs`:

    doc_id, n_email, n_ip, n_card, n_phone, base_spans, base_sha256, spans, n_generalise, n_remove. Spans are
    kind:start:end in code points, end exclusive, comma-joined by kind (base kinds, then generalise and remove) and start.
    A null text counts as empty and has no spans. Rows that repeat an id are looked through one by one; further columns
    don't matter; a table without rows gives none.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), blank(F.col(text_col)).alias("text")).withColumn("hash", F.xxhash64("text"))
    held = staged(_held(texts), "part")
    wide = staged(candidates(held, generalise))
    discard(held)
    bounds = _bounded(texts, _filter(wide.select("term").distinct()))
    pairs = staged(wide.join(bounds, "term").filter(lower_share(F.col("of_both"), F.greatest("least", "of_both")) >= generalise).drop("least"))
    discard(wide)
    read = staged(_found(texts, _filter(pairs.select("term").distinct())), "part")
    base, places = (read.filter(F.col("part") == p) for p in ("text", "place"))
    terms = disclosing(pairs, places).filter(F.col("disclosure") >= generalise)
    terms = terms.select("term", "n_places", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise").alias("kind"))
    each = F.transform(F.arrays_zip("first", "last"), lambda p: F.struct(F.col("kind"), p["first"].alias("first"), p["last"].alias("last")))
    marked = join_counted(places.select("uid", "term", "first", "last"), terms, "term", "n_places").filter("kind is not null").select("uid", each.alias("some"))
    listed = marked.groupBy("uid").agg(F.sort_array(F.flatten(F.collect_list("some"))).alias("more"))  # within one text
    joined = base.join(listed, "uid", "left")
    more = F.array_join(F.transform(F.col("more"), lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")
    count = lambda kind: F.coalesce(F.size(F.filter("more", lambda s: s["kind"] == kind)), F.lit(0))
    return joined.select(
        "doc_id",
        *(f"n_{k}" for k in KINDS),
        F.col("spans").alias("base_spans"),
        F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(F.col("spans"), F.lit("")), more).alias("spans"),
        F.when(F.col("more").isNull(), 0).otherwise(count("generalise")).alias("n_generalise"),
        F.when(F.col("more").isNull(), 0).otherwise(count("remove")).alias("n_remove"),
    )


def sanitised(text: str | None, spans: str | None) -> str:
    """The text with base spans and generalised words replaced by their kind in brackets, and removed words left out.

    Where spans overlap, one replacement stands for their union, by the kind of the first.
    """
    text = text or ""
    cuts = sorted((int(a), int(b), kind) for kind, a, b in (s.split(":") for s in (spans or "").split(",") if s))
    out, at = [], 0
    for start, end, kind in cuts:
        if start >= at:
            out += [text[at:start], {"remove": "", "generalise": "[WORD]"}.get(kind, f"[{kind.upper()}]")]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(rows: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """`rows` with the text sanitised by the spans beside it (join `find` with its documents by id)."""
    from pyspark.sql.functions import pandas_udf

    clean = pandas_udf(lambda texts, spans: texts.combine(spans, sanitised), "string")
    return rows.withColumn(text_col, clean(F.col(text_col), F.col(spans_col)))
