"""Language identification by interpolated Kneser-Ney models of characters, one for each language.

A text counts as its runs of letters, lower case, each between blanks. A model of order 5 gives the probability of each
letter after the four before it; it is stored as sorted arrays of 64-bit n-gram hashes with log probabilities and back-off
weights. The language whose cross-entropy per symbol is lowest wins; a text whose lowest cross-entropy is far above that of
texts of the language is rejected.

The models are fitted on a sample of labelled texts of bounded size (`SAMPLE_CHARS` characters a language), so they are
small enough for every task: at most some 16 bytes for each sampled symbol and order, in practice a tenth.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import kept_by_worker, ship, text_batches, unit_hash
from tripweave.llm.words import Grown, WordTable, groups_of, sums

ORDER = 5
#: Characters of the sample, for each language and for all together.
SAMPLE_CHARS, SAMPLE_CHARS_ALL = 3_000_000, 60_000_000
#: This share of the sample calibrates the rejection, by models of the rest; the final models count all of the sample.
CALIBRATION = 0.25
#: A text is rejected beyond so many standard deviations above the mean cross-entropy of its language.
REJECT_BEYOND = 8.0
#: Symbols that unseen letters share the left-over probability with.
SYMBOLS = 4096
#: Confidence: softmax of the cross-entropies times this.
SHARPNESS = 8.0
UNKNOWN = "und"
#: Limits of a language that could not be calibrated.
REJECTS_NOTHING = (float("inf"), 0.04, 1.0)
LETTERS = re.compile(r"[^\W\d_]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def letter_runs(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each after ORDER - 1 blanks and before one; and the word that each symbol belongs to."""
    lead, lengths = " " * (ORDER - 1), np.array([len(w) + ORDER for w in words], np.int64)
    joined = "".join(f"{lead}{w} " for w in words)
    return np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64), np.repeat(np.arange(len(words)), lengths)


def _gram_hashes(symbols: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams of order 1 to ORDER that end at each symbol."""
    with np.errstate(over="ignore"):
        out = [symbols + np.uint64(1)]
        for _ in range(1, ORDER):
            longer = symbols + np.uint64(1)
            longer[1:] += out[-1][:-1] * MULTIPLIER
            out.append(longer)
        return out


def _places(words: list[str], symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Where real symbols stand: letters and the closing blank."""
    starts = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1]) if len(owner) else np.zeros(0, np.int64)
    real = np.ones(len(symbols), bool)
    for i in range(ORDER - 1):
        real[starts + i] = False
    return np.flatnonzero(real)


@dataclass
class KneserNey:
    """Sorted hashes by order: n-grams with log probabilities, contexts (from order 2 on) with back-off weights."""

    hashes: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    unseen: float

    @classmethod
    def fit(cls, grams: list[str], counts: np.ndarray) -> "KneserNey":
        """From distinct n-grams of full order and their counts. Lower orders count the different symbols before."""
        points = np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(len(grams), ORDER)
        lower: tuple[np.ndarray, np.ndarray] | None = None
        tables: list[tuple] = []
        levels = []
        rows, weight = points, counts.astype(np.float64)
        for order in range(ORDER, 0, -1):
            levels.append((order, rows, weight))
            if order > 1:
                shorter, inverse = np.unique(rows[:, 1:], axis=0, return_inverse=True)
                rows, weight = shorter, np.bincount(inverse.ravel(), minlength=len(shorter)).astype(np.float64)
        for order, rows, weight in reversed(levels):
            key = _hash_rows(rows)
            once, twice = (weight == 1).sum(), (weight == 2).sum()
            discount = min(max(once / (once + 2 * twice), 0.1), 0.95) if once and twice else 0.5
            context, inverse = np.unique(_hash_rows(rows[:, :-1]), return_inverse=True)
            total, kinds = np.bincount(inverse, weights=weight), np.bincount(inverse)
            left = discount * kinds / total
            below = np.full(len(rows), 1 / SYMBOLS) if lower is None else _find(lower[0], lower[1], _hash_rows(rows[:, 1:]), np.nan)
            p = (weight - discount) / total[inverse] + left[inverse] * below
            at = np.argsort(key)
            lower = (key[at], p[at])
            tables.append((key[at], p[at], context, left))
        unseen = float(np.log(tables[0][3][0] / SYMBOLS))
        contexts, backoff = [t[2] for t in tables[1:]], [np.log(t[3]).astype(np.float32) for t in tables[1:]]
        return cls([t[0] for t in tables], [np.log(t[1]).astype(np.float32) for t in tables], contexts, backoff, unseen)

    def score(self, hashes: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
        """Log probability of symbols; hashes[k] and before[k] are of the k + 1 symbols that end at it and just before it."""
        out = np.full(len(hashes[0]), self.unseen)
        for order in range(1, ORDER + 1):
            at, hit = _at(self.hashes[order - 1], hashes[order - 1])
            if order > 1:
                near, known = _at(self.contexts[order - 2], before[order - 2])
                out += np.where(known, self.backoff[order - 2][near], 0.0)
            out[hit] = self.logp[order - 1][at[hit]]
        return out


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(rows.shape[1]):
            out = out * MULTIPLIER + rows[:, i] + np.uint64(1)
    return out


def _at(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _find(table: np.ndarray, values: np.ndarray, keys: np.ndarray, other: float) -> np.ndarray:
    at, hit = _at(table, keys)
    return np.where(hit, values[at], other)


class _Scores(WordTable):
    """Log probabilities of words in each language, and their number of symbols (0 for a run without a letter)."""

    def __init__(self, models: list[KneserNey]) -> None:
        self.models = models
        super().__init__(most=max(50_000, 800_000 // max(1, len(models))))

    def clear(self) -> None:
        super().clear()
        self.figures = Grown(len(self.models) + 1, "f4")

    def learn(self, words: list[str]) -> None:
        symbols, owner = _symbols(words)
        hashes, at = _gram_hashes(symbols), _places(words, symbols, owner)
        _, first, inverse = np.unique(hashes[-1][at], return_index=True, return_inverse=True)
        ends = at[first]
        mine, before = [h[ends] for h in hashes], [h[ends - 1] for h in hashes]
        figures = np.zeros((len(words), len(self.models) + 1))
        for k, model in enumerate(self.models):
            figures[:, k] = np.bincount(owner[at], weights=model.score(mine, before)[inverse], minlength=len(words))
        figures[:, -1] = [(len(w) + 1) * any(map(str.isalpha, w)) for w in words]
        self.figures.add(figures.astype("f4"))

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats a symbol of each text in each language, and symbols."""
        out = []
        for part in groups_of(texts):
            numbers, borders = self.numbers([letter_runs(t) for t in texts[part]])
            figures = self.figures.rows[numbers]
            figures[figures[:, -1] == 0] = 0
            out.append(sums(figures, borders))
        all_sums = np.concatenate(out) if out else np.zeros((0, len(self.models) + 1))
        n = all_sums[:, -1]
        return -all_sums[:, :-1] / np.maximum(n, 1)[:, None], n


@dataclass
class LanguageModels:
    """What tasks need: names, models and, by language, mean and two parts of the variance of cross-entropies."""

    token: str
    languages: list[str]
    models: list[KneserNey]
    limits: np.ndarray

    def scores(self) -> _Scores:
        return kept_by_worker(("language", self.token), lambda: _Scores(self.models))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, confidence and acceptance."""
        entropy, n = self.scores().cross_entropies(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(best)), best]
        confidence = np.where(n > 0, 1 / np.exp(-SHARPNESS * (entropy - lowest[:, None])).sum(axis=1), 0.0)
        mean, base, by_length = self.limits[best].T
        accepted = (n > 0) & (lowest <= mean + REJECT_BEYOND * np.sqrt(base + by_length / np.maximum(n, 1)))
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, n)], confidence, accepted


def held_out(id_col: str, parts: int, part: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == part


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_chars: int = SAMPLE_CHARS) -> LanguageModels:
    """Models of the languages that rows of `docs` with `train` and a language name.

    Two passes read the sample: one counts, one calibrates. What is collected is bounded by the sample's characters. Every
    language with a letter in its sample has a model; one without calibrating texts rejects nothing. Texts that are null
    don't count, texts of one id count as often as they stand; without labelled rows there is no language.
    """
    ship(docs.sparkSession)
    labelled = docs.filter(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = labelled.groupBy("lang").agg(F.sum(F.char_length("text")).alias("chars"))
    n_langs = max(1, sizes.count())
    bound = min(sample_chars, SAMPLE_CHARS_ALL // n_langs)
    share = F.least(F.lit(1.0), F.lit(float(bound)) / F.greatest("chars", F.lit(1)))
    draw = unit_hash(F.lit("language"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    sample = labelled.join(F.broadcast(sizes), "lang").withColumn("draw", draw / share).filter("draw < 1")
    sample = sample.withColumn("apart", F.col("draw") < CALIBRATION)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        for lang, text, apart in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "apart"))):
            for word, n in Counter(letter_runs(text)).items():
                padded = " " * (ORDER - 1) + word + " "
                for i in range(len(word) + 1):
                    found[lang, padded[i : i + ORDER], apart] += n
        langs, grams, parts = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(grams, pa.string()), pa.array(parts, pa.bool_()), pa.array(found.values(), pa.int64())], names=["lang", "gram", "apart", "n"])

    counted = sample.select("lang", "text", "apart").mapInArrow(text_batches(count), "lang string, gram string, apart boolean, n long")
    grams = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("apart"), 0).otherwise(F.col("n"))).alias("rest"))

    def model(table: pa.Table) -> pa.Table:
        fitted = []
        for column in ("n", "rest"):
            some = table.filter(pc.greater(table.column(column), 0)).sort_by("gram")
            fitted.append(pickle.dumps(KneserNey.fit(some.column("gram").to_pylist(), some.column(column).to_numpy())) if some.num_rows else None)
        return pa.table({"lang": table.column("lang").slice(0, 1), "whole": pa.array(fitted[:1], pa.binary()), "partial": pa.array(fitted[1:], pa.binary())})

    rows = sorted(grams.groupBy("lang").applyInArrow(model, "lang string, whole binary, partial binary").collect())
    partial = LanguageModels(uuid.uuid4().hex, [r.lang for r in rows if r.partial], [pickle.loads(r.partial) for r in rows if r.partial], np.zeros((0, 3)))
    limits = _calibrated(sample.filter("apart"), partial)
    models = LanguageModels(uuid.uuid4().hex, [r.lang for r in rows], [pickle.loads(r.whole) for r in rows], np.zeros((len(rows), 3)))
    models.limits = np.array([limits.get(r.lang, REJECTS_NOTHING) for r in rows]).reshape(-1, 3)
    return models


def _calibrated(calibrating: DataFrame, models: LanguageModels) -> dict[str, tuple[float, float, float]]:
    """Mean cross-entropy by language, and its variance as a constant and a part that falls with the symbols.

    A language without such texts, as one of very few texts may be, is missing.
    """
    sent = calibrating.sparkSession.sparkContext.broadcast(models)

    def own(batch: pa.RecordBatch) -> pa.RecordBatch:
        entropy, n = sent.value.scores().cross_entropies(batch.column("text").to_pylist())
        place = {lang: i for i, lang in enumerate(sent.value.languages)}
        at = np.array([place.get(lang, -1) for lang in batch.column("lang").to_pylist()])
        keep = (n > 0) & (at >= 0)
        return pa.RecordBatch.from_arrays([batch.column("lang").filter(pa.array(keep)), pa.array(entropy[keep, at[keep]]), pa.array(n[keep])], names=["lang", "h", "n"])

    found = calibrating.select("lang", "text").mapInArrow(text_batches(own), "lang string, h double, n double")
    rows = found.groupBy("lang").agg(F.sum(F.col("h") * F.col("n")).alias("hn"), F.sum("n").alias("n"), F.sum(F.col("h") * F.col("h") * F.col("n")).alias("hhn"), F.count("*").alias("docs")).collect()
    out = {}
    for r in rows:
        mean = r.hn / r.n
        between = max(r.hhn / r.n - mean * mean, 0.0) if r.docs > 1 else 0.0
        # Between texts, a deviation of 0.2 nats at least; within a text, about one nat squared a symbol.
        out[r.lang] = (mean, max(between, 0.04), 1.0)
    return out


def identify(docs: DataFrame, models: LanguageModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every whole text.

    A null text and one without a letter are `und`, with score 0, and not accepted. Languages, ids and sources of rows
    play no part. Rows that repeat an id are judged one by one; further columns don't matter.
    """
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, confidence, accepted = sent.value.predict(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(confidence), pa.array(accepted)], names=["doc_id", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(text_batches(run), "doc_id long, lang_pred string, score double, accepted boolean")


def accepted_rows(docs: DataFrame, models: LanguageModels, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, columns as they are, whose text is accepted as some language.

    Null texts and those without a letter are not accepted. Rows are judged one by one, also such that repeat an id or have
    none; the names of other columns don't matter; a table without rows gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(models)
    at = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(sent.value.predict(batch.column(at).to_pylist())[2]))

    return docs.mapInArrow(text_batches(run), docs.schema)
