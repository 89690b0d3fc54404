"""Quality rules on tokeniser fertility: how well public vocabularies fit a text.

Each word is encoded once per worker. By text: characters per token in each vocabulary, the share of tokens that are single
bytes the vocabulary has no piece for, and the entropy of the text's tokens as a part of the most it could be. A text is
rejected where a figure lies outside the band of its script. Bands are the median of all texts of the script that pass the
base rules, and so many median deviations to either side, but never less than a least width. Every script has its own
band, however few texts it has: one vocabulary fits scripts so differently that no other band would do.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import kept_by_worker, ship, single_threaded, staged, text_batches
from tripweave.llm.words import Grown, WordTable, groups_of, sums

SYMBOLS = "#*$%&|<>"
VISIBLE_BYTES = " \t\n\r\x0b\x0c"
#: Base rules.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Half the width of a band in median absolute deviations, and its least half width, for each figure.
DEVIATIONS = 8.0
FIGURES = {"chars_per_piece": 0.5, "chars_per_bpe": 0.5, "byte_share": 0.05, "entropy": 0.08}
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "script string, chars_per_piece double, chars_per_bpe double, byte_share double, entropy double"
)


@dataclass(frozen=True)
class Vocabularies:
    """Files of a sentence-piece model with byte fallback and of a byte-level BPE tokenizer."""

    pieces: str
    bpe: str


class _Words(WordTable):
    """By word: characters, symbols, letters, tokens of either vocabulary, byte tokens, script; and its piece ids."""

    CHARS, SYMBOLS_, LETTERS, PIECES, BPE, BYTES, SCRIPT = range(7)

    def __init__(self, files: Vocabularies) -> None:
        single_threaded()
        import sentencepiece
        from tokenizers import Tokenizer

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        self.bpe = Tokenizer.from_file(files.bpe)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.scripts: dict[str, int] = {"none": 0}
        self.script_of: dict[str, int] = {}
        super().__init__(most=500_000)

    def clear(self) -> None:
        super().clear()
        self.figures = Grown(7, "i4")
        self.ids, self.starts = Grown(1, "u2"), Grown(1, "i8")

    def script(self, letter: str) -> int:
        if letter not in self.script_of:
            name = unicodedata.name(letter, "UNKNOWN").split(" ")[0].lower()
            self.script_of[letter] = self.scripts.setdefault(name, len(self.scripts))
        return self.script_of[letter]

    def learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        pieces = self.pieces.encode(texts, num_threads=1)
        bpe = self.bpe.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        rows = np.zeros((len(words), 7), "i4")
        lengths = np.array([len(p) for p in pieces])
        ids = np.fromiter((i for p in pieces for i in p), np.int64, int(lengths.sum()))
        rows[:, self.PIECES] = lengths
        rows[:, self.BYTES] = np.bincount(np.repeat(np.arange(len(words)), lengths), weights=self.is_byte[ids], minlength=len(words))
        for i, t in enumerate(texts):
            letters = sum(map(str.isalpha, t))
            rows[i, self.CHARS], rows[i, self.SYMBOLS_], rows[i, self.LETTERS] = len(t), sum(map(t.count, SYMBOLS)), letters
            rows[i, self.BPE] = len(bpe[i].ids)
            if letters:
                rows[i, self.SCRIPT] = self.script(next(c for c in t if c.isalpha()))
        self.starts.add((np.cumsum(lengths) - lengths + self.ids.n)[:, None])
        self.ids.add(ids.astype("u2")[:, None])
        self.figures.add(rows)


def _table(files: Vocabularies) -> _Words:
    return kept_by_worker(files, lambda: _Words(files))


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(VISIBLE_BYTES)]
    return len(lines) - len(set(lines))


def repeated_words(numbers: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """By text: words that stand in a window of three words which the text has twice or more, first ones included."""
    n = len(numbers)
    if n < 3:
        return np.zeros(n_texts, np.int64)
    _, pair = np.unique(numbers[:-1] * (int(numbers.max()) + 1) + numbers[1:], return_inverse=True)
    window = pair[:-1].astype(np.int64) * (int(numbers.max()) + 1) + numbers[2:]
    whole = owner[:-2] == owner[2:]
    starts, window = np.flatnonzero(whole), window[whole]
    order = np.argsort(window, kind="stable")  # windows of one text stay next to each other
    starts, window = starts[order], window[order]
    same = (window[1:] == window[:-1]) & (owner[starts[1:]] == owner[starts[:-1]])
    twice = np.zeros(len(starts), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[starts[twice] + i] = True
    return np.bincount(owner[covered], minlength=n_texts)


def _entropy(table: _Words, numbers: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Entropy of each text's pieces over the logarithm of their number (1 where all differ, 0 for a single kind)."""
    counts = table.figures.rows[numbers, table.PIECES].astype(np.int64)
    ends = np.cumsum(counts)
    at = np.repeat(table.starts.rows[numbers, 0] - (ends - counts), counts) + np.arange(counts.sum())
    tokens = np.sort((np.repeat(owner, counts) << 16) | table.ids.rows[at, 0].astype(np.int64))
    first = np.flatnonzero(np.diff(tokens, prepend=-1))
    n = np.diff(np.append(first, len(tokens))).astype(float)
    text = tokens[first] >> 16
    total = np.bincount(text, weights=n, minlength=n_texts)
    within = np.bincount(text, weights=n * np.log(n), minlength=n_texts)
    size = np.log(np.maximum(total, 1))
    return np.where(total > 1, (size - within / np.maximum(total, 1)) / np.where(size > 0, size, 1), 0.0)


def measure(docs: DataFrame, files: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts and figures of every whole text, one row for each row of `docs` (a null text has no words)."""

    def run(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out, table = [], _table(files)
        texts, keys = batch.column("text").to_pylist(), batch.column("doc_id")
        for part in groups_of(texts):
            some = [t or "" for t in texts[part]]
            numbers, borders = table.numbers([t.encode().split() for t in some])
            n_words = np.diff(borders)
            owner = np.repeat(np.arange(len(some)), n_words)
            total = sums(table.figures.rows[numbers][:, : table.SCRIPT], borders)
            repeated = repeated_words(numbers, owner, len(some))
            votes = np.zeros((len(some), len(table.scripts)))
            np.add.at(votes, (owner, table.figures.rows[numbers, table.SCRIPT]), table.figures.rows[numbers, table.LETTERS])
            names = list(table.scripts)
            chars, pieces, bpe = (total[:, i] for i in (table.CHARS, table.PIECES, table.BPE))
            columns = [
                keys.slice(part.start, len(some)),
                pa.array(n_words),
                *(pa.array(total[:, i].astype(np.int64)) for i in (table.CHARS, table.SYMBOLS_)),
                pa.array([duplicate_lines(t) for t in some], pa.int64()),
                pa.array(repeated.astype(np.int64)),
                pa.array((n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)),
                pa.array([names[i] for i in votes.argmax(axis=1)], pa.string()),
                pa.array(np.round(chars / np.maximum(pieces, 1), 3)),
                pa.array(np.round(chars / np.maximum(bpe, 1), 3)),
                pa.array(np.round(total[:, table.BYTES] / np.maximum(pieces, 1), 3)),
                pa.array(np.round(_entropy(table, numbers, owner, len(some)), 3)),
            ]
            out.append(pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")]))
        return out

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(text_batches(run), SCHEMA)


def bands(measured: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """(script, then for each figure its lowest and highest accepted value) from all texts that pass the base rules.

    Figures are rounded, so that exact percentiles need no more than a count for each of a few thousand values. As many
    rows as there are scripts, under two hundred.
    """
    good = measured.filter(~F.col("base_failed"))
    middle = good.groupBy("script").agg(*(F.percentile(c, F.lit(0.5)).alias(f"{c}_mid") for c in FIGURES))
    joined = good.join(F.broadcast(middle), "script")
    away = joined.groupBy("script", *(f"{c}_mid" for c in FIGURES)).agg(*(F.percentile(F.round(F.abs(F.col(c) - F.col(f"{c}_mid")), 3), F.lit(0.5)).alias(f"{c}_away") for c in FIGURES))
    half = {c: F.greatest(F.lit(least), deviations * F.col(f"{c}_away")) for c, least in FIGURES.items()}
    limits = [f(F.col(f"{c}_mid"), half[c]).alias(f"{c}_{name}") for c in FIGURES for name, f in (("low", lambda m, h: m - h), ("high", lambda m, h: m + h))]
    return away.select("script", *limits)


def judge(docs: DataFrame, files: Vocabularies, id_col: str = "doc_id", text_col: str = "text", deviations: float = DEVIATIONS) -> DataFrame:
    """The rows of `measure` with `kept`: false where the base rules fail or a figure lies outside the script's band.

    Rows that repeat an id are judged one by one; null ids and texts are rows like others (a null text fails the base
    rules); further columns don't matter; a table without rows gives none. Where no text passes the base rules, none is
    kept.
    """
    measured = staged(measure(docs, files, id_col, text_col))
    limits = staged(bands(measured, deviations))
    inside = reduce(and_, (F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high")) for c in FIGURES))
    joined = measured.join(F.broadcast(limits), "script", "left")
    verdict = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return joined.select(*measured.columns, verdict.alias("kept"))
