"""Words and their spelling variants: near words by blocked Gram matrices of letter counts.

Two words are near if they differ by one inserted, deleted or replaced letter. Their letter counts then differ by a squared
distance of one (lengths one apart) or two (same length), so:

1. The corpus is counted to words, each batch of texts by itself first.
2. Words are dealt into cells by length and by counts of letters in a few bins. A near word lies in the same cell or in one
   where a letter has moved from bin to bin, come or gone; each word is sent to the meetings of its cell with those. Cells of
   more than BLOCK_WORDS words are cut, and each part meets each. The number of bins grows with the vocabulary.
3. A meeting multiplies two blocks of letter counts; |x|^2 + |y|^2 - 2xy gives all squared distances. Pairs of at most two
   are compared letter by letter. Only counts and the best near word of each word leave a task, not the pairs.

Every pair of cells and parts meets once, so every near pair counts once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import discard, ship, staged, text_batches

LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A near word is another's form if it is so many times as frequent.
FORM_RATIO = 5
#: The most words of a block, and the most letters of one.
BLOCK_WORDS, BLOCK_LETTERS = 2_048, 4_000_000
#: Numbers of bins to choose from: more make smaller cells, and more meetings of each.
BINS = (1, 2, 4, 8)
#: Words and letters that meet in one task, about.
TASK_WORDS, TASK_LETTERS = 100_000, 4_000_000
RUN = re.compile("[a-zÀ-ÿ]+")
#: Columns of a letter count: a-z and U+00C0 to U+00FF.
LETTERS = 26 + 64


def _deleted(key: str, run: str, every: int) -> str:
    h = zlib.crc32(f"{key}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, plant_every: int | None = None) -> DataFrame:
    """(word, n): runs of letters with A-Z as a-z, of at least so many letters and occurrences over all whole texts.

    plant_every: a run's letter h % length goes where this number divides h, the crc32 of `id:run`; not where the id is null.
    Null texts have no words.
    """
    ship(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter[str] = Counter()
        for key, text in zip(batch.column("doc_id").to_pylist(), pc.ascii_lower(batch.column("text")).to_pylist()):
            own = Counter(RUN.findall(text))
            if plant_every and key is not None:
                for word, n in own.items():
                    counts[_deleted(str(key), word, plant_every)] += n
            else:
                counts.update(own)
        words = [w for w in counts if len(w) >= least_length]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())], names=["word", "n"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("text is not null")
    counted = texts.mapInArrow(text_batches(run), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# Cells and meetings ---------------------------------------------------------------------------------------------------


def _cell(bins: int) -> Column:
    """Length, and how many letters lie in each bin: by code point modulo the number of bins."""
    if bins == 1:
        return F.array(F.char_length("word"))
    letters = F.split("word", "")

    def held(b: int) -> Column:
        return F.size(F.filter(letters, lambda letter: F.pmod(F.ascii(letter), F.lit(bins)) == b))

    return F.array(F.char_length("word"), *map(held, range(bins)))


def _moved(cell: Column, bins: int, change: dict[int, int]) -> Column:
    return F.array(*(cell[i] + change.get(i, 0) for i in range(bins + 1 if bins > 1 else 1)))


def _neighbours(cell: Column, bins: int) -> Column:
    """Cells that hold near words: the cell itself, and one letter moved, more or fewer."""
    if bins == 1:
        return F.array(*(_moved(cell, 1, {0: step}) for step in (-1, 0, 1)))
    changes: list[dict[int, int]] = [{}]
    changes += [{i: -1, j: 1} for i in range(1, bins + 1) for j in range(1, bins + 1) if i != j]
    changes += [{0: step, i: step} for i in range(1, bins + 1) for step in (-1, 1)]
    return F.filter(F.array(*(_moved(cell, bins, c) for c in changes)), lambda x: F.array_min(x) >= 0)


def _block_words(cell: Column) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(BLOCK_LETTERS) / cell[0])))


def _meetings(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(meeting, side, word, n): each word in all meetings of its block, and the table of cells that are cut.

    side: 0 where a block meets itself, else 1 for the words of the block that comes first and 2 for the other's.
    """
    for bins in BINS:
        sizes = words.groupBy(_cell(bins).alias("cell")).agg(F.count("*").alias("m"))
        large = sizes.filter(F.col("m") > _block_words(F.col("cell")))
        if large.isEmpty():
            break
    large = staged(large.select("cell", F.ceil(F.col("m") / _block_words(F.col("cell"))).alias("parts")))
    own = words.select("word", "n", _cell(bins).alias("cell")).join(large, "cell", "left")
    own = own.withColumn("part", F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1).cast("long"))))
    met = own.select("word", "n", "cell", "part", F.explode(_neighbours(F.col("cell"), bins)).alias("other")).join(large.toDF("other", "other_parts"), "other", "left")
    met = met.select("word", "n", "cell", "part", "other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("other_parts", F.lit(1).cast("long")) - 1)).alias("other_part"))
    mine, theirs = F.struct("cell", "part"), F.struct(F.col("other").alias("cell"), F.col("other_part").alias("part"))
    key = F.to_json(F.struct(F.least(mine, theirs).alias("a"), F.greatest(mine, theirs).alias("b")))
    return met.select(key.alias("meeting"), F.when(mine == theirs, 0).when(mine < theirs, 1).otherwise(2).alias("side"), "word", "n"), large


# Blocks ---------------------------------------------------------------------------------------------------------------


class _Block:
    """Words of one length: their code points and letter counts."""

    def __init__(self, words: list[str]) -> None:
        self.codes = np.frombuffer("".join(words).encode("utf-16-le"), "<u2").reshape(len(words), -1)
        column = np.where(self.codes < 128, self.codes - 97, self.codes - 0xC0 + 26)
        exact = np.float32 if self.codes.shape[1] < 2048 else np.float64  # squares of a length below 2 ** 24 and 2 ** 53
        place = column + np.arange(len(words))[:, None] * LETTERS
        self.counts = np.bincount(place.ravel(), minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(exact)
        self.squares = (self.counts * self.counts).sum(1)


def _candidates(x: _Block, y: _Block) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose letter counts have a squared distance of two at most."""
    gram = x.counts @ y.counts.T
    return np.nonzero(x.squares[:, None] + y.squares[None, :] - 2 * gram <= 2)


def _one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by one letter; y may be a letter longer."""
    n = x.shape[1]
    if y.shape[1] == n:
        return (x != y).sum(1) == 1
    differ, late = x != y[:, :n], (x != y[:, 1:])[:, ::-1]
    ahead = np.where(differ.any(1), differ.argmax(1), n)
    behind = np.where(late.any(1), late.argmax(1), n)
    return ahead + behind >= n


def near_pairs(first: list[str], second: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of near words in two lists, each of one length, the second's the same or one more; or within one list."""
    x = _Block(first)
    y = x if second is None else _Block(second)
    i, j = _candidates(x, y)
    if second is None:
        i, j = i[i < j], j[i < j]
    step = max(1, 1 << 22 >> x.codes.shape[1].bit_length())
    kept = [_one_edit(x.codes[i[k : k + step]], y.codes[j[k : k + step]]) for k in range(0, len(i), step)]
    kept = np.concatenate(kept) if kept else np.zeros(0, bool)
    return i[kept], j[kept]


def _met(table: pa.Table) -> pa.Table:
    """(word, n_near, near_n, near) over the meetings of one task: near words, and the most frequent's n and text."""
    found: dict[str, list] = {}

    def tell(word: str, other: str, n: int) -> None:
        own = found.setdefault(word, [0, 0, ""])
        own[0] += 1
        if n > own[1] or n == own[1] and other < own[2]:
            own[1:] = n, other

    meeting = pc.dictionary_encode(table.column("meeting").combine_chunks()).indices.to_numpy()
    side = table.column("side").to_numpy()
    words, counts = table.column("word").to_pylist(), table.column("n").to_pylist()
    order = np.lexsort((side, meeting))
    for at in np.split(order, np.flatnonzero(np.diff(meeting[order])) + 1):
        sides = side[at]
        first = at[sides < 2].tolist()
        second = first if sides[0] == 0 else at[sides == 2].tolist()
        if not first or not second:
            continue
        i, j = near_pairs([words[k] for k in first], None if sides[0] == 0 else [words[k] for k in second])
        for a, b in zip(i.tolist(), j.tolist()):
            p, q = first[a], second[b]
            tell(words[p], words[q], counts[q])
            tell(words[q], words[p], counts[p])
    columns = [list(found), *map(list, zip(*found.values()))] if found else [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "near_n", "near"])


def near_words(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word, n_near, near_n, near) of words (word, n) with near words, and the helping table to discard afterwards.

    near: the near word of largest n, ties the smallest in code-point order.
    """
    met, large = _meetings(words)
    size = met.agg(F.count("*").alias("rows"), F.sum(F.length("word")).alias("letters")).first()
    tasks = 1 + max(size.rows // TASK_WORDS, (size.letters or 0) // TASK_LETTERS)
    told = met.withColumn("task", F.pmod(F.xxhash64("meeting"), F.lit(tasks))).groupBy("task").applyInArrow(_met, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    merged = told.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near")), large


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words (word, form): the last word that forms lead to.

    A form is FORM_RATIO times as frequent as its word, so chains are short, and each round halves what is left of them. At
    most as many words as have a near word in common meet on one key.
    """
    roots = forms.toDF("word", "root")
    while True:
        further = roots.toDF("root", "next")
        after = staged(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return roots


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of a vocabulary (word, n):

    n_near: its near words; form: the near word of largest n (ties: smallest in code-point order) if that is at least
    FORM_RATIO times the word's n, form_n its n, else both null; root: the last word that forms lead to, the word itself
    without a form.

    Words of any length are compared whole. Words are distinct and consist of a-z and U+00C0 to U+00FF; a vocabulary without
    words gives none.
    """
    words = staged(words.select("word", "n"))
    near, large = near_words(words)
    near = staged(words.join(near, "word", "left"))
    discard(large)
    has = F.col("near_n") >= FORM_RATIO * F.col("n")
    judged = near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n"))
    roots = _roots(judged.filter("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
