"""Runs of repeated word sequences by grammar compression, and texts without the repeats.

A run is a stretch of words with smallest period q that has at least max(LEAST_WORDS, LEAST_POWER * q) words and that no
neighbouring word extends. Texts are worked through in groups:

1. A pair of neighbouring words inside a run stands in its text LEAST_POWER - 1 times at least. The stretches of such pairs
   are compressed by Re-Pair, all texts of a group at once: pairs that are more frequent than the pairs they overlap become
   nonterminals, round by round, until no pair of a text occurs twice. What is left of a stretch, its start rule, is split
   into halves. Each nonterminal's derivation positions are noted when it is made.
2. A run lies whole in one nonterminal and crosses its boundary, the place between its two halves. Each nonterminal's
   boundary is searched once: the pair of words at the boundary comes again a period later or earlier, so only the distances
   of that pair's other places are tried, with the words themselves compared. Nonterminals whose boundary pair is not near
   another place of it, as in any text without runs, need no search.
3. The intervals found are shifted to all derivation positions, and overlapping ones of one period merged into the longest.

Memory is bounded by GROUP_CHARS characters of text or by the longest text; no rows are exchanged.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import ship, text_batches
from tripweave.llm.words import groups_of

LEAST_WORDS, LEAST_POWER = 6, 4
#: Texts are worked through in groups of so many characters, one text at least.
GROUP_CHARS = 2_000_000
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (what stands between the contract's white space) of some texts in a row, and where each text begins."""
    for space in "\t\n\v\f\r":
        texts = pc.replace_substring(texts, space, " ")
    lists = pc.split_pattern(texts, " ")
    flat = lists.flatten()
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    real = pc.not_equal(flat, "")
    return flat.filter(real), np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[offsets]


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct key, by entry, and how often each number occurs."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, bool)
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(fresh) - 1
    return out, np.diff(np.append(np.flatnonzero(fresh), len(keys)))


class Grammar:
    """Nonterminals of a group's repetitive stretches.

    starts, left, length: by nonterminal, its first derivation position, and the words of its first half and of the whole.
    occurs: (nonterminals, positions) of all derivation positions. after, before: by the position of a word pair, the next
    and the last position of the same pair in the same text, or far away.
    """

    def __init__(self, words: np.ndarray, borders: np.ndarray) -> None:
        self.words, n = words, len(words)
        text = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
        self.after, self.before = np.full(n, 4 * n + 4), np.full(n, -4 * n - 4)
        at = self._repeated_pairs(text)
        self.starts, self.left, self.length = [], [], []
        self.occurs: list[tuple[np.ndarray, np.ndarray]] = []
        self.made = 0
        self._compress(at, text)
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.starts, self.left, self.length = join(self.starts), join(self.left), join(self.length)
        self.occurs = (join([s for s, _ in self.occurs]), join([p for _, p in self.occurs]))

    def _repeated_pairs(self, text: np.ndarray) -> np.ndarray:
        """Positions of word pairs that occur often enough in their text, in stretches long enough for a run."""
        words = self.words
        at = np.flatnonzero(text[:-1] == text[1:]) if len(words) else np.zeros(0, np.int64)
        top = int(words.max()) + 1 if len(words) else 1
        least = LEAST_POWER - 1
        pair, counts = _numbered(words[at] * top + words[at + 1])
        often = counts[pair] >= least
        at, pair = at[often], pair[often]
        pair, counts = _numbered(text[at] * (int(pair.max()) + 1 if len(pair) else 1) + pair)
        often = counts[pair] >= least
        at, pair = at[often], pair[often]
        begins = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        sizes = np.diff(np.append(begins, len(at)))
        kept = np.repeat(sizes + 1 >= LEAST_WORDS, sizes)
        at, pair = at[kept], pair[kept]
        order = np.lexsort((at, pair))
        same = np.flatnonzero(pair[order][1:] == pair[order][:-1])
        self.after[at[order[same]]] = at[order[same + 1]]
        self.before[at[order[same + 1]]] = at[order[same]]
        return at

    def _compress(self, at: np.ndarray, text: np.ndarray) -> None:
        if not len(at):
            return
        # Positions of all words of the stretches, and the stretch of each.
        begins = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        sizes = np.diff(np.append(begins, len(at))) + 1
        stretch = np.repeat(np.arange(len(sizes)), sizes)
        pos = np.repeat(at[begins] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(stretch))
        symbol, _ = _numbered(text[pos] * (int(self.words.max()) + 1) + self.words[pos])  # a text's own words
        length, top = np.ones(len(pos), np.int64), 2 * len(pos) + 1
        first_free = len(pos)
        while True:
            joins = stretch[:-1] == stretch[1:]
            pair, counts = _numbered((symbol[:-1] * top + symbol[1:])[joins])
            # A pair's rank: by frequency, ties in a mixed order.
            rank = np.empty(len(counts), np.int64)
            rank[np.lexsort(((np.arange(len(counts)) * 0x9E3779B1) & 0xFFFFFFFF, counts))] = np.arange(len(counts))
            weight = np.full(len(pos), -1)
            weight[:-1][joins] = np.where(counts[pair] > 1, rank[pair], -1)
            number = np.full(len(pos), -1)
            number[:-1][joins] = pair
            # Of overlapping places of one pair every other one is taken.
            fresh = np.concatenate([[True], weight[1:] != weight[:-1]])
            fresh[1:] |= stretch[1:] != stretch[:-1]
            begins = np.flatnonzero(fresh)
            level = weight[begins]
            higher = (level >= 0) & (level > np.concatenate([[-1], level[:-1]])) & (level > np.append(level[1:], -1))
            run = np.cumsum(fresh) - 1
            taken = np.flatnonzero(higher[run] & ((np.arange(len(pos)) - begins[run]) % 2 == 0))
            if not len(taken):
                break
            made, _ = _numbered(number[taken])
            symbol[taken] = first_free + self._note(made, pos[taken], length[taken], length[taken + 1])
            pos, stretch, symbol, length = self._joined(taken, pos, stretch, symbol, length)
        while True:
            begins = np.flatnonzero(np.diff(stretch, prepend=-1))
            place = np.arange(len(stretch)) - np.repeat(begins, np.diff(np.append(begins, len(stretch))))
            taken = np.flatnonzero((place[:-1] % 2 == 0) & (stretch[:-1] == stretch[1:]))
            if not len(taken):
                break
            self._note(np.arange(len(taken)), pos[taken], length[taken], length[taken + 1])
            pos, stretch, symbol, length = self._joined(taken, pos, stretch, symbol, length)

    def _note(self, made: np.ndarray, pos: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Adds nonterminals, numbered from 0 in `made`, with their positions; gives their numbers in the grammar."""
        _, first = np.unique(made, return_index=True)
        self.starts.append(pos[first])
        self.left.append(left[first])
        self.length.append(left[first] + right[first])
        self.occurs.append((self.made + made, pos))
        number = self.made + made
        self.made += len(first)
        return number

    @staticmethod
    def _joined(taken, pos, stretch, symbol, length) -> tuple[np.ndarray, ...]:
        length[taken] += length[taken + 1]
        rest = np.ones(len(pos), bool)
        rest[taken + 1] = False
        return pos[rest], stretch[rest], symbol[rest], length[rest]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, period) of all runs of the group's words in order of start and period."""
        at, quarter = self.starts + self.left - 1, self.length // LEAST_POWER
        soon = (self.after[at] - at <= quarter) if len(at) else np.zeros(0, bool)
        late = (at - self.before[at] <= quarter) if len(at) else np.zeros(0, bool)
        found = []
        for x in np.flatnonzero((self.length >= LEAST_WORDS) & (soon | late)).tolist():
            lo = int(self.starts[x])
            found += [(x, s - lo, e - lo, q) for s, e, q in self._crossing(lo, lo + int(self.left[x]), lo + int(self.length[x]))]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        node, start, end, period = np.array(found, np.int64).T
        nodes, places = self.occurs
        hit = np.isin(nodes, node)
        nodes, places = nodes[hit], places[hit]
        order = np.argsort(nodes, kind="stable")
        nodes, places = nodes[order], places[order]
        lows = np.searchsorted(nodes, node)
        counts = np.searchsorted(nodes, node, "right") - lows
        shift = places[np.repeat(lows - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
        return _merged(np.repeat(start, counts) + shift, np.repeat(end, counts) + shift, np.repeat(period, counts))

    def _crossing(self, lo: int, b: int, hi: int) -> set[tuple[int, int, int]]:
        """Runs within [lo, hi) that cross b, as far as they go there. Two periods of a run lie on one side of b.

        Once a run is found, shorter distances than what it holds on that side can only give its own period again.
        """
        words, out = self.words, set()
        for other, step in ((self.after, 1), (self.before, -1)):
            known, place = 0, int(other[b - 1])
            while lo <= place < hi - 1:
                q = (place - b + 1) * step
                side = hi - b if step > 0 else b - lo
                if LEAST_POWER * q > hi - lo or 2 * q > side:
                    break
                x = b if step > 0 else b - 2 * q  # these and the q words after them must be alike
                if q > known and words[x] == words[x + q] and words[x + q - 1] == words[x + 2 * q - 1] and np.array_equal(words[x : x + q], words[x + q : x + 2 * q]):
                    e = x + 2 * q + _alike(words, x + q, x + 2 * q, hi - x - 2 * q)
                    s = x - _alike_before(words, x, x + q, x - lo)
                    if e - s >= max(LEAST_WORDS, LEAST_POWER * q) and s < b < e:
                        out.add((s, e, q))
                        known = (e - b if step > 0 else b - s) - q
                place = int(other[place])
        return out


def _alike(words: np.ndarray, x: int, y: int, most: int) -> int:
    """How many words from x on equal those from y on, `most` at most."""
    done, step = 0, 64
    while done < most:
        size = min(step, most - done)
        differ = words[x + done : x + done + size] != words[y + done : y + done + size]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + size, 2 * step
    return done


def _alike_before(words: np.ndarray, x: int, y: int, most: int) -> int:
    """How many words before x equal those before y, `most` at most."""
    done, step = 0, 64
    while done < most:
        size = min(step, most - done)
        differ = (words[x - done - size : x - done] != words[y - done - size : y - done])[::-1]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + size, 2 * step
    return done


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one period that overlap by a period or more as one."""
    order = np.lexsort((end, start, period))
    start, end, period = start[order], end[order], period[order]
    top = int(end.max()) + 1
    group = np.cumsum(np.diff(period, prepend=period[:1]) > 0)
    reach = np.maximum.accumulate(end + group * top) - group * top
    fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - period[1:])])
    begins = np.flatnonzero(fresh)
    start, end, period = start[begins], np.maximum.reduceat(end, begins), period[begins]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def planted(flat_sizes: np.ndarray, borders: np.ndarray, hashes: list[int | None]) -> np.ndarray:
    """By word, the place of the word that stands there: some texts' ends become periodic, as their hash says.

    hashes: of each text, crc32 of its id in decimal digits. Texts with hash % 10 == 0 repeat the words from place a on with
    period p, where g = hash // 10, a = g % n and p = 1 + (n - a) // (3 + g % 8); a text without words or hash stays.
    """
    place = flat_sizes.copy()
    for h, lo, hi in zip(hashes, borders[:-1].tolist(), borders[1:].tolist()):
        n = hi - lo
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            place[lo + a : hi] = lo + a + np.arange(n - a) % p
    return place


def _described(ids: list[int | None], texts: pa.Array, plant: bool) -> list[tuple]:
    flat, borders = words_of(texts)
    if plant:
        place = planted(np.arange(len(flat)), borders, [None if i is None else zlib.crc32(str(i).encode()) for i in ids])
        flat = flat.take(pa.array(place))
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    start, end, period = Grammar(codes, borders).runs()
    # Words after a run's first period, inside it.
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change)[:-1] == 0
    offsets = np.concatenate([[0], np.cumsum(kept)])[borders]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat.filter(pa.array(kept)))
    collapsed = pc.binary_join(lists, " ").to_pylist()
    cuts = np.searchsorted(start, borders)
    out = []
    for i, (doc_id, text) in enumerate(zip(ids, collapsed)):
        lo = int(borders[i])
        runs = [(s - lo, e - s, q) for s, e, q in zip(*(x[cuts[i] : cuts[i + 1]].tolist() for x in (start, end, period)))]
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        out.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest, hashlib.sha256(text.encode()).hexdigest()))
    return out


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """The runs of every whole text, a row for each row of `docs`:

    doc_id, n_runs; start (word number), length, period and exponent_milli of the run with the greatest length / period (ties:
    smallest start, then period), null without a run; runs_sha256 of every run's `start,length,period` and a line end, by start,
    then period; collapsed_sha256 of the text without the words that a run holds after its first period, joined by a blank.

    A null text and one without words have no run and an empty collapsed text. Rows that repeat an id are treated one by
    one; a null id stays null. Further columns don't matter; a table without rows gives none. Very long texts are worked
    through whole, in a group of their own.
    plant: ends of some texts are made periodic first (`planted`); a text with a null id stays as it is.
    """
    ship(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        ids, texts = batch.column("doc_id").to_pylist(), pc.fill_null(batch.column("text"), "")
        types, names = [pa.int64()] * 6 + [pa.string()] * 2, [field.split(" ")[0] for field in SCHEMA.split(", ")]
        out = []
        for part in groups_of(texts.to_pylist(), GROUP_CHARS):
            rows = _described(ids[part], texts.slice(part.start, part.stop - part.start), plant)
            out.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names))
        return out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(text_batches(run), SCHEMA)
