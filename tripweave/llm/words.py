"""Numbers by word, kept by a worker from text to text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Texts are worked through in groups of so many characters.
GROUP_CHARS = 1_000_000


def groups_of(texts: Sequence[str | None], chars: int = GROUP_CHARS) -> Iterator[slice]:
    """Slices of neighbouring texts with some `chars` characters, one text at least."""
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end] or "") <= chars):
            held += len(texts[end] or "")
            end += 1
        yield slice(at, end)
        at = end


class WordTable:
    """Gives each distinct word a number; subclasses measure new words in `learn` and keep their figures by number."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.known: dict = {}
        self.clear()

    def clear(self) -> None:
        self.known.clear()

    def learn(self, words: list) -> None:
        raise NotImplementedError

    def numbers(self, lists: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of some texts in a row, and where each text begins (one more border at the end)."""
        if len(self.known) >= self.most:
            self.clear()
        flat = [w for words in lists for w in words]
        known = self.known
        found = list(map(known.get, flat))
        if None in found:
            new = list(dict.fromkeys(w for w, n in zip(flat, found) if n is None))
            at = len(known)
            known.update(zip(new, range(at, at + len(new))))
            self.learn(new)
            found = list(map(known.__getitem__, flat))
        borders = np.zeros(len(lists) + 1, np.int64)
        np.cumsum([len(words) for words in lists], out=borders[1:])
        return np.array(found, np.int64), borders


class Grown:
    """An array of rows that grows at its end."""

    def __init__(self, columns: int, dtype: str) -> None:
        self.rows, self.n = np.zeros((1024, columns), dtype), 0

    def add(self, more: np.ndarray) -> None:
        while self.n + len(more) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.n : self.n + len(more)] = more
        self.n += len(more)


def sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sums of the rows of `values` between borders; 0 where nothing lies between."""
    run = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return run[borders[1:]] - run[borders[:-1]]
