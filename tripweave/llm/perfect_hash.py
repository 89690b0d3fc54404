"""Minimal perfect hash over 128-bit key hashes, built and read with numpy.

Each key is an edge between three vertices, one in each third of a table some 1.25 times as long as the keys are many.
Edges are peeled off in rounds, always those with a vertex of their own, and in reverse order each own vertex gets the
2-bit value that makes the sum of the edge's three values point at it. The rank of that vertex among all own vertices is
the key's slot, so n keys fill n slots.
"""

from __future__ import annotations

import io

import numpy as np

U = np.uint64
BLOCK = 256
FREE = 3


def _mixed(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a ^ (b * U(0x9E3779B97F4A7C15)) ^ U((salt * 0xD1B54A32D192ED03) & (2**64 - 1))
        x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(32))


def _edges(a: np.ndarray, b: np.ndarray, third: int, seed: int) -> np.ndarray:
    return np.stack([(_mixed(a, b, 3 * seed + i) % U(third)).astype(np.int64) + i * third for i in range(3)], axis=1)


class PerfectHash:
    """Slots 0..n-1 for n distinct keys, given as two 64-bit hashes each; `slots` of another key is any number."""

    def __init__(self, seed: int, third: int, values: np.ndarray) -> None:
        self.seed, self.third, self.values = seed, third, values
        own = np.append(values, np.full(-len(values) % BLOCK, FREE, np.uint8)).reshape(-1, BLOCK) != FREE
        self.before = np.concatenate([[0], np.cumsum(own.sum(axis=1))])

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> "PerfectHash":
        n = len(a)
        if n and len(np.unique(np.stack([a, b], axis=1), axis=0)) < n:
            raise ValueError("keys must be distinct, also in their 128-bit hashes")
        third = int(1.25 * n / 3) + 2
        for seed in range(200):
            values = cls._try(_edges(a, b, third, seed), third)
            if values is not None:
                return cls(seed, third, values)
        raise ValueError("no seed separates the keys")

    @staticmethod
    def _try(edges: np.ndarray, third: int) -> np.ndarray | None:
        n = len(edges)
        degree = np.bincount(edges.ravel(), minlength=3 * third)
        crossed = np.zeros(3 * third, np.int64)  # xor of the edges at a vertex: at degree 1, that edge
        for i in range(3):
            np.bitwise_xor.at(crossed, edges[:, i], np.arange(n))
        rounds, left = [], n
        while left:
            own = np.flatnonzero(degree == 1)
            peeled, first = np.unique(crossed[own], return_index=True)
            if not len(peeled):
                return None
            rounds.append((peeled, own[first]))
            left -= len(peeled)
            for i in range(3):
                np.subtract.at(degree, edges[peeled, i], 1)
                np.bitwise_xor.at(crossed, edges[peeled, i], peeled)
        values = np.full(3 * third, FREE, np.uint8)
        for peeled, own in reversed(rounds):
            mine = edges[peeled]
            place = (mine == own[:, None]).argmax(axis=1)
            others = values[mine].astype(np.int64).sum(axis=1) - FREE
            values[own] = (place - others) % 3
        return values

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        edges = _edges(a, b, self.third, self.seed)
        place = self.values[edges].astype(np.int64).sum(axis=1) % 3
        vertex = edges[np.arange(len(edges)), place]
        block = vertex // BLOCK
        if len(vertex) < 64:
            within = np.array([(self.values[k * BLOCK : v] != FREE).sum() for k, v in zip(block, vertex)], np.int64)
            return self.before[block] + within
        return np.concatenate([[0], np.cumsum(self.values != FREE)])[vertex]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.save(out, np.array([self.seed, self.third]))
        np.save(out, self.values)
        return out.getvalue()

    @classmethod
    def from_file(cls, file: io.BytesIO) -> "PerfectHash":
        seed, third = np.load(file)
        return cls(int(seed), int(third), np.load(file))
