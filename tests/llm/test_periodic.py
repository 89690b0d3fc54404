import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from tripweave.llm import periodic as P


def brute_runs(words):
    """Every run, from all periods and all words."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        at = 0
        while at < len(same):
            end = at
            while end < len(same) and same[end]:
                end += 1
            s, e = at, end + q
            if end > at and e - s >= max(6, 4 * q) and not any(words[s : e - p] == words[s + p : e] for p in range(1, q)):
                out.append((s, e - s, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, plant=False):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    digest = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest, hashlib.sha256(kept.encode()).hexdigest())


def repetitive(rng, size, letters):
    words = []
    while len(words) < size:
        kind = rng.random()
        if kind < 0.3:
            words += [rng.choice(letters) for _ in range(rng.randint(1, 12))]
        elif kind < 0.6:
            unit = [rng.choice(letters) for _ in range(rng.randint(1, 7))]
            words += (unit * rng.randint(2, 9))[: rng.randint(3, 60)]
        elif kind < 0.8 and words:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randint(1, 40)] * rng.randint(1, 3)
        else:
            words += [rng.choice(letters)] * rng.randint(1, 20)
    return words


def test_grammar_finds_every_run():
    rng = random.Random(3)
    for _ in range(400):
        texts = [repetitive(rng, rng.choice([0, 5, 30, 120]), range(rng.choice([1, 2, 3, 6]))) for _ in range(rng.randint(1, 5))]
        borders = np.cumsum([0] + [len(t) for t in texts])
        found = P.Grammar(np.array([w for t in texts for w in t], np.int64), borders).runs()
        wanted = [(s + int(b), s + int(b) + n, q) for t, b in zip(texts, borders) for s, n, q in brute_runs(t)]
        assert list(zip(*(x.tolist() for x in found))) == wanted


def test_boundaries_are_searched_once():
    """A long run has few nonterminals, however long it is."""
    grammar = P.Grammar(np.tile(np.arange(5), 4000), np.array([0, 20_000]))
    assert len(grammar.starts) < 60
    assert [x.tolist() for x in grammar.runs()] == [[0], [20_000], [5]]


def test_rows_as_brute_force(spark, docs_of):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        words = [f"w{x}" for x in repetitive(rng, rng.choice([0, 3, 10, 60, 200]), range(rng.choice([1, 3, 40])))]
        rows.append((i, rng.choice([" ", "\n", "\t \r", "\x0b"]).join(words)))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "é " * 7 + "a\x85b " * 9), (503, "é " * 7 + "a\x85b " * 9), (504, "la " * 30_000 + "end")]
    rows += [(None, "ho " * 8), (505, "一 二 " * 4), (506, "a b c " * 3)]
    for plant in (False, True):
        found = P.detect(docs_of(rows), plant=plant).collect()
        assert sorted(map(tuple, found), key=str) == sorted((expected(i, t, plant) if i != 504 else long_row(i, t, plant) for i, t in rows), key=str)
    assert P.detect(docs_of(rows).limit(0)).collect() == []


def long_row(doc_id, text, plant):
    """A text of one word 30,000 times, which brute force can't do in time, from its definition."""
    assert not plant or zlib.crc32(str(doc_id).encode()) % 10
    run = (0, 30_000, 1)
    digests = ["0,30000,1\n", "la end"]
    return (doc_id, 1, *run, 30_000_000, *(hashlib.sha256(d.encode()).hexdigest() for d in digests))


def test_query_on_small_table(spark):
    from tripweave.llm.queries import REGISTRY

    sf_dir = "/root/testdata/sf0.001"
    rows = {r.doc_id: tuple(r) for r in REGISTRY["op11_periodic_runs"][0](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for r in docs:
        if len(r.text or "") < 6_000:
            assert rows[r.doc_id] == expected(r.doc_id, r.text, True)
    assert sum(r[1] > 0 for r in rows.values()) > 5
