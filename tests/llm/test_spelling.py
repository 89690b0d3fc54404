import random
import re
import zlib
from collections import Counter

from tripweave.llm import spelling as S


def near(a, b):
    """Whether one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, plant=None):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if plant and doc_id is not None and h % plant == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute_variants(words):
    around = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for size, own in by_length.items():
        for i, a in enumerate(own):
            for b in own[i + 1 :] + by_length.get(size + 1, []):
                if near(a, b):
                    around[a].append(b)
                    around[b].append(a)
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(around[w]), words.get(form[w])))
    return out


def invented(rng, n):
    """Words around a few stems, with frequencies that make chains of forms."""
    stems = ["".join(rng.choice("abcdeéßÿà") for _ in range(rng.randint(6, 9))) for _ in range(n // 6)]
    words = {s: rng.choice([5, 30, 200, 900]) for s in stems}
    while len(words) < n:
        w = rng.choice(sorted(words))
        i, c = rng.randrange(len(w) + 1), rng.choice("abcdeéßÿà")
        w = rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])
        if len(w) >= 6:
            words.setdefault(w, rng.choice([5, 6, 25, 30, 150]))
    return words


def rows_of(frame):
    return [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_variants_as_brute_force(spark, monkeypatch):
    words = invented(random.Random(2), 900)
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    wanted = brute_variants(words)
    assert any(form and root != form for _, form, root, *_ in wanted)
    for most, bins in ((2048, S.BINS), (200, S.BINS), (20, (1,)), (7, (4,)), (3, (8,))):
        monkeypatch.setattr(S, "BLOCK_WORDS", most)
        monkeypatch.setattr(S, "BINS", bins)
        found = rows_of(S.variants(table))
        assert len(found) == len(wanted) and set(found) == wanted


def test_words_as_brute_force(spark, docs_of):
    rng = random.Random(7)
    words = sorted(invented(rng, 120))
    rows = [(i, rng.choice([" ", ", ", "\n", "7", "–"]).join(rng.choice([w, w.upper(), w.title()]) for w in rng.choices(words, k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "Straße" * 4000 + " straße " * 6), (None, "nullid " * 9), (None, "nullid " * 9), (903, "x" * 9000 + " " + ("x" * 8999 + " ") * 5 + ("x" * 9000 + " ") * 30), (3, rows[3][1])]
    for plant in (None, 3):
        found = {r.word: r.n for r in S.vocabulary(docs_of(rows), plant_every=plant).collect()}
        assert found == brute_words(rows, plant)
    assert set(rows_of(S.variants(S.vocabulary(docs_of(rows), plant_every=3)))) == brute_variants(brute_words(rows, 3))
    assert rows_of(S.variants(S.vocabulary(docs_of(rows).limit(0)))) == []


def test_candidates_are_near_in_letter_counts():
    i, j = S._candidates(S._Block(["abcdef", "fedcba", "abcdxy"]), S._Block(["abcdef", "abcdeg", "zzzzzz"]))
    assert set(zip(i.tolist(), j.tolist())) == {(0, 0), (0, 1), (1, 0), (1, 1)}
    i, j = S.near_pairs(["abcdef", "fedcba"], ["abcxdef", "abcdeff"])
    assert set(zip(i.tolist(), j.tolist())) == {(0, 0), (0, 1)}


def test_query_on_small_table(spark):
    from tripweave.llm.queries import REGISTRY

    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = rows_of(REGISTRY["op13_spelling_variants"][0](spark, sf_dir))
    assert len(found) > 100 and set(found) == brute_variants(brute_words(docs, 199))
