import random

import numpy as np
import pytest

from tripweave.llm import near_duplicates as N


def brute(rows):
    """component_id and size of the set by row number, from all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        r = root(i)
        low[r] = min(low.get(r, (True, 0)), (key is None, key or 0))
    return [(key, len(sets[i]), None if low[root(i)][0] else low[root(i)][1]) for i, (key, _) in enumerate(rows)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.randint(0, 1)] = [f"e{rng.randint(0, 99)}"]
    return words


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(60):  # small families, some a chain of copies of copies
        words = [word() for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(1, 4)):
            rows.append(" ".join(words))
            words = edited(rng, words, rng.randint(0, 4))
    base = [word() for _ in range(120)]
    rows += [" ".join(edited(rng, base, rng.randint(0, 4))) for _ in range(150)]  # a large group of near copies
    rows += [" ".join([word() for _ in range(rng.randint(5, 60))] + passage) for _ in range(120)]  # a common passage
    rows += ["hot copy of one text " * 3] * 60
    keyed = [(i, t) for i, t in enumerate(rng.sample(rows, len(rows)))]
    return keyed + [(900, None), (901, ""), (902, " \n"), (903, "Two words"), (904, "two WORDS"), (905, "two words Ä"), (906, "two words ä"), (None, "no id here at all"), (None, "no id here at all"), (5, "an id again"), (5, "an id again")]


@pytest.mark.parametrize(("seed", "small"), [(1, False), (2, True)])
def test_components_as_brute_force(spark, docs_of, monkeypatch, seed, small):
    if small:  # many ranges, groups dealt anew, prefixes lengthened
        for name, value in (("RANGE_TOKENS", 500), ("CHUNK_CLASSES", 12), ("COSTLY", 5), ("COUNTERS_LOG2", 8), ("ROUNDS", 1)):
            monkeypatch.setattr(N, name, value)
    rows = corpus(seed)
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in N.components(docs_of(rows, partitions=5)).collect()]
    assert order(found) == order(brute(rows))


def test_one_of_each_component_stays(spark, docs_of):
    rows = [(i, t) for i, t in corpus(3) if i is not None and i != 5]
    stays = N.keep_one(docs_of(rows))
    assert stays.columns == docs_of(rows).columns
    assert sorted(r.doc_id for r in stays.collect()) == sorted(key for key, _, low in brute(rows) if key == low)
    repeated = docs_of([(1, "the same five words here")] * 3 + [(None, "THE same five words here"), (None, None), (2, "")])
    assert N.keep_one(repeated).count() == 3


def test_empty_table(spark, docs_of):
    none = docs_of([(1, "a")]).limit(0)
    assert N.components(none).collect() == [] and N.keep_one(none).collect() == []


def test_long_text(spark, docs_of):
    rng = random.Random(4)
    words = [f"w{rng.randint(0, 5000)}" for _ in range(120_000)]
    rows = [(1, " ".join(words)), (2, " ".join(edited(rng, words, 900))), (3, " ".join(words[:90_000]))]
    assert [r.component_id for r in N.components(docs_of(rows)).orderBy("doc_id").collect()] == [1, 1, 3]


def test_prefixes_are_lengthened_by_cost():
    tokens = np.sort(np.random.default_rng(1).integers(0, 2**63, 100).astype(np.uint64))
    for each, more in ((1, 0), (1 + N.COSTLY // 20, 5), (1 + N.COSTLY, 10)):
        _, short, long, asked = N._prefixes(tokens, np.array([100]), N.Counters(np.full(1 << 20, each), N.COSTLY))
        assert (short[0], long[0], asked[0]) == (21, 21 + more, 1 + more)


def test_keep_one_with_clashing_names_and_rows_without_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, 7, 8, 9, 1, b"x"), (2, text + " more", 7, 8, 9, 2, b"y"), (None, text, 7, 8, 9, 3, b"z"), (4, None, 7, 8, 9, 4, b""), (5, "", 7, 8, 9, 5, b"")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __half long, __row_number long, __dropped long, uid long, sig binary").repartition(2)
    for some, kept in ((docs.filter("doc_id is not null"), {1, 4, 5}), (docs, None)):
        found = N.keep_one(some, "doc_id", "text")
        assert found.columns == docs.columns
        uids = {r.uid for r in found.collect()}
        assert uids == kept if kept else len(uids) == 3 and {4, 5} <= uids
