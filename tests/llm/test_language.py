from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tripweave.llm import language as L

DATA = "/root/testdata/sf0.01"


def test_model_is_a_distribution_and_prefers_its_own_text():
    grams = Counter()
    for word in L.letter_runs("the cat sat on the mat and the dog sat on the cat " * 20):
        padded = " " * 4 + word + " "
        grams.update(padded[i : i + 5] for i in range(len(word) + 1))
    names = sorted(grams)
    model = L.KneserNey.fit(names, np.array([grams[g] for g in names]))
    letters = "abcdefghijklmnopqrstuvwxyz "
    for context in ("    ", "   t", "  th", "  ca", " the"):
        symbols = np.array([[ord(c) for c in " " + context + x] for x in letters], np.uint64)
        hashes = [L._hash_rows(symbols[:, 6 - k :]) for k in range(1, 6)]
        before = [L._hash_rows(symbols[:, 5 - k : 5]) for k in range(1, 6)]
        p = np.exp(model.score(hashes, before))
        assert 0.5 < p.sum() < 1.0001  # what is left goes to the other symbols


def test_held_out_accuracy_and_odd_texts(spark, docs_of):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    models = L.fit(docs, ~L.held_out("doc_id", 4, 2))
    found = L.identify(docs, models).withColumn("held_out", L.held_out("doc_id", 4, 2)).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in held) and sum(r.accepted for r in held) >= 0.995 * len(held)
    german = docs.filter("lang = 'de'").first().text
    odd = docs_of([(1, None), (2, ""), (3, "12 34 !!"), (None, german), (5, german * 300), (6, "²³ ½"), (7, "xqzj wvkq zzxw qqkj " * 30), (7, german)])
    by = [(r.doc_id, r.lang_pred, r.accepted) for r in L.identify(odd, models).collect()]
    assert {x for x in by if x[1] == "und"} == {(1, "und", False), (2, "und", False), (3, "und", False), (6, "und", False)}
    assert (None, "de", True) in by and (5, "de", True) in by and (7, "de", True) in by
    assert any(k == 7 and not ok for k, _, ok in by)
    kept = L.accepted_rows(odd, models)
    assert kept.columns == odd.columns and kept.count() == 3
    assert L.identify(odd.limit(0), models).collect() == []


def test_without_labels_everything_is_unknown(spark, docs_of):
    docs = docs_of([(1, "ein Text"), (2, None)])
    models = L.fit(docs, F.lit(False))
    assert [r.lang_pred for r in L.identify(docs, models).collect()] == ["und", "und"]


def test_every_language_of_the_training_rows_has_a_model(spark, docs_of):
    """However few texts it has, and also where all of them calibrate."""
    stems = {f"l{i}": [chr(0x430 + (i * 5 + k) % 26) + chr(97 + (i * 7 + k * 3) % 26) + "ab"[k % 2] for k in range(9)] for i in range(12)}
    rows = {i: (lang, " ".join(words * 4)) for i, (lang, words) in enumerate(sorted(stems.items()))}
    docs = docs_of([(i, t) for i, (_, t) in rows.items()] + [(50, None), (51, "")], lang={i: lang for i, (lang, _) in rows.items()} | {50: "xx", 51: "yy"})
    models = L.fit(docs, F.lit(True))
    assert models.languages == sorted(stems)
    found = {r.doc_id: r for r in L.identify(docs, models).collect()}
    assert all(found[i].lang_pred == lang and found[i].accepted for i, (lang, _) in rows.items())
    assert L.accepted_rows(docs, models).count() == len(rows)


def test_cross_entropy_as_brute_force():
    """Interpolated Kneser-Ney from its definition, over dictionaries of n-grams."""
    words = L.letter_runs("das alte haus steht an der see und die see rauscht an das haus wo der alte hund am haus schläft " * 3)
    grams = Counter()
    for word in words:
        padded = " " * 4 + word + " "
        grams.update(padded[i : i + 5] for i in range(len(word) + 1))
    names = sorted(grams)
    model = L.KneserNey.fit(names, np.array([grams[g] for g in names]))
    # Counts of the highest order are occurrences, of lower ones the different letters before.
    counts = {5: dict(grams)}
    for n in (4, 3, 2, 1):
        own = Counter(g[1:] for g in counts[n + 1])
        counts[n] = dict(own)

    def probability(gram):
        n = len(gram)
        if n == 0:
            return 1 / L.SYMBOLS
        table, context = counts[n], gram[:-1]
        ones, twos = (sum(c == k for c in table.values()) for k in (1, 2))
        discount = min(max(ones / (ones + 2 * twos), 0.1), 0.95) if ones and twos else 0.5
        after = {g: c for g, c in table.items() if g[:-1] == context}
        if not after:
            return probability(gram[1:])
        total = sum(after.values())
        return max(after.get(gram, 0) - discount, 0) / total + discount * len(after) / total * probability(gram[1:])

    for gram in names[:25] + ["    q", " haub", "xyzab", "hausx"]:
        symbols = np.array([[ord(c) for c in " " + gram]], np.uint64)
        hashes = [L._hash_rows(symbols[:, 6 - k :]) for k in range(1, 6)]
        before = [L._hash_rows(symbols[:, 5 - k : 5]) for k in range(1, 6)]
        assert abs(float(model.score(hashes, before)[0]) - np.log(probability(gram))) < 1e-3, gram
