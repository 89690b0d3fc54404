import numpy as np

from tripweave.llm import language, toxicity

DATA = "/root/testdata/sf0.1"


def area(labels, scores):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_held_out_rows_and_odd_texts(spark, docs_of):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = toxicity.fit(docs, labels, ~language.held_out("doc_id", 5, 0))
    assert 10 < len(model.features) < 20_000
    held = docs.join(labels.select("doc_id", "toxic"), "doc_id").filter(language.held_out("doc_id", 5, 0))
    found = toxicity.score(held, model).join(held.select("doc_id", "toxic"), "doc_id").toPandas()
    assert area(found.toxic.to_numpy(), found.score.to_numpy()) > 0.95
    assert found.score.between(0, 1).all() and ((found.score >= 0.5) == (found.predicted == 1)).all()
    odd = docs_of([(1, None), (2, ""), (None, "a b"), (4, "word " * 100_000), (5, "same"), (5, "same")])
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 6 and len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert toxicity.score(odd.limit(0), model).collect() == []


def test_few_or_no_labels(spark, docs_of):
    docs = docs_of([(1, "bad word"), (2, "good word")])
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (9, 0)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels.limit(0), ~language.held_out("doc_id", 5, 0)).score([None, "x"]).tolist() == [0.5, 0.5]
    one = toxicity.fit(docs, labels, labels.doc_id.isNotNull() | labels.doc_id.isNull())
    assert one.score(["bad word"])[0] > 0.5


def test_weights_follow_the_update_rule():
    model = toxicity.Ftrl()
    at = np.array([3, 7])
    z, n = np.zeros(2), np.zeros(2)
    bias_z = bias_n = 0.0
    for label in (1, 1, 0, 1):
        w = [0.0 if abs(a) <= toxicity.L1 else -(a - np.sign(a) * toxicity.L1) / ((toxicity.BETA + np.sqrt(b)) / toxicity.ALPHA + toxicity.L2) for a, b in zip(z, n)]
        bw = -bias_z / ((toxicity.BETA + np.sqrt(bias_n)) / toxicity.ALPHA + toxicity.L2)
        g = 1 / (1 + np.exp(-(sum(w) + bw))) - label
        z += [g - (np.sqrt(b + g * g) - np.sqrt(b)) / toxicity.ALPHA * x for b, x in zip(n, w)]
        bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / toxicity.ALPHA * bw
        n += g * g
        bias_n += g * g
        model.learn(at, label)
    assert np.allclose(model.z[at], z) and np.isclose(model.z[model.bias], bias_z)
