import math
from collections import Counter

from tripweave.llm.mixing import mix


def poisson_inverse(u, mean):
    k, p, total = 0, math.exp(-mean), math.exp(-mean)
    while total <= u:
        k += 1
        p *= mean / k
        total += p
    return k


def test_counts_follow_the_rates_and_repeat(spark, docs_of):
    sources = {i: ("hot" if i % 3 else f"s{i % 4}") for i in range(3000)}
    docs = docs_of([(i, "x" * 9) for i in range(3000)], source=sources)
    found = mix(docs, weights={"hot": 1.0, "s0": 1.0, "s1": 2.0}).collect()
    counts, size = Counter(r.source for r in found), Counter(sources.values())
    assert set(counts) == {"hot", "s0", "s1"}  # sources without a weight have no share
    for source, share in (("hot", 0.25), ("s0", 0.25), ("s1", 0.5)):
        assert abs(counts[source] - 3000 * share) < 6 * math.sqrt(3000 * share * (1 + 3000 * share / size[source]))
    again = mix(docs, weights={"hot": 1.0, "s0": 1.0, "s1": 2.0}).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    one = Counter(Counter(r.doc_id for r in found if r.source == "hot").values())
    assert one[1] > one[2] > one[3]


def test_a_rate_of_many_steps(spark, docs_of):
    docs = docs_of([(i, "abc") for i in range(60)], source={i: "tiny" if i < 2 else "big" for i in range(60)})
    found = Counter(r.source for r in mix(docs, weights={"tiny": 1.0}, epochs=3.0).collect())
    assert set(found) == {"tiny"} and abs(found["tiny"] - 180) < 80


def test_nulls_ties_clashing_names_and_no_rows(spark, docs_of):
    docs = docs_of([(None, None), (1, ""), (1, "same"), (1, "same")], source={1: None}).withColumnRenamed("kept", "replica")
    found = mix(docs, epochs=20.0)
    assert found.columns == [c for c in docs.columns if c != "replica"] + ["replica", "shuffle_key"]
    rows = found.collect()
    assert len({r.shuffle_key for r in rows if r.doc_id is None}) == sum(r.doc_id is None for r in rows) > 0
    assert mix(docs.limit(0)).collect() == []


def test_inverse_is_that_of_the_distribution(spark, docs_of):
    import hashlib

    docs = docs_of([(i, "abcd") for i in range(200)])
    found = Counter(r.doc_id for r in mix(docs, epochs=2.0).collect())
    for i in range(200):
        u = int(hashlib.md5(f"mix|{i}|1".encode()).hexdigest()[:13], 16) / 2**52
        assert found[i] == poisson_inverse(u, 2.0)
