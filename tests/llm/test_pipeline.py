from collections import Counter

import corpus_pipeline
from test_exact_dedup import expected
from test_near_duplicates import brute
from test_packing import check_places


def test_stages_against_plain_python(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        rows = [(r.doc_id, r.text) for r in before]
        if name != "pack":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and set(after) <= set(before)
        if name == "language":
            assert len(after) >= 0.97 * len(before)
        if name == "exact_dedup":
            assert sorted(r.doc_id for r in after) == sorted(k for k, keep, _, _ in expected(rows) if k == keep)
        if name == "near_dedup":
            assert sorted(r.doc_id for r in after) == sorted(k for k, _, low in brute(rows) if k == low)
        if name == "mix":
            assert 0.6 * len(before) < len(after) < 1.5 * len(before) and max(Counter(after).values()) > 1
        if name == "pack":
            check_places(rows, after, 2048)
        kept.append(len(after))
    assert corpus_pipeline.run(spark, sf_dir).count() == kept[-1]
