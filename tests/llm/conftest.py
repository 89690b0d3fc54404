import pytest


@pytest.fixture()
def docs_of(spark):
    """Documents with awkward extra columns from (doc_id, text) pairs, dealt over a few partitions."""

    def make(rows, lang=None, source=None, partitions=3):
        full = [(i, t, (lang or {}).get(i, "en"), (source or {}).get(i, "s0"), len(t or ""), "x", 1.5) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, `uid` double"
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make
