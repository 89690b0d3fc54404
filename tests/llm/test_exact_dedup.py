import hashlib
import random
import re

from pyspark.sql import functions as F

from tripweave.llm.exact_dedup import drop_copies, mark_copies


def expected(rows):
    norm = lambda t: re.sub(r"[ \t-\r]", "", t or "")
    best, size = {}, {}
    for key, text in rows:
        rank = (-len(text or ""), key is None, key or 0)
        best[norm(text)] = min(best.get(norm(text), rank), rank)
        size[norm(text)] = size.get(norm(text), 0) + 1
    out = []
    for key, text in rows:
        chars, no_id, low = best[norm(text)]
        out.append((key, None if no_id else low, size[norm(text)], hashlib.sha256(norm(text).encode()).hexdigest()))
    return out


def rows_with_copies():
    rng = random.Random(1)
    texts = ["", None, " \n\t", "a b", "ab ", "a\x0bb", "é è", "x y", "long " * 9000]
    rows = [(i, rng.choice(texts)) for i in range(200)]
    return rows + [(1000 + i, "hot  copy" if i % 2 else "hot copy") for i in range(300)]


def key(row):
    return tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in row)


def test_marks_as_brute_force_with_a_weak_digest_too(spark, docs_of):
    rows = rows_with_copies()
    for digest in (None, lambda text: F.substring(F.sha2(text.cast("binary"), 256), 1, 1)):
        settings = {} if digest is None else {"digest": digest}
        found = mark_copies(docs_of(rows), salts=4, **settings).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=key) == sorted(expected(rows), key=key)
        assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_one_row_stays_also_where_ids_repeat(spark, docs_of):
    rows = [(1, "same text")] * 50 + [(1, "same  text"), (2, "sametext"), (None, "other"), (None, "other"), (None, "oth er")]
    found = mark_copies(docs_of(rows)).collect()
    assert sum(r.kept for r in found) == 2
    stays = drop_copies(docs_of(rows))
    assert stays.columns == docs_of(rows).columns
    assert sorted(r.text for r in stays.collect()) == ["oth er", "same  text"]


def test_empty_table(spark, docs_of):
    none = docs_of([(1, "a")]).limit(0)
    assert mark_copies(none).collect() == [] and drop_copies(none).collect() == []
