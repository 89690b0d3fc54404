import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from tripweave.llm import token_store
from tripweave.llm.perfect_hash import PerfectHash
from tripweave.llm.queries import vocabulary
from tripweave.session import scratch_dir

TOKENIZER = vocabulary("word_bpe_49k.json")


def test_perfect_hash_fills_every_slot_once():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 50, 5000):
        a, b = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, n).astype(np.uint64)
        mph = PerfectHash.build(a, b)
        assert sorted(mph.slots(a, b).tolist()) == list(range(n))
        assert mph.slots(a[:5], b[:5]).tolist() == mph.slots(a, b)[:5].tolist()


def expected_rows(rows):
    library, at, out = Tokenizer.from_file(TOKENIZER), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((None if key is None else str(key), len(ids), np.array(ids, "<u4").tobytes()))
    return out


def stored(spark, docs, keys=None, **settings):
    path = scratch_dir(spark)
    token_store.write_store(docs, path, TOKENIZER, **settings)
    return path, token_store.read_store(spark, path, docs if keys is None else keys).collect()


def test_round_trip_with_nulls_empty_and_long_texts(spark, docs_of):
    rng = random.Random(2)
    rows = [(i * 7 % 101, " ".join(rng.choice(["alpha", "beta,", "Gamma\n", "δέλτα"]) for _ in range(rng.randint(0, 60)))) for i in range(100)]
    rows += [(500, None), (501, ""), (502, "long " * 40_000), (-3, "negative id")]
    _, read = stored(spark, docs_of(rows), shard_ids=2_000, part_keys=16)
    expected = expected_rows(rows)
    assert [(r.key, r.n_tokens, bytes(r.ids)) for r in sorted(read, key=lambda r: r.start)] == expected
    starts = np.cumsum([0] + [n for _, n, _ in expected[:-1]]).tolist()
    assert sorted(r.start for r in read) == starts


def test_repeated_and_null_keys_keep_every_row(spark, docs_of):
    rows = [(7, "same")] * 40 + [(7, f"other {i} " * 20) for i in range(60)] + [(8, "eight"), (None, "no id"), (None, None)]
    _, read = stored(spark, docs_of(rows, partitions=6), shard_ids=100, part_keys=2)
    assert sorted(bytes(r.ids) for r in read) == sorted(ids for _, _, ids in expected_rows(rows))
    assert sum(r.key == "7" for r in read) == 100 and sum(r.key == "\x00" for r in read) == 2
    at = 0
    for r in sorted(read, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_unknown_keys_and_empty_tables(spark, docs_of):
    docs = docs_of([(1, "one"), (2, "two")])
    path, _ = stored(spark, docs)
    asked = docs_of([(2, ""), (2, ""), (99, "")])
    assert [r.key for r in token_store.read_store(spark, path, asked).collect()] == ["2"]
    nothing, read = stored(spark, docs.limit(0))
    assert read == [] and token_store.read_store(spark, nothing, docs).count() == 0


def test_hashes_are_those_of_spark(spark):
    first, second = token_store._hashes(token_store._key("id"))
    for row in spark.createDataFrame([(5,), (-77,), (None,)], "id long").select("id", first.alias("a"), second.alias("b")).collect():
        a, b = token_store.key_hashes(row.id)
        assert (row.a % 2**64, row.b % 2**64) == (a, b)


def test_query_gives_checksums_of_the_library(spark):
    from tripweave.llm.queries import op1_token_store

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    library, at = Tokenizer.from_file(TOKENIZER), 0
    for r in op1_token_store(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect():
        ids = library.encode(docs.pop(r.doc_id), add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not docs


def test_query_with_null_and_awkward_ids(spark, docs_of, tmp_path):
    from tripweave.llm.queries import REGISTRY

    rows = [(None, "no id"), (None, None), (3, "three"), (3, "three again"), (-1, "")]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = REGISTRY["op1_token_store"][0](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in found) == sorted((k is None, k or 0, len(ids) // 4) for k, (_, _, ids) in zip([None, None, -1, 3, 3], expected_rows(rows)))
    keys = spark.createDataFrame([("\x00", "a"), (None, "b c"), ("\x00\x00", "d")], "doc_id string, text string")
    _, read = stored(spark, keys)
    assert len({r.key for r in read}) == 3
