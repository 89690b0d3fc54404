import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from tripweave.llm import packing
from tripweave.llm.queries import vocabulary

TOKENIZER = vocabulary("byte_bpe_50k.json")


def squares(gaps):
    return sum(n * n for g, n in gaps.items() if g)


def slow_sum_of_squares(lengths, capacity, order):
    """Tries every open gap and a new sequence, counting all squares anew."""
    bins, total, gaps = [], 0, {}
    open_bins = {}
    for i in order:
        size, best = lengths[i], None
        for gap in [capacity, *sorted(g for g, n in gaps.items() if n and g >= size)]:
            after = dict(gaps)
            if gap < capacity:
                after[gap] -= 1
            after[gap - size] = after.get(gap - size, 0) + 1
            found = (squares(after), gap)
            if best is None or found < best:
                best, chosen = found, after
        bins.append(best[1] - size)
        gaps = chosen
    return bins


def test_each_step_leaves_the_smallest_sum():
    rng = random.Random(3)
    for _ in range(30):
        capacity = rng.choice([10, 24])
        lengths = np.array([rng.randint(1, capacity - 1) for _ in range(rng.randint(1, 60))])
        order = np.array(rng.sample(range(len(lengths)), len(lengths)))
        bins, offsets = packing.sum_of_squares(lengths, capacity, order)
        left = [int(capacity - offsets[i] - lengths[i]) for i in order]
        assert left == slow_sum_of_squares(lengths.tolist(), capacity, order.tolist())


def check_places(rows, pieces, capacity):
    library = Tokenizer.from_file(TOKENIZER)
    expected = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((key, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces), key=key) == sorted(expected, key=key)
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_places(spark, docs_of):
    rng = random.Random(4)
    rows = [(i, "word " * rng.randint(0, 90)) for i in range(300)] + [(900, None), (901, ""), (None, "no id"), (902, "many words " * 3000)] + [(903, "again")] * 5
    pieces, places = packing.pack_documents(docs_of(rows), TOKENIZER, capacity=64, group_pieces=100)
    found = places.collect()
    check_places(rows, found, 64)
    whole = packing.sequences(pieces, places).collect()
    assert sum(r.n_tokens for r in whole) == sum(p.length for p in found)
    assert all(len(r.ids) == 2 * r.n_tokens and sum(r.lengths) == r.n_tokens for r in whole)


def test_empty_table(spark, docs_of):
    _, places = packing.pack_documents(docs_of([(1, "a")]).limit(0), TOKENIZER)
    assert places.collect() == []


def test_query_packs_closely(spark):
    from tripweave.llm.queries import op4_best_fit_packing

    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = op4_best_fit_packing(spark, "/root/testdata/sf0.01").collect()
    assert check_places(docs, found, 2048) <= 1.02 * -(-sum(p.length for p in found) // 2048)
