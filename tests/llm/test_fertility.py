import math
import random
import re
from collections import Counter

import sentencepiece
from tokenizers import Tokenizer

from tripweave.llm import fertility
from tripweave.llm.queries import vocabulary

FILES = fertility.Vocabularies(vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json"))


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    pieces = sentencepiece.SentencePieceProcessor(model_file=FILES.pieces)
    bpe = Tokenizer.from_file(FILES.bpe)
    ids = [i for w in words for i in pieces.encode(w)]
    n_bpe = sum(len(bpe.encode(" " + w, add_special_tokens=False).ids) for w in words)
    chars = sum(map(len, words))
    entropy = -sum(c / len(ids) * math.log(c / len(ids)) for c in Counter(ids).values()) / math.log(len(ids)) if len(ids) > 1 else 0.0
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    base = (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)
    return base, (chars / max(len(ids), 1), chars / max(n_bpe, 1), sum(map(pieces.is_byte, ids)) / max(len(ids), 1), entropy)


def texts():
    rng = random.Random(1)
    vocabulary_ = ["the", "House", "Straße,", "a|b", "***", "\U0001f600", "δοκιμή", "x<y>"]
    out = [None, "", " \n\t ", "one", "a a a a a a", "l1\nl1\n \nl1", "a\x1cb c", "word " * 30_000]
    return out + [" ".join(rng.choice(vocabulary_) + rng.choice(["", "\n", "\t"]) for _ in range(rng.randint(0, 120))) for _ in range(60)]


def test_counts_and_figures_as_brute_force(spark, docs_of):
    rows = list(enumerate(texts()))
    by = {r.doc_id: r for r in fertility.measure(docs_of(rows), FILES).collect()}
    for i, text in rows:
        r, (base, figures) = by[i], brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base
        for found, true in zip((r.chars_per_piece, r.chars_per_bpe, r.byte_share, r.entropy), figures):
            assert abs(found - true) < 0.0011


def test_bands_reject_the_odd_text_and_keep_the_rest(spark, docs_of):
    rng = random.Random(2)
    words = "there is a house in the city where people read books about other people and old towns every day".split()
    rows = [(i, " ".join(rng.choice(words) + str(rng.randint(0, 9)) for _ in range(rng.randint(60, 150)))) for i in range(300)]
    odd = " ".join("".join(rng.choice("qxzjkvwQXZJK0") for _ in range(9)) for _ in range(80))
    rows += [(900, odd), (901, None), (None, rows[0][1]), (902, rows[1][1]), (902, rows[1][1])]
    found = fertility.judge(docs_of(rows), FILES).collect()
    assert len(found) == len(rows)
    assert sorted(str(r.doc_id) for r in found if not r.kept) == ["900", "901"]
    assert fertility.judge(docs_of(rows).limit(0), FILES).collect() == []


def test_a_script_is_judged_alike_however_many_texts_it_has(spark, docs_of):
    rng = random.Random(3)
    latin = "there is a house in the city where people read books about other people and old towns every day".split()
    greek = "όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα είναι προικισμένοι με λογική".split()
    some = lambda words: " ".join(rng.choice(words) for _ in range(rng.randint(60, 150)))
    latin_rows, greek_rows = [(i, some(latin)) for i in range(150)], [(1000 + i, some(greek)) for i in range(230)]
    for n in (1, 2, 3, 199, 230):
        found = fertility.judge(docs_of(latin_rows + greek_rows[:n]), FILES).collect()
        assert all(r.kept for r in found) and len(found) == 150 + n


def test_kept_as_brute_force(spark, docs_of):
    """Bands worked out with Python's own median."""
    from statistics import median

    rows = [(i, t) for i, t in enumerate(texts() * 3)]
    found = fertility.judge(docs_of(rows), FILES).collect()
    bands = {}
    for script in {r.script for r in found}:
        good = [r for r in found if r.script == script and not r.base_failed]
        for c, least in fertility.FIGURES.items():
            mid = median(r[c] for r in good) if good else 0
            away = median(round(abs(r[c] - mid), 3) for r in good) if good else 0
            half = max(least, fertility.DEVIATIONS * away)
            bands[script, c] = (mid - half, mid + half)
    for r in found:
        inside = all(bands[r.script, c][0] - 1e-9 <= r[c] <= bands[r.script, c][1] + 1e-9 for c in fertility.FIGURES)
        assert r.kept == (not r.base_failed and inside)
    assert {r.kept for r in found} == {True, False}
