import random
import re

import duckdb

from tripweave.llm import licenses as L


def brute(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = {label: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p, label in L.PHRASES.items()}
    every = sorted(i for at in places.values() for i in at)
    base = sorted(label for label, at in places.items() if at)
    share, labels = 0.0, set(base)
    blocks = [(0, b) for b in re.split(L.SENTENCE_END, text)] + [(1, b) for b in re.split(L.PARAGRAPH_END, text)]
    for kind, block in blocks:
        bag = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", block))
        for label, templates in L.TEMPLATES.items():
            for template in templates:
                own = set(template.split())
                if (kind == 0 or len(own) >= L.PARAGRAPH_WORDS) and len(bag & own) >= L.THRESHOLD * len(own) - 1e-9:
                    labels.add(label)
                    share = max(share, len(bag & own) / len(own))
    return (len(words), len(every), every[0] if every else None, every[-1] if every else None, ",".join(base), ",".join(sorted(labels)), 1.0 if every else share)


def test_as_brute_force(spark, docs_of):
    rng = random.Random(1)
    vocabulary = sorted({w for ts in L.TEMPLATES.values() for t in ts for w in t.split()}) + ["MIT", "License", "Apache", "general public", "mit license", "Ä", "x", "K"]
    rows = []
    for i in range(250):
        parts = []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.5:
                words = rng.choice(L.TEMPLATES[rng.choice(sorted(L.TEMPLATES))]).split()
                words = [w for w in words if rng.random() < 0.9]
            else:
                words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 25))]
            parts.append(rng.choice([" ", "-", "\n"]).join(words) if rng.random() < 0.2 else " ".join(words))
        rows.append((i, rng.choice([". ", "\n", "\n \n", " "]).join(parts)))
    rows += [(900, None), (901, ""), (None, "MIT License mit license"), (902, "mit-license"), (902, "mit-license"), (903, "plain words " * 50_000 + "Apache License")]
    texts = {}
    for key, text in rows:
        texts.setdefault(key, text)
    found = L.scan(docs_of(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        n_words, n_base, first, last, base, labels, score = brute(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (n_words, n_base, first, last, base, labels)
        assert abs(r.score - score) < 1e-9
    assert L.scan(docs_of(rows).limit(0)).collect() == []
    documents = docs_of([r for r in rows if r[0] != 903]).select("doc_id", "text").toArrow()  # noqa: F841
    by_sql = duckdb.sql(L.scan_sql()).fetchall()  # slow over very long texts
    assert sorted(map(str, by_sql)) == sorted(str(tuple(r)) for r in found if r.doc_id != 903)


def test_notices_over_line_ends(spark, docs_of):
    rows = [
        (1, "Licensed under CC\nBY-NC 4.0."),
        (2, "Licensed under CC BY-NC 4.0."),
        (3, "Some words.\nReleased under\n  the MIT\nLicense. More words"),
        (4, "licensed\n\nunder cc\n \nby nc 4 0"),
        (5, "This is free and unencumbered software\nreleased into the public domain."),
        (6, "If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ]
    found = {r.doc_id: r for r in L.scan(docs_of(rows)).collect()}
    assert [found[i].labels for i in range(1, 7)] == ["cc", "cc", "mit", "", "unlicense", "mpl"]
    assert found[1].score == found[2].score == 1.0 and found[4].score == 0.0
    for r in found.values():
        assert (r.labels, round(r.score, 9)) == (brute(dict(rows)[r.doc_id])[5], round(brute(dict(rows)[r.doc_id])[6], 9))
