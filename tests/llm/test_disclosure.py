import hashlib
import random
import re

from tripweave.llm import disclosure as D

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
            passes = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")), "card": 13 <= len(digits) <= 19 and total % 10 == 0, "phone": 9 <= len(digits) <= 15}
            if passes[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_patterns_as_plain_regular_expressions():
    rng = random.Random(1)
    parts = ["a", "b.c", "@", "@@", ".", "..", "-", "+", "1", "23", "255", "256", "0007", " ", "(", ")", "4111 1111 1111 1111", "é", "\n", "+49 30 1234567", "x@y.de", "1.2.3.4"]
    for _ in range(30_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert ",".join(f"{D.KINDS[k]}:{a}:{b}" for k, a, b in D.base_spans(text)) == plain(text), text
    for long in ("a" * 300_000, "1" * 300_000, "1 " * 150_000, "@" * 300_000, "a@" * 100_000, "+1" * 100_000, "1." * 150_000):
        D.base_spans(long)


def test_words_that_give_an_entity_away(spark, docs_of):
    fillers = ["nobody came that day", "weather stayed fine and warm", "people talk about many things", "music played outside again", "rivers flow past villages", "trains leave early mornings"]
    rows = [(i, f"{fillers[i % 6]} nothing else {i}") for i in range(60)]
    rows += [(100 + i, f"{fillers[i]} Zorbulon wrote from z@mail.org about {fillers[5 - i]}") for i in range(5)]
    rows += [(200 + i, "one passage Quibble pasted q@mail.org everywhere") for i in range(9)]  # copies are one observation
    rows += [(300, None), (301, ""), (None, "call +49 30 1234567"), (302, "x@y.de"), (302, "x@y.de"), (303, "long text " * 30_000 + "4111 1111 1111 1111")]
    found = D.find(docs_of(rows)).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        assert r.base_spans == plain(texts[r.doc_id]) and r.base_sha256 == hashlib.sha256(r.base_spans.encode()).hexdigest()
        assert r.spans.startswith(r.base_spans)
        terms = [texts[r.doc_id][int(a) : int(b)].lower() for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k in ("remove", "generalise")]
        assert len(terms) == r.n_remove + r.n_generalise
        assert ("zorbulon" in terms) == (r.doc_id in range(100, 105)) and "weather" not in terms
        if r.doc_id in range(200, 209):
            assert "quibble" in terms and r.n_remove == 0
        if r.doc_id in range(100, 105):
            assert r.n_remove >= 1
        if r.doc_id == 101:
            assert "z@mail.org" not in D.sanitised(texts[101], r.spans) and "Zorbulon" not in D.sanitised(texts[101], r.spans)
    assert D.find(docs_of(rows).limit(0)).collect() == []


def marked(found, texts):
    """By document the words marked, in lower case."""
    return {r.doc_id: [texts[r.doc_id][int(a) : int(b)].lower() for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k in ("remove", "generalise")] for r in found}


def test_an_entity_seen_once_or_twice_has_its_words(spark, docs_of):
    rows = [(i, f"nobody came on that day and number {i} stayed") for i in range(600)]
    rows += [(1000, "nobody came but Zorbulon stayed z@mail.org that day"), (1001, "Quibble came q@mail.org"), (1002, "nobody and Quibble stayed q@mail.org")]
    words = marked(D.find(docs_of(rows)).collect(), dict(rows))
    assert "zorbulon" in words[1000] and "quibble" in words[1001] and "quibble" in words[1002]
    assert not {"nobody", "came", "stayed"} & {w for found in words.values() for w in found}


def test_words_far_from_the_entity_and_in_texts_without_it(spark, docs_of):
    far = " and then many other people came to talk about the weather of that long day"
    rows = [(i, f"nobody came but stayed on that day{far} number {i}") for i in range(600)]
    rows += [(1000 + i, f"Zorbulon came{far * 3} and z@mail.org stayed {i}") for i in range(30)]
    rows += [(2000, f"nobody but Zorbulon came{far} and zorbulon stayed")]
    words = marked(D.find(docs_of(rows)).collect(), dict(rows))
    assert all(words[1000 + i] == ["zorbulon"] for i in range(30)) and words[2000] == ["zorbulon", "zorbulon"]
    assert not any(words[i] for i in range(600))


def test_hashes_of_more_words_than_the_arrays_hold_at_first():
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(5000)]
    assert D._Words().terms(words).tolist() == [D.term_hash(w) for w in words]


def test_sanitised_rows(spark):
    rows = spark.createDataFrame([("mail a@b.de now", "email:5:11"), (None, None)], "text string, spans string")
    assert [r.text for r in D.sanitise(rows).collect()] == ["mail [EMAIL] now", ""]


def brute_spans(rows, generalise=0.5, remove=0.8):
    """Added spans by row number, from sets of texts."""
    texts = {t or "" for _, t in rows}
    words_of, entities = {}, {}
    for t in texts:
        spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in plain(t).split(",") if x)]
        clear = "".join(" " if any(a <= i < b for _, a, b in spans) else c for i, c in enumerate(t))
        words_of[t] = [(m.group().lower(), *m.span()) for m in re.finditer(r"[^\W\d_]{3,}", clear)]
        for k, a, b in spans:
            value = t[a:b].lower() if k in ("email", "ip") else re.sub("[^0-9]", "", t[a:b])
            entities.setdefault((k, value), set()).add(t)
    holding = {}
    for t, words in words_of.items():
        for w, *_ in words:
            holding.setdefault(w, set()).add(t)

    def share(k, n):
        centre, spread = (k + 0.5) / (n + 1), (k * (n - k) / n + 0.25) ** 0.5 / (n + 1)
        return centre - spread

    most = {w: max((share(len(own & e), len(own)) for e in entities.values()), default=0) for w, own in holding.items()}
    out = []
    for doc_id, t in rows:
        more = [("remove" if most[w] >= remove - 1e-12 else "generalise", a, b) for w, a, b in words_of[t or ""] if most[w] >= generalise - 1e-12]
        out.append((doc_id, ",".join([x for x in [plain(t)] if x] + [f"{k}:{a}:{b}" for k, a, b in sorted(more)])))
    return sorted(out, key=str)


def test_added_spans_as_brute_force_and_alike_in_a_larger_table(spark, docs_of, monkeypatch):
    rng = random.Random(6)
    people = [(f"Name{chr(97 + i)}qu", f"p{i}@mail.org") for i in range(9)]
    common = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    rows = []
    for i in range(260):
        words = rng.choices(common, k=rng.randint(0, 25))
        for name, address in rng.sample(people, rng.choice([0, 0, 0, 1, 2])):
            words += [name.replace("Name", "Nameß")] * rng.randint(0, 2) + [address] * (rng.random() < 0.8)
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    rows += [(300 + i, f"solo{chr(97 + i)}xyz {common[i]} one{i}@mail.org") for i in range(9)] + [(400, "list of " + " ".join(f"l{i}@mail.org" for i in range(300)))]
    rows += [(i, rows[i][1]) for i in range(20)] + [(None, None), (500, "")]
    wanted = brute_spans(rows)
    assert any("remove" in spans for _, spans in wanted)
    more = [(10_000 + i, f"unrelated talk number {i}") for i in range(1500)]
    for bits, table in ((30, rows), (10, rows), (30, rows + more)):
        monkeypatch.setattr(D, "FILTER_LOG2", bits)
        found = [(r.doc_id, r.spans) for r in D.find(docs_of(table)).collect() if r.doc_id is None or r.doc_id < 10_000]
        assert sorted(found, key=str) == wanted
