"""Secrets in texts by patterns and by the sliding-window entropy of candidate strings, with DataFrame operations only.

1. One pass over the texts divides each at the places of three patterns and of candidate strings: long stretches of letters,
   digits and key symbols. A text without any of them ends here; of the others only the lengths between and in the places,
   and the candidates, are kept. Running sums of the lengths are the positions.
2. A window of WINDOW characters slides over a candidate. With c places of a character in it, the window's Shannon entropy is
   log2(WINDOW) - sum(c * log2(c)) / WINDOW. The sum is kept up, not worked out anew: a character that enters as the c-th of its
   kind adds f(c) - f(c - 1), one that leaves as one of c takes it away, with f(c) = c * log2(c) in whole millionths, so that the
   running sums are exact. Long candidates are cut into overlapping pieces that are worked on apart.
3. A window belongs to the class `hex` if it has only hexadecimal digits, both letters and numbers among them, or to `key` if it
   has letters, numbers and other than hexadecimal digits; each class has its own least entropy. A candidate's span reaches from
   its first to its last window that is random enough, for each class.
4. Candidates on the allow-list are left out: words and numbers put together, UUIDs, placeholders, digests of nothing.
"""

from __future__ import annotations

from math import floor, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import blank, staged

#: The patterns of the base, with the least length of what counts.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of its characters is one match of the open pattern as well, and no shorter run counts.
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
LEAST_VALUE = 6
WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_key")
#: Least entropy of a window in bits for each character.
LEAST_BITS = {"entropy_hex": 3.0, "entropy_key": 3.7}
#: Windows of a piece: a longer candidate is cut.
PIECE = 32_768
#: What is taken out of a candidate: nothing but separators remains of words and numbers put together.
PLAIN = "[A-Za-z]{4,}|[0-9]+"
UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
PLACEHOLDER = "example|sample|placeholder|changeme|dummy|xxxx|your|0000000|1234567|abcdefg"
#: md5, sha1 and sha256 of no bytes.
DIGESTS_OF_NOTHING = (
    "d41d8cd98f00b204e9800998ecf8427e",
    "da39a3ee5e6b4b0d3255bfef95601890afd80709",
    "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
)


def _weights() -> list[int]:
    """f(c) for c of 0 to WINDOW, in millionths."""
    return [0, *(round(1_000_000 * c * log2(c)) for c in range(1, WINDOW + 1))]


def most_weight(kind: str) -> int:
    """The largest sum of f over a window's characters at which it is random enough."""
    return floor(1_000_000 * WINDOW * (log2(WINDOW) - LEAST_BITS[kind]))


def _divided(text: Column, kind: int, pattern: str, with_body: bool = False, value: int | None = None) -> Column:
    """Of each place of the pattern: characters before it since the last, its own, those of group `value`, and its text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    measured = F.arrays_zip(between.alias("gap"), found.alias("body"), *([F.regexp_extract_all(text, F.lit(pattern), F.lit(value)).alias("value")] if value else []))

    def item(x: Column, at: Column) -> Column:
        body = x["body"] if with_body else F.lit(None).cast("string")
        held = F.char_length(x["value"]) if value else F.lit(None).cast("int")
        return F.struct(F.lit(kind).alias("kind"), at.alias("at"), F.char_length(x["gap"]).alias("gap"), F.char_length(x["body"]).alias("size"), held.alias("held"), body.alias("body"))

    return F.when(text.rlike(pattern), F.transform(measured, item))


def _places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(uid, doc_id, items): a row for each row, with its places of the three patterns and its candidates, null without any."""
    text = blank(F.col("text"))
    parts = {"a": _divided(text, 0, ASSIGN, value=2), "b": _divided(text, 1, ACCESS), "c": _divided(text, 2, HEX), "d": _divided(text, 3, CANDIDATE, with_body=True)}
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", *(part.alias(name) for name, part in parts.items()))
    kinds = F.array_compact(F.array(*parts))
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.when(F.size(kinds) > 0, F.flatten(kinds)).alias("items"))
    return staged(rows)


def _positions(places: DataFrame) -> DataFrame:
    """(uid, kind, start, stop, held, body) of each place."""
    items = places.filter("items is not null").select("uid", F.explode("items").alias("x")).select("uid", "x.*")
    so_far = Window.partitionBy("uid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    items = items.withColumn("stop", F.sum(F.col("gap").cast("long") + F.col("size")).over(so_far))
    return items.select("uid", "kind", (F.col("stop") - F.col("size")).alias("start"), "stop", "held", "body")


def allowed(body: Column) -> Column:
    """Whether a candidate is no secret for its form, however random it looks."""
    plain = ~F.regexp_replace(body, PLAIN, "").rlike("[A-Za-z0-9]")
    return plain | body.rlike(UUID) | F.lower(body).rlike(PLACEHOLDER) | F.lower(body).isin(*DIGESTS_OF_NOTHING)


def random_spans(candidates: DataFrame) -> DataFrame:
    """(uid, kind, start, stop) of candidates (uid, start, body) whose windows are random enough; kind: a number in KINDS."""
    starts = F.sequence(F.lit(0), F.floor((F.char_length("body") - WINDOW) / PIECE).cast("int"))
    pieces = candidates.select("uid", "start", "body", F.explode(starts).alias("piece"))
    pieces = pieces.select("uid", "start", "piece", F.substring("body", F.col("piece") * PIECE + 1, F.lit(PIECE + WINDOW - 1)).alias("part"))
    pieces = pieces.repartition("uid", "start", "piece")
    letters = pieces.select("uid", "start", "piece", F.posexplode(F.split("part", "")).alias("at", "letter")).filter("letter <> ''")

    piece = ("uid", "start", "piece")
    f = F.array(*map(F.lit, _weights()))
    alike = Window.partitionBy(*piece, "letter").orderBy("at")
    entering, leaving = F.count("*").over(alike.rangeBetween(1 - WINDOW, 0)), F.count("*").over(alike.rangeBetween(0, WINDOW - 1))
    counted = letters.select(*piece, "at", "letter", entering.cast("int").alias("entering"), leaving.cast("int").alias("leaving"))
    adds = F.get(f, F.col("entering")) - F.get(f, F.col("entering") - 1)
    takes = F.get(f, F.col("leaving")) - F.get(f, F.col("leaving") - 1)
    ordered = Window.partitionBy(*piece).orderBy("at")
    inside = ordered.rowsBetween(1 - WINDOW, 0)
    hexadecimal, numeral = F.col("letter").rlike("[0-9a-fA-F]").cast("int"), F.col("letter").rlike("[0-9]").cast("int")
    letter = F.col("letter").rlike("[A-Za-z]").cast("int")
    windows = counted.select(
        *piece,
        "at",
        (F.sum(adds).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.coalesce(F.sum(takes).over(ordered.rowsBetween(Window.unboundedPreceding, -WINDOW)), F.lit(0))).alias("weight"),
        F.sum(hexadecimal).over(inside).alias("hexadecimal"),
        F.sum(numeral).over(inside).alias("numerals"),
        F.sum(letter).over(inside).alias("letters"),
    ).filter((F.col("at") >= WINDOW - 1) & (F.col("letters") > 0) & (F.col("numerals") > 0))
    kind = F.when((F.col("hexadecimal") == WINDOW) & (F.col("weight") <= most_weight("entropy_hex")), 3).when((F.col("hexadecimal") < WINDOW) & (F.col("weight") <= most_weight("entropy_key")), 4)
    last = F.col("start") + F.col("piece") * PIECE + F.col("at")
    passed = windows.select("uid", "start", kind.alias("kind"), last.alias("last")).filter("kind is not null")
    spans = passed.groupBy("uid", "start", "kind").agg(F.min("last").alias("first"), F.max("last").alias("last"))
    return spans.select("uid", "kind", (F.col("first") - WINDOW + 1).alias("start"), (F.col("last") + 1).alias("stop"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every whole text, a row for each row of `docs`:

    doc_id, n_assign, n_access, n_hex, base_sha256 (of the base's spans as text), spans (all as text): kind:start:end, ordered
    by start, then kind in the order of KINDS, joined by commas; code points, end exclusive.

    A null text counts as empty. Rows that repeat an id are searched one by one, null ids stay null; further columns don't
    matter; a table without rows gives none. Texts and candidates of any length are searched whole.
    """
    places = _places(docs, id_col, text_col)
    found = _positions(places)
    base = found.filter("kind < 3").filter((F.col("kind") > 0) | (F.col("held") >= LEAST_VALUE)).select("uid", "kind", "start", "stop")
    candidates = found.filter("kind = 3").filter(~allowed(F.col("body"))).select("uid", "start", "body")
    spans = base.unionByName(random_spans(candidates)).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "stop"))).alias("spans"))  # of one text

    names = F.array(*map(F.lit, KINDS))
    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>")

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    some = places.filter("items is not null").select("uid", "doc_id").join(spans, "uid", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
    every = some.unionByName(places.filter("items is null").select("doc_id", none.alias("spans")))
    own = said(F.filter("spans", lambda x: x["kind"] < 3))
    return every.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"), F.sha2(own.cast("binary"), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def find_sql() -> str:
    """DuckDB's way to the rows of find(documents): every window is counted anew."""
    patterns = {0: ASSIGN, 1: ACCESS, 2: HEX, 3: CANDIDATE}
    quoted = {k: p.replace("'", "''") for k, p in patterns.items()}
    divided = "\n  UNION ALL ".join(
        f"SELECT uid, {k} AS kind, unnest(string_split_regex(text, '{p}')) AS gap, unnest(regexp_extract_all(text, '{p}', 0)) AS body, unnest(regexp_extract_all(text, '{p}', {2 if k == 0 else 0})) AS held, unnest(range(length(text) + 1)) AS nth FROM doc WHERE regexp_matches(text, '{p}')"
        for k, p in quoted.items()
    )
    digests = ", ".join(f"'{d}'" for d in DIGESTS_OF_NOTHING)
    return rf"""
WITH doc AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents),
divided AS ({divided}),
place AS (
  SELECT uid, kind, body, held, sum(length(gap) + length(body)) OVER (PARTITION BY uid, kind ORDER BY nth) AS stop FROM divided WHERE body IS NOT NULL),
base AS (SELECT uid, kind, stop - length(body) AS start, stop FROM place WHERE kind < 3 AND (kind > 0 OR length(held) >= {LEAST_VALUE})),
candidate AS (
  SELECT uid, stop - length(body) AS start, body FROM place WHERE kind = 3
    AND regexp_matches(regexp_replace(body, '{PLAIN}', '', 'g'), '[A-Za-z0-9]') AND NOT regexp_matches(body, '{UUID}')
    AND NOT regexp_matches(lower(body), '{PLACEHOLDER}') AND lower(body) NOT IN ({digests})),
slid AS (SELECT uid, start, i, substr(body, i + 1, {WINDOW}) AS part FROM (SELECT *, unnest(range(length(body) - {WINDOW - 1})) AS i FROM candidate)),
weighed AS (
  SELECT uid, start, i, part, list_sum([{_weights()}[length(part) - length(replace(part, c, '')) + 1] FOR c IN list_distinct(string_split(part, ''))]) AS weight
  FROM slid WHERE regexp_matches(part, '[0-9]') AND regexp_matches(part, '[A-Za-z]')),
judged AS (
  SELECT uid, start, i, CASE WHEN regexp_matches(part, '^[0-9a-fA-F]*$') THEN CASE WHEN weight <= {most_weight("entropy_hex")} THEN 3 END
    WHEN weight <= {most_weight("entropy_key")} THEN 4 END AS kind FROM weighed),
added AS (SELECT uid, kind, start + min(i) AS start, start + max(i) + {WINDOW} AS stop FROM judged WHERE kind IS NOT NULL GROUP BY uid, kind, judged.start),
span AS (SELECT uid, kind, start, concat({list(KINDS)}[kind + 1], ':', start, ':', stop) AS said FROM (FROM base UNION ALL SELECT uid, kind, start, stop FROM added)),
told AS (
  SELECT uid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(said, ',' ORDER BY start, kind) AS spans FROM span GROUP BY uid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM doc LEFT JOIN told USING (uid)
"""
