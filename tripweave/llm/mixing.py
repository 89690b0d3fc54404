"""Mixing of sources to target weights by Poisson replication, with DataFrame operations only.

Each source has a repetition rate: its share of the target over its size. A document is repeated as often as the inverse
of the Poisson distribution with that mean says at a number in [0, 1) hashed from seed and id, so a run can be repeated, and
another selection of documents leaves the rest as they are. A replica's place in the mix is a hash, too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import blank, staged, unit_hash

#: Largest mean that is inverted in one step; a larger rate is the sum of several equal ones, each with a hash of its own.
STEP_RATE = 16.0
#: The inverse counts up to this number in one step; at STEP_RATE more have a probability below 1e-15.
STEP_MOST = 64
#: Sources up to this number (rows of a name, two numbers and STEP_MOST thresholds: some 10 MB) are sent to every task.
SENT_SOURCES = 10_000
SALTS = 32


def source_sizes(docs: DataFrame, text_col: str, source_col: str) -> DataFrame:
    """(source, size): characters of all texts, and one for the end of each document."""
    size = F.sum(F.char_length(blank(F.col(text_col))) + F.lit(1).cast("long"))
    return docs.groupBy(F.col(source_col).alias("source")).agg(size.alias("size"))


def repetition_rates(sizes: DataFrame, weights: Mapping[str, float] | None, exponent: float, epochs: float) -> DataFrame:
    """(source, rate, steps, thresholds): mean number of replicas and the cumulative distribution of one step."""
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(exponent)))
    else:
        given = sizes.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()] or [(None, 0.0)], "name string, weight double")
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("name")), "left").select("source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    total = weighted.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.col("weight") / F.lit(float(total[1] or 1)) * F.lit(epochs * float(total[0] or 0)) / F.col("size")
    rows = weighted.select("source", rate.alias("rate")).withColumn("steps", F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP_RATE)))
    mean = F.col("rate") / F.col("steps")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))
    grown = F.aggregate(F.sequence(F.lit(1), F.lit(STEP_MOST)), start, lambda s, k: F.struct((s["p"] * mean / k).alias("p"), F.concat(s["sums"], F.array(F.element_at(s["sums"], -1) + s["p"] * mean / k)).alias("sums")))
    return rows.withColumn("thresholds", grown["sums"])


def _count(seed: Column) -> Column:
    """Documents' number of replicas: thresholds at or below the hashed number, added up over the steps."""

    def one(step: Column) -> Column:
        u = unit_hash(seed, step.cast("string"))
        return F.size(F.filter(F.col("thresholds"), lambda t: t <= u))

    return F.when(F.col("steps") == 1, one(F.lit(1))).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("steps")), F.lit(0), lambda n, step: n + one(step)))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, exponent: float = 0.5, epochs: float = 1.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Replicas of documents in mixed order: the columns of `docs`, `replica` (from 1) and `shuffle_key` (long).

    weights: share of the mix by source; a source without one gets no share. None: shares go with size ** exponent.
    epochs: size of the mix as a multiple of all documents. Sizes are characters, so that a source's expected characters
    in the mix are its share of epochs times all characters.
    Replicas are dealt to tasks at random by `shuffle_key` and lie in its order there; order by it for one global order.
    A null source is a source of its own; null or empty texts have size 1; rows that repeat an id get as many replicas as
    each other; columns of `docs` named replica or shuffle_key are replaced. A table without rows gives none.
    """
    kept = [c for c in docs.columns if c.lower() not in ("replica", "shuffle_key")]
    rates = staged(repetition_rates(source_sizes(docs, text_col, source_col), weights, exponent, epochs))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("__row"), F.col(source_col).alias("__source"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("__id"))
    match = F.col("__source").eqNullSafe(F.col("source"))
    if rates.count() <= SENT_SOURCES:
        joined = rows.join(F.broadcast(rates), match)
    else:
        salted = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("__deal", F.pmod(F.xxhash64("__id"), F.lit(SALTS)))
        joined = rows.join(salted, match & (F.col("__deal") == F.col("__salt")))
    counted = joined.select("__row", "__id", _count(F.concat_ws("|", F.lit(seed), "__id")).alias("__n")).filter("__n > 0")
    replicas = counted.select("__row", "__id", F.explode(F.sequence(F.lit(1), "__n")).alias("replica"))
    order = (unit_hash(F.lit(seed), F.lit("order"), F.col("__id"), F.col("replica").cast("string")) * float(1 << 52)).cast("long")
    return replicas.select("__row.*", "replica", order.alias("shuffle_key")).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


#: DuckDB's way to the same rows over a table or subquery {docs}; the numbers are mix()'s defaults.
MIX_SQL = """
WITH RECURSIVE doc AS (SELECT *, coalesce(doc_id::VARCHAR, 'null') AS id FROM {docs}),
size AS (SELECT source, sum(length(coalesce(text, '')) + 1) AS size FROM doc GROUP BY source),
rate AS (SELECT source, pow(size::DOUBLE, 0.5) / (SELECT sum(pow(size::DOUBLE, 0.5)) FROM size) * (SELECT sum(size) FROM size)::DOUBLE / size AS rate FROM size),
step AS (SELECT source, greatest(1, ceil(rate / 16.0))::BIGINT AS steps, rate / greatest(1, ceil(rate / 16.0)) AS mean FROM rate),
sums AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS upto FROM step
  UNION ALL SELECT source, mean, k + 1, p * mean / (k + 1), upto + p * mean / (k + 1) FROM sums WHERE k < 64),
cdf AS (SELECT source, list(upto ORDER BY k) AS thresholds FROM sums GROUP BY source),
counted AS (
  SELECT doc.*, list_sum([len(list_filter(thresholds, lambda t: t <= ('0x' || substr(md5('mix|' || id || '|' || s), 1, 13))::BIGINT / 4503599627370496.0)) FOR s IN range(1, steps + 1)]) AS n
  FROM doc JOIN step ON doc.source IS NOT DISTINCT FROM step.source JOIN cdf ON doc.source IS NOT DISTINCT FROM cdf.source),
replicas AS (SELECT *, unnest(range(1, n::BIGINT + 1)) AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS replica,
  ('0x' || substr(md5('mix|order|' || id || '|' || copy), 1, 13))::BIGINT AS shuffle_key
FROM replicas
"""
