"""Exact deduplication of texts by skew-safe combining, with DataFrame operations only.

Texts are equal when they are identical without white space. A group of equal texts may hold a third of all rows, so it is
combined in three steps that each compare the whole content, not just its digest: every task first reduces its own rows,
then the rows of one digest and salt meet, then the winners of all salts. What meets in the last step is at most one row for
each salt and content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import SPACES, blank, join_counted, staged

SALTS = 16
ROW, NORM, DIGEST, SIZE = "__row", "__norm", "__digest", "__chars"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _prepared(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = blank(F.col(text_col))
    rows = docs.select(F.struct("*").alias(ROW), F.col(id_col).alias("__id"), F.regexp_replace(text, f"[{SPACES}]+", "").alias(NORM), F.char_length(text).alias(SIZE))
    return rows.withColumn(DIGEST, digest(F.col(NORM)))


def _combined(rows: DataFrame, salts: int) -> DataFrame:
    """A row for each different content: what stays (most characters, then smallest id, null last) and the group's size."""
    rank = F.struct((-F.col(SIZE)).alias("chars"), F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"))
    salted = rows.select(DIGEST, NORM, rank.alias("best"), F.pmod(F.xxhash64("__id", F.col(SIZE)), F.lit(salts)).alias("salt"))
    merged = salted.groupBy(DIGEST, "salt", NORM).agg(F.min("best").alias("best"), F.count("*").alias("n"))
    return merged.groupBy(DIGEST, NORM).agg(F.min("best").alias("best"), F.sum("n").alias("group_size"))


def _judged(docs: DataFrame, id_col: str, text_col: str, salts: int, digest) -> DataFrame:
    """Rows with digest, keep_id, group_size and whether they stay."""
    rows = _prepared(docs, id_col, text_col, digest)
    groups = _combined(rows, salts)
    small = staged(groups.drop(NORM))
    # The groups have been told apart by whole contents. Where no two of them share a digest, it names the group.
    shared = not small.groupBy(DIGEST).count().filter("count > 1").isEmpty()
    by = [DIGEST, NORM] if shared else [DIGEST]
    repeated = (groups if shared else small).filter("group_size > 1")
    joined = rows.join(repeated, by, "left") if shared else join_counted(rows, repeated, DIGEST, "group_size")
    joined = joined.withColumns({"keep_id": F.when(F.col("best").isNull(), F.col("__id")).otherwise(F.col("best.id")), "group_size": F.coalesce("group_size", F.lit(1))})
    best = F.col("best").isNull() | (F.col("__id").eqNullSafe(F.col("best.id")) & (-F.col(SIZE) == F.col("best.chars")))
    joined = joined.withColumn("kept", best)
    if docs.groupBy(id_col).count().filter("count > 1").isEmpty():
        return joined
    return _one_of_equals(joined)


def _one_of_equals(joined: DataFrame) -> DataFrame:
    """Where ids repeat, several rows may rank first in a group: keeps one of them, chosen by task first, then over all."""
    tie = F.xxhash64(F.to_json(ROW))
    rows = joined.withColumn("__task", F.spark_partition_id())
    near = Window.partitionBy(DIGEST, NORM, "kept", "__task").orderBy(tie)
    rows = rows.withColumn("kept", F.col("kept") & (F.row_number().over(near) == 1))
    far = Window.partitionBy(DIGEST, NORM, "kept", F.when(~F.col("kept"), F.col("__task"))).orderBy(tie)
    return rows.withColumn("kept", F.col("kept") & (F.row_number().over(far) == 1))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    A null text counts as empty; all empty texts are one group. Of equal texts the row with the most characters stays,
    then the one with the smallest id; a null id is larger than any other. Of rows that agree in id and length too, one
    stays (`kept`). Further columns don't matter. A table without rows gives none.
    digest: what rows are dealt by; the result doesn't depend on it.
    """
    judged = _judged(docs, id_col, text_col, salts, digest)
    sha = F.col(DIGEST) if digest is sha256 else sha256(F.col(NORM))
    return judged.select(F.col("__id").alias("doc_id"), "keep_id", "group_size", "kept", sha.alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=sha256) -> DataFrame:
    """The rows of `docs` that `mark_copies` keeps, with their columns as they are.

    Cases are as there; very long texts are compared whole, and columns may have any names but this module's own.
    """
    return _judged(docs, id_col, text_col, salts, digest).filter("kept").select(f"{ROW}.*")


#: DuckDB's way to the rows of mark_copies(documents).
DEDUP_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""
