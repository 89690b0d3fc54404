"""From raw documents to packed training sequences, in five stages that each run on what the one before has kept.

1. language: documents that no learned language accepts go.
2. exact_dedup: of texts equal without white space one stays.
3. near_dedup: of documents that link on word shingles, and what these link with, one stays.
4. mix: documents are repeated to give each source its share of the mix.
5. pack: documents are tokenised, cut and placed into sequences of 2048 ids.

Texts are treated whole, however long. Rows that repeat an id are rows of their own; a table without rows gives none; columns
besides doc_id, text, lang and source may have any names and are handed on by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.llm import exact_dedup, language, mixing, near_duplicates, packing
from tripweave.llm.common import read_table, ship
from tripweave.llm.queries import vocabulary
from tripweave.session import scratch_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts and texts without a letter belong to no language and go; null ids stay."""
    ship(spark)
    return language.accepted_rows(docs, language.fit(docs, ~language.held_out("doc_id", 4, 2)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts count as empty, and all empty ones as one; a null id is larger than any other."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts and texts without words link with nothing and stay; rows are numbered where ids repeat or are null."""
    ship(spark)
    return near_duplicates.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A null source is a source of its own; a row may come several times or not at all."""
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A null or empty text is one piece, its end id; null ids stay null."""
    ship(spark)
    _, places = packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), capacity=2048, end_id=0)
    return places.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]
#: Character models have no SQL form; tests/llm/test_pipeline.py compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{scratch_dir(spark)}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
