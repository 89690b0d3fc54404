"""Registered queries of the operators and the SQL that reaches the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import disclosure, exact_dedup, fertility, language, licenses, mixing, near_duplicates, packing, periodic, secrets, spelling, token_store, toxicity
from tripweave.llm.common import read_table
from tripweave.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; TRIPWEAVE_TOKENIZERS names another folder than the installed package's."""
    folder = os.environ.get("TRIPWEAVE_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read_table(spark, sf_dir, "documents"), scratch_dir(spark)
    token_store.write_store(docs, path, vocabulary("word_bpe_49k.json"), end_id=2)
    read = token_store.read_store(spark, path, docs)
    return read.select(F.col("key").try_cast("long").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fertility.Vocabularies(vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json"))
    return fertility.judge(read_table(spark, sf_dir, "documents"), files)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    _, places = packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), capacity=2048, end_id=0)
    return places.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(read_table(spark, sf_dir, "documents"))


def op6_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.find(read_table(spark, sf_dir, "documents")).drop("base_spans")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    models = language.fit(docs, ~language.held_out("doc_id", 4, 2))
    return language.identify(docs, models).withColumn("held_out", language.held_out("doc_id", 4, 2))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, ~language.held_out("doc_id", 5, 0))
    return toxicity.score(docs, model).withColumn("held_out", language.held_out("doc_id", 5, 0))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.components(read_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.detect(read_table(spark, sf_dir, "documents"), plant=True)


def op12_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(read_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(read_table(spark, sf_dir, "documents"), plant_every=199))


REGISTRY: dict[str, tuple[Query, str | None]] = {
    "op1_token_store": (op1_token_store, None),
    "op2_poisson_mix": (op2_poisson_mix, mixing.MIX_SQL.format(docs="documents")),
    "op3_fertility": (op3_fertility, None),
    "op4_best_fit_packing": (op4_best_fit_packing, None),
    "op5_exact_dedup": (op5_exact_dedup, exact_dedup.DEDUP_SQL),
    "op6_disclosure": (op6_disclosure, None),
    "op7_language_id": (op7_language_id, None),
    "op8_toxicity": (op8_toxicity, None),
    "op9_jaccard_join": (op9_jaccard_join, None),
    "op10_license_scan": (op10_license_scan, licenses.scan_sql()),
    "op11_periodic_runs": (op11_periodic_runs, None),
    "op12_entropy_secrets": (op12_entropy_secrets, secrets.find_sql()),
    "op13_spelling_variants": (op13_spelling_variants, None),
}
