"""Queries opN_<name>: each operator over its whole table, with its production parameters."""

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from escrutinio.llm import (
    alignment,
    curve_packing,
    decontamination,
    exact_dedup,
    language_id,
    lexical_search,
    line_dedup,
    near_dedup,
    pii,
    quality_rules,
    simple8b,
    substring_dedup,
    toxicity,
)
from escrutinio.llm.common import documents, ship, table

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
PII_KEY = "an example key"  # a real one comes from a secret store

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(ship(spark), sf_dir)

    _QUERIES[function.__name__] = shipped
    return shipped


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query
def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = curve_packing.pack(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op3_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = simple8b.write(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
    return simple8b.read(frames).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(documents(spark, sf_dir))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.mark(documents(spark, sf_dir), size=4)


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.predict(docs, language_id.learn(docs))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(documents(spark, sf_dir), PII_KEY)
    counts = [F.element_at("pii", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", "text", *counts)


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(documents(spark, sf_dir))
    return found.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (public_tokenizers.path(name) for name in ALIGNED)
    return alignment.align_documents(documents(spark, sf_dir), first, second)


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(documents(spark, sf_dir))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), k=10)
