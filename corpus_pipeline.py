"""A training corpus from ``documents``, in five stages of the operators.

Each stage takes what its predecessor kept, written as Parquet and read again. The first
four return the columns of ``documents``; the last returns pieces of packed sequences.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from escrutinio.llm import curve_packing, decontamination, exact_dedup, language_id, near_dedup
from escrutinio.llm.common import ship, table, written

VOCABULARY = "word_bpe_49k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a determined language: null texts and those without a letter."""
    return language_id.keep_known(docs, language_id.learn(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = curve_packing.pack(docs, public_tokenizers.path(VOCABULARY))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


def _shipping(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(ship(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", _shipping(known_language)),
    ("exact_dedup", _shipping(exact)),
    ("near_dedup", _shipping(near)),
    ("decontamination", _shipping(decontaminated)),
    ("packing", _shipping(packed)),
]

#: SQL can express neither the classifier nor signatures nor tiles; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
