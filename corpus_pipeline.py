"""Training corpus from raw documents: five stages, each written and read again.

Documents that no language model recognises go; of exact copies and of near
copies one stays; documents that hold benchmark items go; the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormledger.llm import contamination, exact_dedup, language, packing
from stormledger.llm.common import kept
from stormledger.llm.near_copies import one_per_group


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs, language.training_rows())
    return language.in_known_language(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_passages),
    ("best_fit_packing", packed),
]

#: Language models, fingerprints and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
