"""op2: SimHash groups of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormledger.llm.simhash import near_groups


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_groups(docs, words_per_shingle=4, radius=4).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
