"""op1: all documents packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormledger.llm.packing import best_fit_packing


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return best_fit_packing(docs).withColumnRenamed("id", "doc_id")
