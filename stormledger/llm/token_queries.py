"""op5: all documents through token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormledger.llm.token_files import through_files


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_files(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
