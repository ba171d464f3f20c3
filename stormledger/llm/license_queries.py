"""op3: license notices in the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormledger.llm.licenses import scan


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
