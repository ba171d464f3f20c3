"""op7: toxicity of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormledger.llm import toxicity
from stormledger.llm.common import crc32_mod


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select("doc_id", (crc32_mod("doc_id", 5) == 0).alias("held_out"), "text")
    return toxicity.toxicity(rows, model).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
