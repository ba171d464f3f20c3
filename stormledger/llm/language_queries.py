"""op4: language of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormledger.llm import language


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(docs, language.training_rows())
    rows = docs.select("doc_id", (~language.training_rows()).alias("held_out"), "text")
    return language.identify(rows, model)
