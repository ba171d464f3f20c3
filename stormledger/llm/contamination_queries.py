"""op9: documents that hold benchmark items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormledger.llm.contamination import contaminated


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged documents only: one row per document and item it holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, benchmark).selectExpr(
        "id as doc_id", "item_id", "item_windows", "found", "coverage", "slots", "changed_slots"
    )
