"""op13: probability of the documents by a lattice of pieces and words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormledger.llm.lattice import held_out, lattice_scores


def op13_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, model = lattice_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scores.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
