"""op8: secrets in the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormledger.llm.secrets import secrets


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("long")
    part = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda c: F.array_join(F.transform(c, part), ",")
    return found.select(
        F.col("id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined("strong"), 256).alias("base_sha256"),
        joined("reported").alias("spans"),
    )
