"""Tables that are replaced while others read them.

New versions go to folders of their own and become current by rows appended to
the log in one write, so a reader sees all old tables or all new ones, never a
mixture. Readers of an older version keep it until ``prune`` removes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stormledger.sources import files

LOG = "versoes"
LOG_SCHEMA = "tabela string, versao string, publicado_em timestamp_ntz"


def save_all(spark: SparkSession, root: str, tables: dict[str, Callable[[str], None]]) -> dict[str, str]:
    """Each function fills the folder it is given; all tables switch together when the last is done."""
    version = uuid.uuid4().hex
    paths = {name: f"{root}/{name}/{version}" for name in tables}
    for name, write in tables.items():
        write(paths[name])
    names = spark.createDataFrame([(name, version) for name in tables], "tabela string, versao string").coalesce(1)
    entry = names.withColumn("publicado_em", F.current_timestamp().cast("timestamp_ntz"))
    entry.write.mode("append").parquet(f"{root}/{LOG}")
    return paths


def save(spark: SparkSession, root: str, name: str, write: Callable[[str], None]) -> str:
    """One table; it is current once ``write`` has filled the folder."""
    return save_all(spark, root, {name: write})[name]


def _log(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/{LOG}"
    if not files.exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """When each current table was published; one row per table, as text that sorts."""
    latest = _log(spark, root).groupBy("tabela").agg(F.max("publicado_em").cast("string").alias("quando"))
    return {r.tabela: r.quando for r in latest.collect()}


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders of all but the last ``keep`` versions of each table; returns them.

    The log is small: a row per table and publication. Run it when no reader of
    an older version is left.
    """
    newest = Window.partitionBy("tabela").orderBy(F.desc("publicado_em"), F.desc("versao"))
    old = _log(spark, root).withColumn("k", F.row_number().over(newest)).filter(F.col("k") > keep)
    paths = [f"{root}/{r.tabela}/{r.versao}" for r in old.collect()]
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        at = hadoop.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return sorted(paths)


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """Current folder of every table, one row per table."""
    latest = _log(spark, root).groupBy("tabela").agg(F.max_by("versao", F.struct("publicado_em", "versao")).alias("versao"))
    return {r.tabela: f"{root}/{r.tabela}/{r.versao}" for r in latest.collect()}
