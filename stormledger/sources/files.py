"""Readers and writers of the published files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from stormledger import contract

# Year files are named like this one; the layer below partitions by that year.
YEAR_IN_NAME = r"interrupcoes-(\d{4})"
ZSTD_LEVEL = "9"
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared storage that ``spark.checkpoint.dir`` names.

    A cluster must name one, since executors do not see each other's disks. Only
    a session on one machine, as in tests, gets a folder of its own, once.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stormledger-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """True when Spark can read a Parquet schema at the path (footers only)."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


# --- readers --------------------------------------------------------------------


def parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet by path, columns united by name over files that differ."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def stored_fact(spark: SparkSession, path: str) -> DataFrame:
    """The curated fact by its contract: no footers are read or merged.

    Columns are found by name, and one that an older file lacks is null there.
    The folder year is added by partition discovery.
    """
    return spark.read.schema(contract.FACT_SCHEMA).parquet(path)


def columns(spark: SparkSession, path: str) -> list[str]:
    return spark.read.parquet(path).columns


def file_year() -> Column:
    """Year of the source file, from its name."""
    return F.regexp_extract(F.col("_metadata.file_path"), YEAR_IN_NAME, 1).try_cast("int")


def bridge_csv(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated, Latin-1, with a header; all text, cast later."""
    return spark.read.csv(
        path, sep=";", header=True, encoding="ISO-8859-1", schema=contract.BRIDGE_CSV_SCHEMA
    )


def municipalities_json(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    reader = spark.read.schema(contract.MUNICIPALITY_JSON_SCHEMA)
    return reader.json(path, multiLine=multiline)


def geojson(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """FeatureCollections, one row per document."""
    return spark.read.schema(contract.GEOJSON_SCHEMA).json(path, multiLine=multiline)


# --- writers --------------------------------------------------------------------


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What ends in here leaves no shuffle files behind.

    Otherwise they stay until the driver happens to collect its garbage, and the
    steps of a cycle pile theirs up. A frame that is run once more makes its own anew.
    """
    before = spark.conf.get(_TIDY)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(_TIDY, before)


def _write(df: DataFrame, path: str, mode: str, measures: dict[str, Column] | None, periods: str | None = None) -> dict[str, int]:
    """Write and return ``linhas``, the number of rows, with any further aggregates over them.

    They are gathered by the job that writes, after all shuffles, so the table is
    not read again to be counted.
    """
    seen = Observation(f"write-{uuid.uuid4().hex}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("linhas"), *[c.alias(name) for name, c in (measures or {}).items()])
    writer = counted.write.mode(mode).option("compression", "zstd").option("parquet.compression.codec.zstd.level", ZSTD_LEVEL)
    if periods:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(periods)
    with tidy(df.sparkSession):
        writer.parquet(path)
    return seen.get


def write_sorted(df: DataFrame, path: str, keys: list[str], mode: str = "overwrite", measures: dict[str, Column] | None = None) -> dict[str, int]:
    """Range-partition by the sort keys, sort inside, write.

    Every key takes part in the ranges, so one zone with a third of the rows is
    cut along its second key instead of landing in one file.
    """
    return _write(df.repartitionByRange(*keys).sortWithinPartitions(*keys), path, mode, measures)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", measures: dict[str, Column] | None = None) -> dict[str, int]:
    return _write(df, path, mode, measures)


def write_fact(df: DataFrame, path: str, year: str = "ano_arquivo", measures: dict[str, Column] | None = None) -> dict[str, int]:
    """Stored fact, one folder per source year, sorted for compression.

    Ranges over (year, zone, start): a task meets one year or two, so there are
    about as many files as tasks, each with zones of its own, and a zone with a
    third of the rows is cut along time. Only the years present in ``df`` are
    replaced. The folder key is the year of the source file, so the year the
    data claims stays a column of its own.
    """
    return write_periods(df, path, year, ["conjunto", "inicio_s"], measures)


def write_periods(df: DataFrame, path: str, period: str, keys: list[str], measures: dict[str, Column] | None = None) -> dict[str, int]:
    """Replace the periods present in ``df``, sorted by the keys inside each."""
    order = [period, *keys]
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return _write(spread, path, "overwrite", measures, period)


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int, measures: dict[str, Column] | None = None) -> dict[str, int]:
    """A table of the catalogue, dealt and sorted by its keys where it is stored.

    A join or an aggregate by the keys reads it as it lies; only the other side
    moves, into as many parts. Tables with equal buckets do not move at all.
    Buckets should be no fewer than the session's shuffle partitions, or Spark
    may rather deal both sides anew.
    """
    seen = Observation(f"write-{uuid.uuid4().hex}")
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    counted = dealt.observe(seen, F.count(F.lit(1)).alias("linhas"), *[c.alias(name) for name, c in (measures or {}).items()])
    writer = counted.write.mode("overwrite").format("parquet").option("path", path).option("compression", "zstd")
    with tidy(df.sparkSession):
        writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return seen.get


def file_metrics(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """Rows, bytes, files and bytes per row of a written table."""
    keys = by or []
    files = (
        spark.read.parquet(path)
        .groupBy(*keys, "_metadata.file_path", "_metadata.file_size")
        .agg(F.count(F.lit(1)).alias("linhas"))
    )
    return files.groupBy(*keys).agg(
        F.sum("linhas").alias("linhas"),
        F.sum("file_size").alias("bytes"),
        F.count(F.lit(1)).alias("arquivos"),
        (F.sum("file_size") / F.sum("linhas")).alias("bytes_por_linha"),
    )


def stored_bytes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes and files of a written table, from the listing of its folder alone."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    total = listed.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("arquivos")).first()
    return {"bytes": total.bytes, "arquivos": total.arquivos}


def period_bytes(spark: SparkSession, path: str, period: str) -> dict[str, int]:
    """Bytes of each period's Parquet files, from the listing alone; ``period`` is a pattern with one group."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    sizes = listed.groupBy(F.regexp_extract("path", period, 1).alias("competencia")).agg(F.sum("length").alias("bytes"))
    return {r.competencia: r.bytes for r in sizes.collect()}  # one row per period


def stale_outputs(inputs: DataFrame, outputs: DataFrame, key: str = "competencia") -> DataFrame:
    """Periods whose output is missing or older than its input.

    Both sides are (key, modified); a period may have many files.
    """
    newest = inputs.groupBy(key).agg(F.max("modificado").alias("entrada"))
    oldest = outputs.groupBy(key).agg(F.min("modificado").alias("saida"))
    out = F.col("saida")
    return (
        newest.join(oldest, key, "left")
        .filter(out.isNull() | (F.col("entrada") > out))
        .select(key)
    )


def modification_times(spark: SparkSession, path: str, period: str) -> DataFrame:
    """(competencia, modificado) per file; ``period`` is a pattern with one group.

    A folder that is not there yet has no files.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = listing.load(path).select("path", "modificationTime")
    except AnalysisException:
        return spark.createDataFrame([], "competencia string, modificado timestamp")
    return files.select(
        F.regexp_extract("path", period, 1).alias("competencia"),
        F.col("modificationTime").alias("modificado"),
    )
