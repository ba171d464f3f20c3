"""What the publisher offers against what has been loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stormledger.config import CLIMATE_LATENCY_DAYS, FIRST_YEAR, MAX_PROVISIONAL_DAYS
from stormledger.sources import versions

MANIFEST_COLUMNS = [
    "chave", "url", "last_modified", "size", "hash", "arquivo", "baixado_em", "linhas",
]
MANIFEST_SCHEMA = (
    "chave string, url string, last_modified string, size long, hash string, "
    "arquivo string, baixado_em string, linhas long"
)
MANIFEST = "manifesto"
_YEAR = r"(20\d{2})"


def load_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest last saved below ``root``; empty before the first."""
    path = versions.current(spark, root).get(MANIFEST)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path) if path else spark.createDataFrame([], MANIFEST_SCHEMA)


def save_manifest(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Save as a new version, so a frame that still reads the old one may be saved; returns what was saved."""
    path = versions.save(spark, root, MANIFEST, lambda to: manifest.select(*MANIFEST_COLUMNS).write.parquet(to))
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def pick_resources(resources: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    """One resource per year: Parquet before ZIP, then the first listed.

    ``resources`` has name, format and the listing position ``pos``; other
    columns ride along. A minimum per year combines before the shuffle.
    """
    year = F.regexp_extract("name", _YEAR, 1).try_cast("int")
    kind = F.upper(F.coalesce("format", F.lit("")))
    offered = (
        resources.withColumn("ano", year)
        .withColumn("formato", kind)
        .filter(F.col("formato").isin("PARQUET", "ZIP") & (F.col("ano") >= first_year))
    )
    order = F.struct((F.col("formato") == "ZIP"), F.col("pos"))
    rest = [F.col(c) for c in offered.columns if c != "ano"]
    return (
        offered.groupBy("ano")
        .agg(F.min_by(F.struct(*rest), order).alias("r"))
        .select("ano", "r.*")
    )


def changed(catalog: DataFrame, manifest: DataFrame) -> DataFrame:
    """Catalogue rows with ``mudou``: the hash decides where both sides have one."""
    old = manifest.select(
        "chave",
        F.lit(True).alias("conhecido"),
        F.col("last_modified").alias("lm0"),
        F.col("size").alias("size0"),
        F.col("hash").alias("hash0"),
    )
    text = lambda c: F.coalesce(c, F.lit(""))
    now, before = text(F.col("hash")), text(F.col("hash0"))
    same = F.col("last_modified").eqNullSafe(F.col("lm0")) & F.col("size").eqNullSafe(F.col("size0"))
    verdict = (
        F.when(F.col("conhecido").isNull(), F.lit(True))
        .when((now != "") & (before != ""), now != before)
        .otherwise(~same)
    )
    return (
        catalog.join(old, "chave", "left")
        .withColumn("mudou", verdict)
        .drop("conhecido", "lm0", "size0", "hash0")
    )


def pending_years(
    catalog: DataFrame,
    manifest: DataFrame,
    years: list[int] | None = None,
    present: DataFrame | None = None,
) -> DataFrame:
    """Years to load again: changed at the source, or with no file at hand."""
    wanted = catalog.filter(F.col("ano").isin(*years)) if years else catalog
    todo = changed(wanted, manifest)
    if present is None:
        return todo.filter("mudou").select("ano")
    have = present.select("ano", F.lit(True).alias("presente"))
    return (
        todo.join(have, "ano", "left")
        .filter(F.col("mudou") | F.col("presente").isNull())
        .select("ano")
    )


def latest_publication(catalog: DataFrame) -> DataFrame:
    """Newest publication date, empty text when there is none."""
    stamp = F.coalesce("last_modified", F.lit(""))
    return catalog.agg(F.coalesce(F.max(stamp), F.lit("")).alias("publicado_em"))


def upsert_manifest(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Replace the records of what was just loaded and keep the others."""
    new = loaded.select(
        "chave",
        F.struct(
            *[
                F.nullif("hash", F.lit("")).alias("hash") if c == "hash" else F.col(c)
                for c in MANIFEST_COLUMNS[1:]
            ]
        ).alias("novo"),
    )
    old = manifest.select("chave", F.struct(*MANIFEST_COLUMNS[1:]).alias("velho"))
    return (
        old.join(new, "chave", "full_outer")
        .select("chave", F.coalesce("novo", "velho").alias("r"))
        .select("chave", "r.*")
    )


def months(first: Column, last: Column) -> Column:
    """All month starts from ``first`` to ``last`` as dates."""
    month = lambda c: F.trunc(c.cast("date"), "MM")
    return F.sequence(month(first), month(last), F.expr("interval 1 month"))


def months_to_fetch(
    calendar: DataFrame, present: DataFrame, today: Column, redo_tail: bool = True
) -> DataFrame:
    """Months that are missing, or so young that the source may still revise them."""
    have = present.select("mes").distinct().withColumn("presente", F.lit(True))
    age = F.date_diff(today.cast("date"), F.col("mes"))
    young = (age <= MAX_PROVISIONAL_DAYS) & F.lit(redo_tail)
    return (
        calendar.join(have, "mes", "left")
        .filter(F.col("presente").isNull() | young)
        .select("mes")
    )


def climate_lag(present: DataFrame, now: Column) -> DataFrame:
    """Is the last loaded month behind what is published? Without any month, no."""
    available = F.date_format(F.date_sub(now.cast("date"), CLIMATE_LATENCY_DAYS), "yyyyMM")
    months_seen = present.agg(F.max("competencia").alias("ultimo_mes"))
    return months_seen.select(
        "ultimo_mes",
        available.alias("disponivel_ate"),
        F.coalesce(F.col("ultimo_mes") < available, F.lit(False)).alias("atrasado"),
    )
