"""Zone and municipality dimensions and the many-to-many bridge between them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stormledger.contract import CURRENT_MARK
from stormledger.functions import numbers


def municipalities(raw: DataFrame) -> DataFrame:
    """Nested municipality records to flat rows; those without a region parent go."""
    state = "microrregiao.mesorregiao.UF"
    return raw.filter(F.col("microrregiao").isNotNull()).select(
        F.col("id").alias("municipio_ibge"),
        F.col("nome").alias("municipio"),
        F.col(f"{state}.sigla").alias("uf"),
        F.col(f"{state}.nome").alias("uf_nome"),
        F.col(f"{state}.regiao.nome").alias("regiao"),
    )


def bridge_rows(raw: DataFrame) -> DataFrame:
    """Typed bridge rows of the CSV; rows without either key are dropped."""
    return raw.select(
        F.col("IdeConjUnidConsumidoras").cast("int").alias("conjunto"),
        F.col("CodMunicipio").cast("int").alias("municipio_ibge"),
        F.col("NomMunicipio").alias("municipio"),
        F.col("SigUF").alias("uf"),
    ).dropna(subset=["conjunto", "municipio_ibge"])


def links_per_uf(bridge: DataFrame) -> DataFrame:
    return bridge.groupBy("conjunto", "uf").agg(F.count(F.lit(1)).alias("n"))


def majority_uf(bridge: DataFrame) -> DataFrame:
    """The state with most links per zone, ties by name.

    A minimum over (-n, uf) keeps one value per zone and task before the shuffle,
    where a row number would move and sort every count of a zone in one task.
    """
    order = F.struct(-F.col("n"), F.col("uf").isNull(), F.col("uf"))
    return links_per_uf(bridge).groupBy("conjunto").agg(F.min_by("uf", order).alias("uf"))


def clean_bridge(bridge: DataFrame) -> DataFrame:
    """Keep the links of each zone's majority state; the rest are homonyms."""
    return bridge.join(majority_uf(bridge), ["conjunto", "uf"]).select(
        "conjunto", "municipio_ibge", "municipio", "uf"
    )


def dropped_links(bridge: DataFrame) -> DataFrame:
    """How many links the cleaning removes, from the counts alone."""
    per_uf = links_per_uf(bridge)
    total = per_uf.groupBy("conjunto").agg(
        F.sum("n").alias("todos"),
        F.max(F.when(F.col("uf").isNotNull(), F.col("n"))).alias("maior"),
        F.max("n").alias("maior_geral"),
    )
    # A zone whose majority has no state keeps nothing.
    kept = F.when(F.col("maior") == F.col("maior_geral"), F.col("maior")).otherwise(F.lit(0))
    return total.agg(F.coalesce(F.sum(F.col("todos") - kept), F.lit(0)).alias("descartados"))


def name_rows(files: list[DataFrame]) -> DataFrame:
    """(zone, name) of every source file, whichever layout it has."""

    def one(df: DataFrame) -> DataFrame:
        key = (
            "CodConjUnidadeConsumidora"
            if CURRENT_MARK in df.columns
            else "IdeConjuntoUnidadeConsumidora"
        )
        return df.filter(F.col("DscConjuntoUnidadeConsumidora").isNotNull()).select(
            numbers.to_int(df, key).alias("conjunto"),
            F.trim("DscConjuntoUnidadeConsumidora").alias("nome"),
        )

    return reduce(DataFrame.unionByName, map(one, files)).filter(F.col("conjunto").isNotNull())


def zone_names(rows: DataFrame) -> DataFrame:
    """The most frequent name per zone, ties by name."""
    counts = rows.groupBy("conjunto", "nome").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(-F.col("n"), F.col("nome"))
    return counts.groupBy("conjunto").agg(F.min_by("nome", order).alias("nome"))


def zone_dimension(bridge: DataFrame, names: DataFrame) -> DataFrame:
    """One row per zone of the clean bridge: name, state and its municipalities.

    The joined list is the column itself, one value per output row.
    """
    zones = bridge.groupBy("conjunto").agg(
        F.any_value("uf").alias("uf"),
        F.count(F.lit(1)).alias("qtd_municipios"),
        (F.count(F.lit(1)) == 1).alias("municipio_unico"),
        F.min("municipio_ibge").alias("municipio_ibge_unico"),
        F.expr("listagg(municipio, ', ') within group (order by municipio)").alias("municipios"),
    )
    return zones.join(names, "conjunto", "left").select(
        "conjunto", "nome", "uf", "qtd_municipios", "municipio_unico",
        "municipio_ibge_unico", "municipios",
    )
