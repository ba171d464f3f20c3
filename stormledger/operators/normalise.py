"""Two source layouts to one fact schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stormledger import contract
from stormledger.functions import numbers, text, times


def _code(name: str) -> Column:
    return text.blank_to_null(F.col(name).cast("string"))


def _from_current(df: DataFrame) -> DataFrame:
    level = lambda name: text.canonical(text.plain_upper(F.trim(name)))
    return df.select(
        numbers.to_int(df, "AnoCompetencia").alias("ano"),
        numbers.to_int(df, "CodConjUnidadeConsumidora").alias("conjunto"),
        numbers.to_int(df, "CodMunicipioIBGE").alias("municipio_ibge"),
        F.trim("SigAgente").alias("distribuidora"),
        _code("CodAlimentador").alias("alimentador"),
        _code("CodSubestacao").alias("subestacao"),
        F.col("DatInicioInterrupcao").alias("inicio"),
        F.col("DatFimInterrupcao").alias("fim"),
        level("DscFatoGeradorOrigem").alias("origem"),
        level("DscFatoGeradorTipo").alias("tipo"),
        level("DscFatoGeradorCausa").alias("causa"),
        level("DscFatoGeradorDetalhe").alias("detalhe"),
        _code("DscLocalizacaoInterrupcao").alias("localizacao"),
        _code("DscMotivoExpurgo").alias("motivo_expurgo"),
        numbers.to_int(df, "NumNivelTensao").alias("nivel_tensao"),
        numbers.to_int(df, "QtdConsumidoresAfetados").alias("consumidores_afetados"),
        numbers.to_int(df, "QtdConsumidoresAtivos").alias("consumidores_conjunto"),
    )


def _from_legacy(df: DataFrame) -> DataFrame:
    df = df.withColumn("partes", text.cause_parts(F.col("DscFatoGeradorInterrupcao")))
    parts = F.col("partes")
    return df.select(
        numbers.to_int(df, "NumAno").alias("ano"),
        numbers.to_int(df, "IdeConjuntoUnidadeConsumidora").alias("conjunto"),
        F.lit(None).cast("int").alias("municipio_ibge"),
        F.trim("SigAgente").alias("distribuidora"),
        _code("DscAlimentadorSubestacao").alias("alimentador"),
        _code("DscSubestacaoDistribuicao").alias("subestacao"),
        F.col("DatInicioInterrupcao").alias("inicio"),
        F.col("DatFimInterrupcao").alias("fim"),
        text.cause_level(parts, 1).alias("origem"),
        text.cause_level(parts, 2).alias("tipo"),
        text.cause_level(parts, 3).alias("causa"),
        text.cause_detail(parts).alias("detalhe"),
        F.lit(None).cast("string").alias("localizacao"),
        F.lit(None).cast("string").alias("motivo_expurgo"),
        numbers.to_int(df, "NumNivelTensao").alias("nivel_tensao"),
        numbers.to_int(df, "NumUnidadeConsumidora").alias("consumidores_afetados"),
        numbers.to_int(df, "NumConsumidorConjunto").alias("consumidores_conjunto"),
    )


def normalise(df: DataFrame) -> DataFrame:
    """One source file, either layout, to the stored fact. Rows without a start go."""
    layout = contract.detect_layout(df.columns)
    rows = _from_current(df) if layout == "atual" else _from_legacy(df)
    start, end = F.col("inicio"), F.col("fim")
    return (
        rows.filter(start.isNotNull())
        .withColumn("inicio_s", times.seconds_from_epoch(start))
        .withColumn("duracao_s", times.seconds_between(start, end))
        .withColumn("programada", F.col("tipo").like("PROGRAMADA%"))
        .select(*contract.FACT_COLUMNS)
    )


def union_years(frames: list[DataFrame]) -> DataFrame:
    """Stack year frames by column name; a column some years lack is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
