"""The three cubes, as measure rows over the fact or aggregated for storage.

Every panel measure is a sum, so a panel query may read the measure rows of the
fact directly and aggregate once. Aggregating to the cube grain first only pays
when the result is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormledger.config import UNKNOWN_CAUSE
from stormledger.functions import bands, times

MONTHLY_KEYS = ["conjunto", "mes", "causa", "programada", "causa_climatica", "distribuidora"]
MONTHLY_MEASURES = ["interrupcoes", "consumidores", "duracao_total_min", "consumidor_minuto"]
WEEKLY_KEYS = ["conjunto", "ano", "dia_semana", "hora", "causa_climatica"]
DURATION_KEYS = ["conjunto", "ano", "causa_climatica", "faixa_min"]


def monthly_rows(fact: DataFrame, *carried: str) -> DataFrame:
    """Per-row measures; all of them may be summed to any coarser key. ``carried`` columns stay."""
    minutes, customers = F.col("duracao_min"), F.col("consumidores_afetados")
    return fact.select(
        *carried,
        "conjunto",
        times.trunc("month", F.col("inicio")).alias("mes"),
        F.coalesce("causa", F.lit(UNKNOWN_CAUSE)).alias("causa"),
        "programada",
        "causa_climatica",
        "distribuidora",
        F.lit(1).cast("long").alias("interrupcoes"),
        customers.cast("long").alias("consumidores"),
        minutes.alias("duracao_total_min"),
        (minutes * customers).alias("consumidor_minuto"),
    )


def weekly_rows(fact: DataFrame, *carried: str) -> DataFrame:
    return fact.select(
        *carried,
        "conjunto",
        "ano",
        times.weekday(F.col("inicio")).alias("dia_semana"),
        F.hour("inicio").alias("hora"),
        "causa_climatica",
        F.lit(1).cast("long").alias("interrupcoes"),
    )


def duration_rows(fact: DataFrame, *carried: str) -> DataFrame:
    """Ends before starts are left out; all other durations are banded."""
    return fact.filter(F.col("duracao_min") >= 0).select(
        *carried,
        "conjunto",
        "ano",
        "causa_climatica",
        bands.duration_band(F.col("duracao_min")).alias("faixa_min"),
        F.lit(1).cast("long").alias("interrupcoes"),
    )


def monthly_cube(fact: DataFrame) -> DataFrame:
    sums = [F.sum(m).alias(m) for m in MONTHLY_MEASURES]
    return monthly_rows(fact).groupBy(*MONTHLY_KEYS).agg(*sums)


def weekly_cube(fact: DataFrame) -> DataFrame:
    return weekly_rows(fact).groupBy(*WEEKLY_KEYS).agg(F.sum("interrupcoes").alias("interrupcoes"))


def duration_cube(fact: DataFrame) -> DataFrame:
    return (
        duration_rows(fact).groupBy(*DURATION_KEYS).agg(F.sum("interrupcoes").alias("interrupcoes"))
    )


# name -> (stored form, live measure rows, second sort key)
CUBES = {
    "mart_mensal": (monthly_cube, monthly_rows, "mes"),
    "mart_hora_semana": (weekly_cube, weekly_rows, "ano"),
    "mart_duracao": (duration_cube, duration_rows, "ano"),
}


# name -> (measure rows, keys, sums): what cubes of parts of the fact are added up by.
PARTIALS = {
    "mart_mensal": (monthly_rows, MONTHLY_KEYS, MONTHLY_MEASURES),
    "mart_hora_semana": (weekly_rows, WEEKLY_KEYS, ["interrupcoes"]),
    "mart_duracao": (duration_rows, DURATION_KEYS, ["interrupcoes"]),
}


def partial_cube(fact: DataFrame, name: str, part: str) -> DataFrame:
    """The cube of each part of the fact; a part's cube is that of its rows alone."""
    rows, keys, sums = PARTIALS[name]
    return rows(fact, part).groupBy(part, *keys).agg(*[F.sum(m).alias(m) for m in sums])


def merged_cube(partials: DataFrame, name: str) -> DataFrame:
    """The cube of the whole fact from the cubes of its parts, which may share keys."""
    _, keys, sums = PARTIALS[name]
    return partials.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in sums])
