"""Read view of the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stormledger.config import WEATHER_DETAILS
from stormledger.functions import times


def weather_related(detail: Column, details: Sequence[str] = WEATHER_DETAILS) -> Column:
    """True for the listed details, false for others and for null."""
    return F.coalesce(detail.isin(*details), F.lit(False))


def fact_view(stored: DataFrame, details: Sequence[str] = WEATHER_DETAILS) -> DataFrame:
    """Stored offsets back to timestamps, minutes and the weather flag."""
    start, seconds = F.col("inicio_s"), F.col("duracao_s")
    return (
        stored.withColumn("inicio", times.from_epoch(start))
        .withColumn("fim", times.from_epoch(start + seconds))
        .withColumn("duracao_min", seconds / F.lit(60.0))
        .withColumn("causa_climatica", weather_related(F.col("detalhe"), details))
        .drop("inicio_s", "duracao_s")
    )
