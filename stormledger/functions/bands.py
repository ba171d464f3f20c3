"""Band classification. Every value falls into exactly one band."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stormledger.config import DURATION_STEP, DURATION_TAIL, GUST_BANDS, RAIN_BANDS


def _ladder(value: Column, edges: list[float]) -> Column:
    """Index of the last edge at or below the value, null for a null value."""
    band = F.lit(0)
    case = None
    for i in range(len(edges) - 1, 0, -1):
        hit = value >= F.lit(edges[i])
        case = F.when(hit, F.lit(i)) if case is None else case.when(hit, F.lit(i))
    return F.when(value.isNotNull(), case.otherwise(band))


def rain_band(value: Column, bands=RAIN_BANDS) -> Column:
    """Band 0 is exact zero, band 1 is anything above it; below zero has no band."""
    edges = [edge for _, edge in bands]
    case = F.when(value == 0, F.lit(0))
    for i in range(len(edges) - 1, 1, -1):
        case = case.when(value >= F.lit(edges[i]), F.lit(i))
    return case.when(value > 0, F.lit(1))


def gust_band(value: Column, bands=GUST_BANDS) -> Column:
    return _ladder(value, [edge for _, edge in bands])


def band_label(band: Column, bands) -> Column:
    return F.get(F.array(*[F.lit(label) for label, _ in bands]), band)


def duration_band(minutes: Column) -> Column:
    """15-minute floors below 12 hours, then the three wide bands."""
    first, second, third = DURATION_TAIL
    return (
        F.when(minutes < first, F.floor(minutes / DURATION_STEP) * F.lit(DURATION_STEP))
        .when(minutes < second, F.lit(first))
        .when(minutes < third, F.lit(second))
        .otherwise(F.lit(third))
        .cast("double")
    )
