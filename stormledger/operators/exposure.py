"""Event rates by exposure and around storm onsets.

``clima`` is the dense zone-hour table (hundredths, UTC hours), ``fact`` the read
view (local wall time). Quiet hours stay in every denominator.
"""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormledger.config import (
    CLIMATE_SCALE,
    GUST_BANDS,
    RAIN_BANDS,
    STORM_MM,
    STORM_QUIET_H,
    STORM_WINDOW_H,
)
from stormledger.functions import bands, numbers, times
from stormledger.operators.filters import Filtro, Lookups

_KEY = ["conjunto", "instante_utc"]


def hourly_counts(fact: DataFrame, f: Filtro, lookups: Lookups) -> DataFrame:
    """Interruptions per zone and UTC hour, for zones the dimension knows.

    Rows are counted before the zone joins, so those see one row per zone-hour.
    """
    counts = (
        f.rows(fact)
        .groupBy(
            "conjunto",
            times.trunc("hour", times.local_to_utc(F.col("inicio"))).alias("instante_utc"),
        )
        .agg(F.count(F.lit(1)).alias("interrupcoes"))
    )
    known = counts.join(lookups.dim_conjunto.select("conjunto"), "conjunto", "left_semi")
    return f.places(known, lookups)


def exposure_base(
    clima: DataFrame, counts: DataFrame, clip: Filtro | None = None
) -> DataFrame:
    """Every zone-hour with its weather and its count, zero where nothing happened.

    A period filter narrows the interruptions only and leaves the hours whole;
    pass ``clip`` to cut the hours to the same years.
    """
    if clip is not None:
        year = F.year(F.from_utc_timestamp(F.col("instante_utc").cast("timestamp"), times.TIME_ZONE))
        clima = clima.withColumn("ano", year).filter(clip.period(clima.select(year.alias("ano")))).drop("ano")
    scale = F.lit(float(CLIMATE_SCALE))
    return clima.join(counts, _KEY, "left").select(
        *_KEY,
        (F.col("chuva_c") / scale).alias("chuva"),
        (F.col("rajada_c") / scale).alias("rajada"),
        F.coalesce("interrupcoes", F.lit(0)).alias("interrupcoes"),
        times.local_hour(F.col("instante_utc")).alias("hora_local"),
        F.month("instante_utc").alias("mes"),
    )


def _rate() -> list[Column]:
    n = F.sum("interrupcoes")
    return [
        F.count(F.lit(1)).alias("conjunto_horas"),
        n.alias("interrupcoes"),
        (n / F.count(F.lit(1))).alias("taxa"),
    ]


def _curve(base: DataFrame, band: Column, scheme) -> DataFrame:
    return (
        base.select(band.alias("faixa_id"), "interrupcoes")
        .filter(F.col("faixa_id").isNotNull())
        .groupBy("faixa_id")
        .agg(*_rate())
        .select(
            bands.band_label(F.col("faixa_id"), scheme).alias("faixa"),
            "faixa_id",
            "conjunto_horas",
            "interrupcoes",
            "taxa",
        )
        .orderBy("faixa_id")
    )


def rain_risk(base: DataFrame, scheme=RAIN_BANDS) -> DataFrame:
    return _curve(base, bands.rain_band(F.col("chuva"), scheme), scheme)


def gust_risk(base: DataFrame, scheme=GUST_BANDS) -> DataFrame:
    return _curve(base, bands.gust_band(F.col("rajada"), scheme), scheme)


def heavy_hours(clima: DataFrame, threshold: float = STORM_MM) -> DataFrame:
    """Rainy hours by the stored integer, so the condition reaches the file scan.

    The bound is the least whole hundredth at or above the threshold as it is
    written: 1.1 mm is 110, not a hair more.
    """
    least = (Decimal(str(threshold)) * CLIMATE_SCALE).to_integral_value(ROUND_CEILING)
    return clima.filter(F.col("chuva_c") >= F.lit(int(least))).select(*_KEY)


def storm_onsets(
    clima: DataFrame, threshold: float = STORM_MM, quiet_hours: int = STORM_QUIET_H
) -> DataFrame:
    """Heavy hours with no heavy hour in the ``quiet_hours`` before them.

    Each heavy hour blocks the hours after it, and an anti-join on (zone, hour)
    removes what is blocked. Only heavy hours move, and no zone is one group.
    """
    heavy = heavy_hours(clima, threshold)
    blocked = heavy.select(
        "conjunto",
        F.explode(F.sequence(F.lit(1), F.lit(quiet_hours))).alias("depois"),
        "instante_utc",
    ).select("conjunto", times.add_hours(F.col("instante_utc"), F.col("depois")).alias("instante_utc"))
    return heavy.join(blocked, _KEY, "left_anti")


def storm_onsets_windowed(
    clima: DataFrame,
    threshold: float = STORM_MM,
    quiet_hours: int = STORM_QUIET_H,
    block_hours: int = 24 * 30,
) -> DataFrame:
    """The same by a range window over heavy hours in blocks of time.

    A row is repeated in every block it can still block an onset of, so a window
    never needs a whole zone: its partition is one zone and one block.
    """
    hour = times.hour_number(F.col("instante_utc"))
    block = lambda h: F.floor(h / F.lit(block_hours)).cast("long")
    placed = (
        heavy_hours(clima, threshold)
        .withColumn("h", hour)
        .withColumn(
            "bloco", F.explode(F.sequence(block(F.col("h")), block(F.col("h") + quiet_hours)))
        )
    )
    before = Window.partitionBy("conjunto", "bloco").orderBy("h").rangeBetween(-quiet_hours, -1)
    return (
        placed.withColumn("antes", F.count(F.lit(1)).over(before))
        .filter((F.col("bloco") == block(F.col("h"))) & (F.col("antes") == 0))
        .select(*_KEY)
    )


def expected_rate(base: DataFrame) -> DataFrame:
    """Usual rate by UTC month and local hour: at most 288 rows."""
    return base.groupBy("mes", "hora_local").agg(
        (F.sum("interrupcoes") / F.count(F.lit(1))).alias("taxa_normal")
    )


def lag_profile(
    clima: DataFrame,
    counts: DataFrame,
    threshold: float = STORM_MM,
    window: int = STORM_WINDOW_H,
    onsets_only: bool = True,
) -> DataFrame:
    """Interruptions by hour around storm onsets against the usual rate.

    Each onset marks the ``2 * window + 1`` hours around it with their offset.
    One pass over the base then sums every hour once for the usual rate (offset
    null) and once per offset it carries. All joins share the key (zone, hour),
    so the base moves once, and what is left are at most offsets x 12 x 24 sums.
    """
    events = storm_onsets(clima, threshold) if onsets_only else heavy_hours(clima, threshold)
    offsets = (
        events.select(
            "conjunto",
            F.explode(F.sequence(F.lit(-window), F.lit(window))).alias("hora_rel"),
            "instante_utc",
        )
        .select(
            "conjunto",
            times.add_hours(F.col("instante_utc"), F.col("hora_rel")).alias("instante_utc"),
            "hora_rel",
        )
        .groupBy(*_KEY)
        .agg(F.collect_list("hora_rel").alias("horas_rel"))
    )
    itself = F.array(F.lit(None).cast("int"))
    marks = F.concat(itself, F.coalesce("horas_rel", F.array().cast("array<int>")))
    sums = (
        exposure_base(clima, counts)
        .join(offsets, _KEY, "left")
        .select("mes", "hora_local", "interrupcoes", F.explode(marks).alias("hora_rel"))
        .groupBy("hora_rel", "mes", "hora_local")
        .agg(F.count(F.lit(1)).alias("horas"), F.sum("interrupcoes").alias("n"))
    )
    whole = F.col("hora_rel").isNull()
    same_hour = Window.partitionBy("mes", "hora_local")
    usual_rate = F.max(F.when(whole, F.col("n") / F.col("horas"))).over(same_hour)
    usual = F.col("taxa_normal") * F.col("horas")
    hours, n = F.sum("horas"), F.sum("n")
    return (
        sums.withColumn("taxa_normal", usual_rate)
        .filter(~whole)
        .groupBy("hora_rel")
        .agg(
            hours.alias("conjunto_horas"),
            n.alias("interrupcoes"),
            (n / hours).alias("taxa"),
            (F.sum(usual) / hours).alias("taxa_esperada"),
            numbers.ratio(n, F.sum(usual)).alias("lift"),
        )
        .orderBy("hora_rel")
    )


def last_over_first(curve: DataFrame) -> DataFrame:
    """Rate of the last band over the first; the last, not the highest."""
    first, last = F.min_by("taxa", "faixa_id"), F.max_by("taxa", "faixa_id")
    return curve.agg(numbers.ratio(last, first).alias("multiplicador"))


def risk_multiples(curve: DataFrame) -> DataFrame:
    """Each band's rate over the first band's; a zero first rate counts as one."""
    first = curve.agg(F.min_by("taxa", "faixa_id")).scalar()
    base = F.coalesce(F.nullif(first, F.lit(0.0)), F.lit(1.0))
    return curve.withColumn("multiplo", F.col("taxa") / base)


def lag_peak(profile: DataFrame) -> DataFrame:
    """Hour and lift of the peak (earliest hour on ties), and mean lift just before."""
    before = (F.col("hora_rel") >= -6) & (F.col("hora_rel") < 0)
    order = F.when(F.col("lift").isNotNull(), F.struct(F.col("lift"), -F.col("hora_rel")))
    return profile.agg(
        F.max_by("hora_rel", order).alias("hora_pico"),
        F.max("lift").alias("lift_pico"),
        F.avg(F.when(before, F.col("lift"))).alias("lift_antes"),
    )
