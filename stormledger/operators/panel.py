"""Panel queries. ``rows`` are measure rows of a cube, stored or live over the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormledger.config import (
    DURATION_STEP,
    DURATION_TAIL,
    OTHER_CATEGORY,
    REPORTING_GRAIN_MIN_ROWS,
    TOP_CATEGORIES,
    UNKNOWN_CAUSE,
)
from stormledger.functions import numbers, text, times
from stormledger.operators.filters import Filtro, Lookups, measure


def _n() -> Column:
    return F.col("interrupcoes")


def _month_year() -> Column:
    return F.year("mes")


def _total(name: str) -> Column:
    return F.sum(name).alias(name)


def _weather_events() -> Column:
    """Events of weather-related rows, zero elsewhere; their sum over all gives the share."""
    return F.when(F.col("causa_climatica"), _n()).otherwise(F.lit(0))


def _weather_share() -> Column:
    return numbers.ratio(F.col("climaticas"), _n()).alias("fracao_climatica")


def _grouped(
    rows: DataFrame,
    f: Filtro,
    lookups: Lookups,
    keys: dict[str, Column],
    sums: dict[str, Column],
    reduced: bool = False,
) -> DataFrame:
    """Sums per key under the whole filter, by one plan at every size.

    Under a geographic condition rows are first summed per zone and key, so the
    join meets those sums only, and a zone with a third of the rows is a few.
    """
    kept, zones = f.rows(rows, reduced), f.zones(lookups)
    by = [c.alias(name) for name, c in keys.items()]
    first = [F.sum(c).alias(name) for name, c in sums.items()]
    if zones is None:
        return kept.groupBy(*by).agg(*first)
    per_zone = kept.groupBy("conjunto", *by).agg(*first)
    inside = per_zone.join(zones, "conjunto", "left_semi")
    return inside.groupBy(*keys).agg(*[_total(name) for name in sums])


def _both() -> dict[str, Column]:
    return {"interrupcoes": _n(), "consumidores": F.col("consumidores")}


def _top(totals: DataFrame, by: str, limit: int, key: str) -> DataFrame:
    """Top rows by a known measure, ties by key, so equal runs give equal rows."""
    return totals.orderBy(F.desc_nulls_last(measure(by)), F.asc(key)).limit(limit)


# --- totals and series --------------------------------------------------------


def summary(rows: DataFrame, durations: DataFrame, f: Filtro, lookups: Lookups) -> DataFrame:
    """Headline numbers, with the median duration from the band counts.

    Counting zones groups by zone anyway, so the sums ride along.
    """
    per_zone = (
        f.rows(rows)
        .groupBy("conjunto")
        .agg(
            _total("interrupcoes"),
            _total("consumidores"),
            _total("consumidor_minuto"),
            F.sum(_weather_events()).alias("climaticas"),
        )
    )
    totals = f.places(per_zone, lookups).agg(
        _total("interrupcoes"),
        _total("consumidores"),
        (F.sum("consumidor_minuto") / 60.0).alias("consumidor_hora"),
        F.count("conjunto").alias("conjuntos"),
        _total("climaticas"),
    )
    return totals.select(
        "interrupcoes",
        "consumidores",
        "consumidor_hora",
        "conjuntos",
        _weather_share(),
        median_duration(durations, f, lookups).scalar().alias("duracao_mediana"),
    )


def median_duration(rows: DataFrame, f: Filtro, lookups: Lookups) -> DataFrame:
    """Median interpolated in its band; one row, null when nothing matches.

    The window runs over one row per band, at most 51 by construction.
    """
    bands = duration_distribution(rows, f, lookups)
    running = bands.select(
        "faixa_min",
        _n().alias("n"),
        F.sum(_n()).over(Window.orderBy("faixa_min")).alias("ate_aqui"),
        F.sum(_n()).over(Window.partitionBy()).alias("total"),
    )
    half = F.col("total") / 2.0
    inside = F.col("faixa_min") + F.lit(DURATION_STEP) * (
        half - (F.col("ate_aqui") - F.col("n"))
    ) / F.nullif(F.col("n").cast("double"), F.lit(0.0))
    return running.filter(F.col("ate_aqui") >= half).agg(
        F.min_by(F.coalesce(inside, F.col("faixa_min")), "faixa_min").alias("duracao_mediana")
    )


def series(rows: DataFrame, f: Filtro, lookups: Lookups, grain: str = "month") -> DataFrame:
    period = {"periodo": times.trunc(grain, F.col("mes"))}
    return _grouped(rows, f, lookups, period, _both()).orderBy("periodo")


def by_cause(rows: DataFrame, f: Filtro, lookups: Lookups, grain: str = "year") -> DataFrame:
    keys = {
        "periodo": times.trunc(grain, F.col("mes")),
        "causa": F.coalesce("causa", F.lit(UNKNOWN_CAUSE)),
    }
    return _grouped(rows, f, lookups, keys, {"interrupcoes": _n()}).orderBy("periodo")


def full_window(rows: DataFrame, grain: str = "month") -> DataFrame:
    """First and last period in which at least half the usual zones report.

    One row per period goes into the median, so it is small whatever the data.
    """
    zones = rows.groupBy(times.trunc(grain, F.col("mes")).alias("periodo")).agg(
        F.countDistinct("conjunto").alias("conjuntos")
    )
    usual = zones.agg(F.median("conjuntos"))
    full = zones.filter(F.col("conjuntos") >= F.lit(0.5) * usual.scalar())
    return full.agg(F.min("periodo").alias("inicio"), F.max("periodo").alias("fim"))


def mark_partial(points: DataFrame, window: DataFrame) -> DataFrame:
    """Flag the periods outside the full window; they stay in the series."""
    period = F.col("periodo")
    outside = (period < window.select("inicio").scalar()) | (
        period > window.select("fim").scalar()
    )
    return points.withColumn("parcial", F.coalesce(outside, F.lit(False)))


def coverage_by_year(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(_month_year().alias("ano"))
        .agg(F.countDistinct("conjunto").alias("conjuntos"), _total("interrupcoes"))
        .orderBy("ano")
    )


def by_state(rows: DataFrame, f: Filtro, lookups: Lookups) -> DataFrame:
    """Totals per state of the zone; zones the dimension lacks come under null.

    One row per zone meets the dimension, so counting rows counts zones.
    """
    return (
        _zone_totals(rows, f, lookups)
        .join(lookups.dim_conjunto.select("conjunto", "uf"), "conjunto", "left")
        .groupBy("uf")
        .agg(F.count(F.lit(1)).alias("conjuntos"), _total("interrupcoes"), _total("consumidores"))
    )


# --- rankings -------------------------------------------------------------------


def zone_label() -> Column:
    """Null for a zone the dimension does not know, as its parts are."""
    name = F.coalesce(F.col("nome"), F.concat(F.lit("Conjunto "), F.col("conjunto").cast("string")))
    many = F.concat(F.col("qtd_municipios").cast("string"), F.lit(" municípios"))
    tail = F.when(F.col("qtd_municipios") > 1, many).otherwise(F.col("municipios"))
    return F.concat(name, F.lit(" · "), tail)


def _zone_totals(rows: DataFrame, f: Filtro, lookups: Lookups) -> DataFrame:
    """One row per zone before any join, so a busy zone never meets one."""
    totals = (
        f.rows(rows)
        .groupBy("conjunto")
        .agg(_total("interrupcoes"), _total("consumidores"))
    )
    return f.places(totals, lookups)


def zone_ranking(
    rows: DataFrame, f: Filtro, lookups: Lookups, by: str = "interrupcoes", limit: int = 15
) -> DataFrame:
    """The dimension is joined to the few rows left by the cut, not to the cube."""
    top = _top(_zone_totals(rows, f, lookups), by, limit, "conjunto")
    return (
        top.join(lookups.dim_conjunto, "conjunto", "left")
        .select(
            "conjunto", "nome", "uf", "qtd_municipios", "municipios",
            zone_label().alias("rotulo"), "interrupcoes", "consumidores",
        )
        .orderBy(F.desc_nulls_last(by), "conjunto")
    )


def distributor_ranking(
    rows: DataFrame, f: Filtro, lookups: Lookups, by: str = "consumidores", limit: int = 15
) -> DataFrame:
    sums = _both() | {"climaticas": _weather_events()}
    totals = _grouped(rows, f, lookups, {"distribuidora": F.col("distribuidora")}, sums)
    columns = ["distribuidora", "interrupcoes", "consumidores", _weather_share()]
    return _top(totals.select(*columns), by, limit, "distribuidora")


def zone_map(
    rows: DataFrame, f: Filtro, lookups: Lookups, by: str = "interrupcoes", limit: int = 900
) -> DataFrame:
    """Only zones with geometry count; the shape itself joins after the cut."""
    geo = lookups.geo_conjunto
    drawn = _zone_totals(rows, f, lookups).join(geo.select("conjunto"), "conjunto", "left_semi")
    return (
        _top(drawn, by, limit, "conjunto")
        .join(lookups.dim_conjunto, "conjunto", "left")
        .join(geo.select("conjunto", "wkt"), "conjunto")
        .select(
            "conjunto", "nome", "uf", "municipios", "qtd_municipios",
            "interrupcoes", "consumidores", "wkt",
        )
        .orderBy(F.desc_nulls_last(by), "conjunto")
    )


# --- hours and durations ----------------------------------------------------------


def hour_by_weekday(rows: DataFrame, f: Filtro, lookups: Lookups) -> DataFrame:
    keys = {"dia_semana": F.col("dia_semana"), "hora": F.col("hora")}
    return _grouped(rows, f, lookups, keys, {"interrupcoes": _n()}, reduced=True)


def weekday_matrix(cells: DataFrame) -> DataFrame:
    """Seven weekday rows by 24 hour columns, zero where nothing happened."""
    hours = list(range(24))
    wide = cells.groupBy("dia_semana").pivot("hora", hours).agg(F.sum("interrupcoes"))
    days = cells.sparkSession.range(7).select(F.col("id").cast("int").alias("dia_semana"))
    cols = [F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h:02d}") for h in hours]
    return days.join(wide, "dia_semana", "left").select("dia_semana", *cols).orderBy("dia_semana")


def duration_distribution(rows: DataFrame, f: Filtro, lookups: Lookups) -> DataFrame:
    band = {"faixa_min": F.col("faixa_min")}
    return _grouped(rows, f, lookups, band, {"interrupcoes": _n()}, reduced=True).orderBy("faixa_min")


def duration_tail(bands: DataFrame) -> DataFrame:
    """Share of events from 12, 24 and 72 hours on; null over nothing."""
    shares = [
        numbers.ratio(numbers.sum_when(F.col("faixa_min") >= floor, _n()), F.sum(_n())).alias(
            f"acima_{floor}"
        )
        for floor in DURATION_TAIL
    ]
    return bands.agg(*shares)


# --- categories and options ---------------------------------------------------------


def causes_by_weight(rows: DataFrame) -> DataFrame:
    return (
        rows.filter(F.col("causa").isNotNull())
        .groupBy("causa")
        .agg(F.sum("interrupcoes").alias("n"))
        .orderBy(F.desc("n"), "causa")
    )


def fold_tail(
    points: DataFrame, order: DataFrame, keep: int = TOP_CATEGORIES, other: str = OTHER_CATEGORY
) -> DataFrame:
    """Keep the globally largest categories and sum the rest into one.

    Which ones stay is decided by the whole data, so a category never changes
    sides between two filters.
    """
    kept = order.limit(keep).select("causa", F.lit(True).alias("fica"))
    name = F.when(F.col("fica"), F.col("causa")).otherwise(F.lit(other))
    return (
        points.join(kept, "causa", "left")
        .groupBy("periodo", name.alias("causa"))
        .agg(_total("interrupcoes"))
    )


def cause_label(points: DataFrame) -> DataFrame:
    return points.withColumn("rotulo", text.capitalized(F.col("causa")))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def year_bounds(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min(_month_year()).alias("ano_min"), F.max(_month_year()).alias("ano_max"))


def options(rows: DataFrame, lookups: Lookups) -> DataFrame:
    """All choices the filter offers as (lista, valor, n), n for causes only; in no order.

    The fact is read once: sums per cause, distributor and year are few and hold
    all three lists.
    """
    found = rows.groupBy("causa", "distribuidora", _month_year().alias("ano")).agg(_total("interrupcoes"))
    text_of = lambda c: F.col(c).cast("string")
    entry = lambda name, value, n=F.lit(None).cast("long"): F.struct(
        F.lit(name).alias("lista"), value.alias("valor"), n.alias("n")
    )
    lists = F.array(
        entry("causas", F.col("causa"), F.col("interrupcoes")),
        entry("distribuidoras", F.col("distribuidora")),
        entry("anos", text_of("ano")),
    )
    values = found.select(F.inline(lists)).filter(F.col("valor").isNotNull())
    values = values.groupBy("lista", "valor").agg(_total("n"))
    is_year = F.col("lista") == "anos"
    bounds = values.filter(is_year).agg(F.min("valor").alias("a"), F.max("valor").alias("b"))
    years = bounds.select(F.explode(F.array("a", "b")).alias("valor"))
    out = values.filter(~is_year).unionByName(
        years.select(F.lit("anos").alias("lista"), "valor", F.lit(None).cast("long").alias("n"))
    )
    for name, df, column in (("ufs", lookups.dim_conjunto, "uf"), ("regioes", lookups.dim_municipio, "regiao")):
        listed = df.select(F.lit(name).alias("lista"), F.col(column).alias("valor"), F.lit(None).cast("long").alias("n"))
        out = out.unionByName(listed.filter(F.col("valor").isNotNull()).distinct())
    return out


def municipality_labels(dim_municipio: DataFrame, ufs: tuple[str, ...] = ()) -> DataFrame:
    chosen = dim_municipio.filter(F.col("uf").isin(*ufs)) if ufs else dim_municipio
    label = F.concat(F.col("municipio"), F.lit("/"), F.col("uf")).alias("rotulo")
    return chosen.orderBy("municipio").select("municipio_ibge", label)


def reporting_grain(fact: DataFrame, min_rows: int = REPORTING_GRAIN_MIN_ROWS) -> DataFrame:
    """How much each large distributor reports one customer per row."""
    one = F.sum(F.when(F.col("consumidores_afetados") == 1, 1).otherwise(0))
    return (
        fact.groupBy("distribuidora")
        .agg(
            F.count(F.lit(1)).alias("registros"),
            F.sum("consumidores_afetados").alias("consumidores"),
            (F.lit(100.0) * one / F.count(F.lit(1))).alias("pct_uma_unidade"),
        )
        .filter(F.col("registros") > min_rows)
        .orderBy(F.desc("pct_uma_unidade"), "distribuidora")
    )
