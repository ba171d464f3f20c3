"""Exposure, storm and grid queries."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from stormledger.config import GUST_BANDS, RAIN_BANDS, WEATHER_DETAILS
from stormledger.functions import bands, geometry as g, times
from stormledger.operators import audit, exposure, geo, grid, outline
from stormledger.operators.filters import Filtro
from stormledger.plans import cycle, fixtures as fx
from stormledger.plans.fixtures import Data
from stormledger.plans.registry import query
from stormledger.sources import arrays, files, layers

YEARS = Filtro(2024, 2024)


def counts(d: Data, f: Filtro = YEARS) -> DataFrame:
    return exposure.hourly_counts(fx.event_fact(d), f, fx.lookups(d))


def base(d: Data, f: Filtro = YEARS) -> DataFrame:
    return exposure.exposure_base(fx.climate_hours(d), counts(d, f))


def _heavy(cents: int) -> str:
    """Heavy hours from so many hundredths on, with the hours 12 to each side."""
    return f"""select conjunto, hora_rel, instante_utc + to_hours(hora_rel) as hora from (
        select conjunto, instante_utc, unnest(generate_series(-12, 12))::integer as hora_rel
        from clima where chuva_c >= {cents})"""


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- time ----------------------------------------------------------------------------


@query(
    "local_to_utc_x12",
    """select o_orderkey, utc, cast(date_diff('hour', local, utc) as bigint) as horas from (
         select o_orderkey, local, (local at time zone 'America/Sao_Paulo') at time zone 'UTC' as utc from (
           select o_orderkey, o_orderdate + to_hours(cast(o_orderkey % 24 as integer))
                              + to_minutes(cast(o_orderkey % 60 as integer)) as local from orders))""",
)
def _(d):
    key = F.col("o_orderkey")
    minutes = (key % 24) * 3600 + (key % 60) * 60
    local = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + minutes)
    orders = d("orders").select("o_orderkey", local.cast("timestamp_ntz").alias("local"))
    utc = times.local_to_utc(F.col("local"))
    return orders.select(
        "o_orderkey",
        utc.alias("utc"),
        (times.hour_number(utc) - times.hour_number(F.col("local"))).alias("horas"),
    )


@query(
    "utc_to_local_hour_x13",
    """select event_id, cast(hour((ts at time zone 'UTC') at time zone 'America/Sao_Paulo') as integer) as hora_local
       from events""",
)
def _(d):
    return d("events").select("event_id", times.local_hour(F.col("ts")).alias("hora_local"))


@query(
    "date_parts_x9_x10_x11",
    """select event_id, date_trunc('hour', ts) as hora, date_trunc('month', ts)::timestamp as mes,
              date_trunc('quarter', ts)::timestamp as trimestre, date_trunc('year', ts)::timestamp as ano,
              cast(dayofweek(ts) as integer) as dia_semana, cast(hour(ts) as integer) as h,
              cast(month(ts) as integer) as m from events""",
)
def _(d):
    ts = F.col("ts")
    return d("events").select(
        "event_id",
        times.trunc("hour", ts).alias("hora"),
        times.trunc("month", ts).alias("mes"),
        times.trunc("quarter", ts).alias("trimestre"),
        times.trunc("year", ts).alias("ano"),
        times.weekday(ts).alias("dia_semana"),
        F.hour(ts).alias("h"),
        F.month(ts).alias("m"),
    )


@query(
    "epoch_and_boundary_seconds_x6_x7_x8",
    """select event_id, cast(epoch(ts) - epoch(timestamp '2017-01-01') as integer) as inicio_s,
              cast(date_diff('second', ts, ts + to_milliseconds(cast(value * 1000 as bigint))) as integer) as duracao_s,
              cast(date_diff('hour', ts, ts + to_milliseconds(cast(value * 1000 as bigint))) as bigint) as horas,
              timestamp '2017-01-01' + to_seconds(cast(epoch(ts) - epoch(timestamp '2017-01-01') as integer)) as inicio
       from events""",
)
def _(d):
    millis = F.rint(F.col("value") * 1000).cast("long")
    end = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + millis * 1000)
    rows = d("events").select("event_id", "ts", end.cast("timestamp_ntz").alias("fim"))
    ts, fim = F.col("ts"), F.col("fim")
    return rows.select(
        "event_id",
        times.seconds_from_epoch(ts).alias("inicio_s"),
        times.seconds_between(ts, fim).alias("duracao_s"),
        (times.hour_number(fim) - times.hour_number(ts)).alias("horas"),
        times.from_epoch(times.seconds_from_epoch(ts)).alias("inicio"),
    )


# --- exposure ---------------------------------------------------------------------------


@query("hourly_counts_a9_j12", "select conjunto, hora_utc as instante_utc, interrupcoes from horas")
def _(d):
    return counts(d)


@query(
    "dense_base_j11_p22",
    """select conjunto, instante_utc, chuva, rajada, interrupcoes,
              cast(hora_local as integer) as hora_local, cast(mes as integer) as mes from base""",
)
def _(d):
    return base(d)


@query(
    "bucketed_base_s11_j11",
    """select conjunto, instante_utc, chuva, rajada, interrupcoes,
              cast(hora_local as integer) as hora_local, cast(mes as integer) as mes from base""",
)
def _(d):
    # Zone-hours and counts lie dealt alike, so the join moves neither.
    tables, buckets = {}, max(8, int(d.spark.conf.get("spark.sql.shuffle.partitions")))
    for name, rows in (("horas", fx.climate_hours(d)), ("contagens", counts(d))):
        path = files.scratch(d.spark, f"baldes_{name}")
        tables[name] = os.path.basename(path).replace("-", "_")
        files.write_bucketed(rows, tables[name], path, ["conjunto", "instante_utc"], buckets)
    return exposure.exposure_base(d.spark.table(tables["horas"]), d.spark.table(tables["contagens"]))


@query(
    "grid_completeness_a27",
    """select count(*) as linhas, count(distinct instante_utc) as horas, count(distinct conjunto) as conjuntos,
              count(distinct instante_utc) * count(distinct conjunto) - count(*) as faltando from clima""",
)
def _(d):
    return audit.completeness(fx.climate_hours(d))


_RAIN = "['sem chuva', 'até 0,5 mm', '0,5–1 mm', '1–2 mm', '2–5 mm', '5 mm ou mais']"
_GUST = "['até 20 km/h', '20–30', '30–40', '40–50', '50–60', '60 km/h ou mais']"


@query(
    "rain_risk_a10_p13_x17",
    f"""select {_RAIN}[faixa_id + 1] as faixa, faixa_id, count(*) as conjunto_horas,
               cast(sum(interrupcoes) as bigint) as interrupcoes,
               sum(interrupcoes) / cast(count(*) as double) as taxa
        from marcado_chuva where faixa_id is not null group by faixa_id""",
)
def _(d):
    return exposure.rain_risk(base(d))


@query(
    "gust_risk_a10_p14",
    f"""select {_GUST}[faixa_id + 1] as faixa, faixa_id, count(*) as conjunto_horas,
               cast(sum(interrupcoes) as bigint) as interrupcoes,
               sum(interrupcoes) / cast(count(*) as double) as taxa
        from marcado_rajada where faixa_id is not null group by faixa_id""",
)
def _(d):
    return exposure.gust_risk(base(d))


@query(
    "rain_risk_one_uf_p25",
    """select faixa_id, count(*) as conjunto_horas, cast(sum(n) as bigint) as interrupcoes from (
         select case when b.chuva = 0 then 0 when b.chuva < 0.5 then 1 when b.chuva < 1 then 2
                     when b.chuva < 2 then 3 when b.chuva < 5 then 4 else 5 end as faixa_id,
                case when dc.uf = 'NATION_5' then b.interrupcoes else 0 end as n
         from base b left join dim_conjunto dc on dc.conjunto = b.conjunto) group by faixa_id""",
)
def _(d):
    # The page forces its own state on whatever filter is set; hours stay whole.
    forced = replace(Filtro(2024, 2024, ufs=("NATION_1",)), ufs=("NATION_5",))
    return exposure.rain_risk(base(d, forced)).select("faixa_id", "conjunto_horas", "interrupcoes")


@query(
    "band_multiples_a33_a34",
    """select faixa_id, round(taxa / coalesce(nullif((select arg_min(taxa, faixa_id) from curva), 0), 1), 6) as multiplo,
              round((select arg_max(taxa, faixa_id) / nullif(arg_min(taxa, faixa_id), 0) from curva), 6) as multiplicador
       from curva""",
)
def _(d):
    curve = exposure.rain_risk(base(d))
    overall = exposure.last_over_first(curve).scalar()
    out = exposure.risk_multiples(curve).withColumn("multiplicador", overall)
    return rounded(out.select("faixa_id", "multiplo", "multiplicador"), "multiplo", "multiplicador")


@query("storm_onsets_j13", "select * from eventos")
def _(d):
    return exposure.storm_onsets(fx.climate_hours(d))


@query("storm_onsets_window_w4", "select * from eventos")
def _(d):
    return exposure.storm_onsets_windowed(fx.climate_hours(d))


@query(
    "expected_rate_a11",
    "select distinct cast(mes as integer) as mes, cast(hora_local as integer) as hora_local, taxa_normal from usual",
)
def _(d):
    return exposure.expected_rate(base(d))


@query(
    "lag_profile_a12_j14_j15",
    """select hora_rel, conjunto_horas, interrupcoes, round(taxa, 6) as taxa,
              round(taxa_esperada, 6) as taxa_esperada, round(lift, 6) as lift from perfil""",
)
def _(d):
    out = exposure.lag_profile(fx.climate_hours(d), counts(d))
    return rounded(out, "taxa", "taxa_esperada", "lift")


@query(
    "lag_profile_all_heavy_hours_a12",
    f"""select hora_rel, count(*) as conjunto_horas, cast(sum(u.interrupcoes) as bigint) as interrupcoes,
              round(avg(u.interrupcoes), 6) as taxa, round(avg(u.taxa_normal), 6) as taxa_esperada,
              round(sum(u.interrupcoes) / nullif(sum(u.taxa_normal), 0), 6) as lift
       from ({_heavy(200)}) h join usual u on u.conjunto = h.conjunto and u.instante_utc = h.hora group by hora_rel""",
)
def _(d):
    out = exposure.lag_profile(fx.climate_hours(d), counts(d), threshold=2, window=12, onsets_only=False)
    return rounded(out, "taxa", "taxa_esperada", "lift")


# Thresholds that are no binary fraction: 1.1 mm is 110 hundredths.
for _mm, _cents in ((1.1, 110), (2.2, 220)):

    @query(
        f"lag_profile_from_{_cents}_a12",
        f"""select hora_rel, count(*) as conjunto_horas, cast(sum(u.interrupcoes) as bigint) as interrupcoes
           from ({_heavy(_cents)}) h join usual u on u.conjunto = h.conjunto and u.instante_utc = h.hora group by hora_rel""",
    )
    def _(d, mm=_mm):
        out = exposure.lag_profile(fx.climate_hours(d), counts(d), threshold=mm, window=12, onsets_only=False)
        return out.select("hora_rel", "conjunto_horas", "interrupcoes")

    @query(
        f"storm_onsets_from_{_cents}_j13",
        f"""select conjunto, instante_utc from (
              select conjunto, instante_utc, date_diff('hour', lag(instante_utc) over (
                         partition by conjunto order by instante_utc), instante_utc) as desde
              from clima where chuva_c >= {_cents}) where desde is null or desde > 6""",
    )
    def _(d, mm=_mm):
        return exposure.storm_onsets(fx.climate_hours(d), mm)


@query(
    "lag_peak_a35",
    """select (select hora_rel from perfil order by lift desc nulls last, hora_rel limit 1) as hora_pico,
              round((select max(lift) from perfil), 6) as lift_pico,
              round((select avg(lift) from perfil where hora_rel >= -6 and hora_rel < 0), 6) as lift_antes""",
)
def _(d):
    out = exposure.lag_peak(exposure.lag_profile(fx.climate_hours(d), counts(d)))
    return rounded(out, "lift_pico", "lift_antes")


@query(
    "one_band_each_p13_p14",
    """select faixa_chuva, faixa_rajada, count(*) as n from (
         select case when chuva_c = 0 then 0 when chuva_c < 50 then 1 when chuva_c < 100 then 2
                     when chuva_c < 200 then 3 when chuva_c < 500 then 4 else 5 end as faixa_chuva,
                case when rajada_c < 2000 then 0 when rajada_c < 3000 then 1 when rajada_c < 4000 then 2
                     when rajada_c < 5000 then 3 when rajada_c < 6000 then 4 else 5 end as faixa_rajada
         from clima) group by all""",
)
def _(d):
    clima = fx.climate_hours(d)
    return clima.groupBy(
        bands.rain_band(F.col("chuva_c") / 100.0, RAIN_BANDS).alias("faixa_chuva"),
        bands.gust_band(F.col("rajada_c") / 100.0, GUST_BANDS).alias("faixa_rajada"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "climate_audit_p12",
    """select regra, n, round(100 * n / cast((select count(*) from clima) as double), 6) as pct, tolerado,
              case when n > 0 then 'FALHA' else 'ok' end as situacao from (
         select 'chuva ou rajada nula' as regra, count(*) filter (chuva_c is null or rajada_c is null) as n, cast(0 as bigint) as tolerado from clima
         union all select 'chuva negativa', count(*) filter (chuva_c < 0), 0 from clima
         union all select 'rajada não positiva', count(*) filter (rajada_c <= 0), 0 from clima
         union all select 'chuva acima de 100 mm/h', count(*) filter (chuva_c > 10000), 0 from clima
         union all select 'rajada acima de 150 km/h', count(*) filter (rajada_c > 15000), 0 from clima)""",
)
def _(d):
    return rounded(audit.check(fx.climate_hours(d), audit.climate_rules()), "pct")


# --- geometry ------------------------------------------------------------------------------


@query(
    "polygon_area_centroid_box_g3",
    """select k as municipio_ibge, round(mx / area, 4) as lon, round(my / area, 4) as lat,
              round(area, 6) as area_graus, round(oeste, 6) as oeste, round(sul, 6) as sul,
              round(leste, 6) as leste, round(norte, 6) as norte from contorno""",
)
def _(d):
    out = rounded(geo.shapes(fx.meshes(d), "municipio_ibge"), "oeste", "sul", "leste", "norte")
    return rounded(rounded(out, "lon", "lat", digits=4), "area_graus")


@query(
    "cell_overlap_g1_j5",
    """select k as municipio_ibge, celula, lat, lon, round(area, 6) as area from sobreposicao
       where area > 1e-7""",
)
def _(d):
    return rounded(geo.cell_overlap(fx.meshes(d)).filter(F.col("area") > 1e-7), "area")


@query(
    "customers_per_grid_cell_g4_p24",
    """select celula, lat, lon, count(k) as poligonos from celulas
       left join (select k, cast(round_even((y + 90) / 0.25, 0) * 10000 + round_even((x + 180) / 0.25, 0) as integer) as c
                  from medidas) m on m.c = celulas.celula
       group by celula, lat, lon""",
)
def _(d):
    ring = F.get(F.get("partes", F.lit(0)), F.lit(0))
    west, south = F.array_min(F.transform(ring, lambda p: p["x"])), F.array_min(F.transform(ring, lambda p: p["y"]))
    placed = fx.meshes(d).groupBy(
        geo.cell_id(geo.lat_index(south), geo.lon_index(west)).alias("celula")
    ).agg(F.count(F.lit(1)).alias("poligonos"))
    return geo.grid_cells(d.spark).join(placed, "celula", "left").na.fill(0, ["poligonos"])


@query(
    "zone_weights_a31_w5_p17_g2",
    "select conjunto, celula, lat, lon, round(peso, 6) as peso from pesos",
)
def _(d):
    return rounded(geo.zone_weights(fx.shape_bridge(d), fx.meshes(d)), "peso")


@query(
    "weights_summary_a40",
    "select count(distinct conjunto) as conjuntos, count(distinct celula) as celulas, count(*) as pares from pesos",
)
def _(d):
    return geo.weights_summary(geo.zone_weights(fx.shape_bridge(d), fx.meshes(d)))


@query(
    "weights_sum_to_one_a31",
    "select conjunto, round(sum(peso), 6) as soma from pesos group by conjunto",
)
def _(d):
    weights = geo.zone_weights(fx.shape_bridge(d), fx.meshes(d))
    return rounded(weights.groupBy("conjunto").agg(F.sum("peso").alias("soma")), "soma")


@query(
    "zone_geometry_a30_j3",
    """select v.conjunto, round(sum(mx) / sum(area), 4) as lon, round(sum(my) / sum(area), 4) as lat,
              round(sum(area), 6) as area_graus,
              cast(sum((select count(*) from aneis a where a.k = v.k and externo)) as bigint) as partes,
              cast(sum((select sum(len(p)) from aneis a where a.k = v.k)) as bigint) as pontos,
              round(sum((select sum(list_sum(list_transform(p, lambda q: round(q.x, 5)))) from aneis a where a.k = v.k)), 5) as soma_x,
              round(sum((select sum(list_sum(list_transform(p, lambda q: round(q.y, 5)))) from aneis a where a.k = v.k)), 5) as soma_y
       from vinculos v join contorno t on t.k = v.k group by v.conjunto""",
)
def _(d):
    zones = geo.zone_geometry(fx.shape_bridge(d), fx.meshes(d))
    out = zones.select("conjunto", "lon", "lat", "area_graus", *_outline())
    return rounded(rounded(out, "lon", "lat", digits=4), "area_graus")


# Bricks as two half-cells each: a zone's sides are those without a half-cell of its own beyond,
# its parts and holes are the connected half-cells inside and outside, found by walking over sides.
_BRICKS = """tijolos as (
         select c_custkey % 100 as i, c_custkey // 100 as j,
                ((c_custkey // 100 // 10) * 10 + c_custkey % 100 // 10) * 2 + if(c_custkey * 7919 % 101 < 61, 0, 1) as z
         from customer),
       meias as (select z, 2 * i + j % 2 + d as x, j as y from tijolos, (values (0), (1)) as v(d)),
       passos(dx, dy, lado) as (values (1, 0, 0.25::double), (-1, 0, 0.25), (0, 1, 0.125), (0, -1, 0.125)),
       caixas as (select z, min(x) - 1 as x0, max(x) + 1 as x1, min(y) - 1 as y0, max(y) + 1 as y1 from meias group by z),
       campo as (
         select b.z, b.x, b.y, m.z is not null as dentro
         from (select z, x0, x, unnest(range(y0, y1 + 1)) as y from (select *, unnest(range(x0, x1 + 1)) as x from caixas)) b
         left join meias m on m.z = b.z and m.x = b.x and m.y = b.y),
       anda as (
         select z, dentro, x, y, x as rx, y as ry from campo
         union
         select a.z, a.dentro, c.x, c.y, a.rx, a.ry
         from anda a, passos p, campo c where c.z = a.z and c.dentro = a.dentro and c.x = a.x + p.dx and c.y = a.y + p.dy),
       partes as (
         select z, count(distinct raiz) filter (dentro) as partes, count(distinct raiz) filter (not dentro) - 1 as furos
         from (select z, dentro, x, y, min(rx * 100000 + ry) as raiz from anda group by all) group by z),
       margem as (
         select m.z, sum(p.lado) as perimetro from meias m, passos p
         where not exists (select 1 from meias o where o.z = m.z and o.x = m.x + p.dx and o.y = m.y + p.dy) group by m.z)"""


@query(
    "zone_outline_a30_j3_g2",
    f"""with recursive {_BRICKS}
       select t.z::int as conjunto, round(count(*) * 0.0625, 6) as area_graus, round(any_value(perimetro), 6) as perimetro,
              any_value(partes) as partes, any_value(furos) as furos, true as ancora_dentro
       from tijolos t join margem m on m.z = t.z join partes p on p.z = t.z group by t.z""",
)
def _(d):
    bricks = fx.bricks(d)
    found = outline.measured(outline.zone_outlines(bricks, bricks.drop("conjunto")), "conjunto")
    length = F.aggregate(
        F.flatten(F.transform(F.flatten("partes"), g.ring_edges)),
        F.lit(0.0),
        lambda a, e: a + F.sqrt((e["xb"] - e["xa"]) * (e["xb"] - e["xa"]) + (e["yb"] - e["ya"]) * (e["yb"] - e["ya"])),
    )
    holds = lambda r: g.ring_holds(r["anel"], F.col("lon"), F.col("lat"))
    inside = F.aggregate(g.part_rings(F.col("partes")), F.lit(False), lambda odd, r: odd != holds(r))
    out = found.select(
        "conjunto",
        "area_graus",
        length.alias("perimetro"),
        F.size("partes").cast("long").alias("partes"),
        F.aggregate("partes", F.lit(0), lambda a, p: a + F.size(p) - 1).cast("long").alias("furos"),
        inside.alias("ancora_dentro"),
    )
    return rounded(out, "area_graus", "perimetro")


@query(
    "anchor_point_g3",
    """select * from (with alturas as (
         select k, anel // 2 as parte, unnest(list_transform(p, lambda q: q.y)) as y from aneis),
       meios as (select k, parte, (min(y) + max(y)) / 2 as meio from alturas group by k, parte),
       niveis as (
         select a.k, a.parte, (max(y) filter (y <= meio) + min(y) filter (y > meio)) / 2 as nivel
         from alturas a join meios m on m.k = a.k and m.parte = a.parte group by a.k, a.parte),
       cruza as (
         select n.k, n.parte, nivel, xa + (xb - xa) * (nivel - ya) / (yb - ya) as x
         from arestas a join niveis n on n.k = a.k and n.parte = a.anel // 2 where (ya > nivel) <> (yb > nivel)),
       trechos as (
         select *, lead(x) over w as x2, row_number() over w as n from cruza window w as (partition by k, parte order by x))
       select k as municipio_ibge, round(arg_max((x + x2) / 2, x2 - x), 4) as lon, round(arg_max(nivel, x2 - x), 4) as lat
       from trechos where n % 2 = 1 group by k)""",
)
def _(d):
    found = outline.measured(fx.meshes(d), "municipio_ibge").select("municipio_ibge", "lon", "lat")
    return rounded(found, "lon", "lat", digits=4)


@query(
    "repaired_shape_s7",
    """with medida as (
         select c_custkey as k, 0.5::double + (c_custkey % 7) * 0.05::double as w, 0.4::double + (c_custkey % 5) * 0.07::double as h from customer),
       cruz as (select k, w, h, w * 0.8 / 1.7 as x from medida)
       select k as municipio_ibge, round(0.8 * h * x / 2 + 0.9 * h * (w - x) / 2, 6) as area_graus, 2::bigint as partes, 6::bigint as pontos
       from cruz""",
)
def _(d):
    found = outline.measured(outline.sound(fx.crossed(d), "municipio_ibge"), "municipio_ibge")
    points = F.aggregate(F.flatten("partes"), F.lit(0), lambda a, r: a + F.size(r)).cast("long")
    out = found.select(
        "municipio_ibge", "area_graus", F.size("partes").cast("long").alias("partes"), points.alias("pontos")
    )
    return rounded(out, "area_graus")


@query(
    "municipality_geometry_a30",
    """select t.k as municipio_ibge, round(mx / area, 4) as lon, round(my / area, 4) as lat, round(area, 6) as area_graus,
              count(*) filter (externo) as partes, sum(len(p))::bigint as pontos,
              round(sum(list_sum(list_transform(p, lambda q: round(q.x, 5)))), 5) as soma_x,
              round(sum(list_sum(list_transform(p, lambda q: round(q.y, 5)))), 5) as soma_y
       from contorno t join aneis a on a.k = t.k group by t.k, mx, my, area""",
)
def _(d):
    out = geo.municipality_geometry(fx.meshes(d))
    out = out.select("municipio_ibge", "lon", "lat", "area_graus", *_outline())
    return rounded(rounded(out, "lon", "lat", digits=4), "area_graus")


def _outline() -> list[Column]:
    """Parts, points and sums of both coordinates, read back from the well-known text."""
    # Every part opens with a double bracket; its holes do not. Rings are written as they came.
    parts = F.regexp_count("wkt", F.lit(r"\(\(")).cast("long").alias("partes")
    rings = F.transform(F.regexp_extract_all("wkt", F.lit(r"[^()]*[0-9][^()]*"), F.lit(0)), lambda r: F.split(F.trim(r), r"\s*,\s*"))
    points = F.aggregate(rings, F.lit(0), lambda a, r: a + F.size(r)).cast("long").alias("pontos")
    axis = lambda k: F.aggregate(
        F.flatten(rings), F.lit(0.0), lambda a, p: a + F.get(F.split(p, " "), F.lit(k)).cast("double")
    )
    return [parts, points, *[F.round(axis(k), 5).alias(name) for k, name in enumerate(("soma_x", "soma_y"))]]


# --- grid --------------------------------------------------------------------------------------


@query("grid_rows_s8_p23_u6", "select * from grade")
def _(d):
    return grid.grid_rows(fx.grid_steps(d)).select(
        "celula", "instante_utc", F.col("chuva_c").cast("int"), F.col("rajada_c").cast("int")
    )


@query(
    "grid_files_s8",
    """select celula, instante_utc, chuva_c, rajada_c from grade
       where instante_utc >= timestamp '2024-01-02 00:00:00' - interval 1 hour and instante_utc <= timestamp '2024-01-09 23:00:00'""",
)
def _(d):
    # Written as monthly zips of array files, then only a range of steps is read.
    path = files.scratch(d.spark, "grade-mensal")
    arrays.register(d.spark)
    fx.grid_steps(d).write.format(arrays.FORMAT).mode("append").save(path)
    steps = arrays.read(d.spark, path, datetime(2024, 1, 2), datetime(2024, 1, 10))
    return grid.grid_rows(steps).select("celula", "instante_utc", F.col("chuva_c").cast("int"), F.col("rajada_c").cast("int"))


@query(
    "merged_variables_s8",
    """select timestamp '2024-01-01' + to_hours(cast(vec_id as integer)) as valid_time,
              len(embedding) as n, round(sum_tp, 4) as tp, round(sum_fg, 4) as fg10
       from (select vec_id, embedding, list_sum(list_transform(embedding, lambda e: cast(e as double) * 0.01)) as sum_tp,
                    list_sum(list_transform(embedding, lambda e: abs(cast(e as double)) * 40)) as sum_fg from embeddings)""",
)
def _(d):
    steps = fx.grid_steps(d)
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, v: a + v), 4)
    merged = grid.merge_variables(steps.select("valid_time", "latitude", "longitude", "tp"), steps)
    return merged.select(
        "valid_time", F.size("tp").cast("long").alias("n"), total("tp").alias("tp"), total("fg10").alias("fg10")
    )


@query(
    "used_cells_j18_u3",
    """select celula, count(*) as horas, cast(sum(chuva_c) as bigint) as chuva from grade
       where celula in (select celula from pesos) group by celula""",
)
def _(d):
    weights = geo.zone_weights(fx.shape_bridge(d), fx.meshes(d))
    return grid.used_cells(grid.grid_rows(fx.grid_steps(d)), weights).groupBy("celula").agg(
        F.count(F.lit(1)).alias("horas"), F.sum("chuva_c").alias("chuva")
    )


@query("climate_in_two_loads_s11_o3", "select * from conjunto_hora")
def _(d):
    # Even and odd months of the source in two calls; the second must leave the first alone.
    root = files.scratch(d.spark, "cargas")
    paths = layers.Paths(f"{root}/bronze", f"{root}/prata", f"{root}/ouro")
    files.write_fact(fx.stored_fact(d, cause=False).withColumn("ano_arquivo", F.col("ano")), paths.silver(layers.FACT))
    files.write_table(geo.zone_weights(fx.shape_bridge(d), fx.meshes(d)), paths.silver("peso_conjunto_celula"))
    odd = F.month("valid_time") % 2 == 1
    for months in (odd, ~odd):
        cycle.curate_climate(d.spark, paths, fx.grid_steps(d).filter(months))
    return d.spark.read.parquet(paths.silver("clima_conjunto_hora")).select(
        "conjunto", "instante_utc", F.col("chuva_c").cast("int"), F.col("rajada_c").cast("int")
    )


@query(
    "weights_of_one_state_j4",
    "select conjunto, celula, lat, lon, round(peso, 6) as peso from pesos where conjunto % 5 = 1",
)
def _(d):
    root = files.scratch(d.spark, "pesos")
    paths = layers.Paths(f"{root}/bronze", f"{root}/prata", f"{root}/ouro")
    bridge = fx.shape_bridge(d)
    state = F.concat(F.lit("U"), (F.col("conjunto") % 5).cast("string")).alias("uf")
    files.write_table(bridge, paths.silver("ponte_conjunto_municipio"))
    files.write_table(bridge.select("conjunto", state).distinct(), paths.silver("dim_conjunto"))
    cycle.curate_weights(d.spark, paths, fx.meshes(d), uf="U1")
    return rounded(d.spark.read.parquet(paths.silver("peso_conjunto_celula")), "peso")


@query(
    "published_tables_s13_s15_s16_a41",
    """select 'mart_mensal' as tabela, count(*) as linhas, 'publicado' as modo from mart_mensal
       union all select 'mart_hora_semana', count(*), 'publicado' from mart_hora_semana
       union all select 'mart_duracao', count(*), 'publicado' from mart_duracao
       union all select 'dim_conjunto', count(*), 'publicado' from dim_conjunto
       union all select 'mart_clima_risco_por_chuva', count(distinct faixa_id), 'publicado' from marcado_chuva
       union all select 'mart_clima_risco_por_rajada', count(distinct faixa_id), 'publicado' from marcado_rajada
       union all select 'mart_clima_perfil_defasagem', count(*), 'publicado' from perfil""",
)
def _(d):
    root = files.scratch(d.spark, "publicado")
    paths = layers.Paths(f"{root}/bronze", f"{root}/prata", f"{root}/ouro", published=True)
    # The published flag knows the real causes only; the brands that play the part take one's name.
    detail = F.when(F.col("detalhe").isin(*fx.WEATHER_BRANDS), WEATHER_DETAILS[0]).otherwise(F.col("detalhe"))
    fact = fx.stored_fact(d).withColumn("detalhe", detail)
    files.write_fact(fact.withColumn("ano_arquivo", F.col("ano")), paths.silver(layers.FACT))
    files.write_table(fx.dim_conjunto(d), paths.silver("dim_conjunto"))
    files.write_periods(fx.climate_hours(d).withColumn(layers.PERIOD, F.date_format("instante_utc", "yyyyMM")), paths.silver("clima_conjunto_hora"), layers.PERIOD, ["conjunto", "instante_utc"])
    sizes = cycle.publish(d.spark, paths)
    layers.register(d.spark, paths)
    return sizes.select("tabela", "linhas", F.lit(layers.mode(d.spark)).alias("modo"))


@query(
    "dense_base_clipped_to_years_j11",
    """select conjunto, count(*) as horas, cast(sum(interrupcoes) as bigint) as n from base
       where year(instante_utc - interval 3 hour) = 2024 group by conjunto""",
)
def _(d):
    clipped = exposure.exposure_base(fx.climate_hours(d), counts(d), clip=YEARS)
    return clipped.groupBy("conjunto").agg(F.count(F.lit(1)).alias("horas"), F.sum("interrupcoes").alias("n"))


@query("zone_hours_a8_j6_j7", "select * from conjunto_hora")
def _(d):
    weights = geo.zone_weights(fx.shape_bridge(d), fx.meshes(d))
    rows = grid.zone_hours(grid.grid_rows(fx.grid_steps(d)), weights, fx.fact_view(d, cause=False))
    return rows.select(
        "conjunto", "instante_utc", F.col("chuva_c").cast("int"), F.col("rajada_c").cast("int")
    )
