"""Normalisation, dimensions, audits, sources and refresh decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormledger.config import FACT_RULES, REFERENCE_RULES
from stormledger.functions import numbers, text
from stormledger.operators import audit, cubes, dims, geo, normalise, zones
from stormledger.operators.filters import Filtro
from stormledger.plans import fixtures as fx, partials
from stormledger.plans.fixtures import Data
from stormledger.plans.registry import query
from stormledger.sources import catalog, files, layers, versions

# --- scalar functions over whole texts -------------------------------------------------


# Greek, Cyrillic, Vietnamese and letters whose upper case is longer, after every text.
_LETTERS = " Ελληνικά ΐΰ Ώώς Ёлка Йод їЇ ằẵ Ṩ ŉ ﬁﬂ ß ǰ ẖ"


@query(
    "accents_and_case_x3",
    f"""select doc_id, md5(strip_accents(t)) as sem_acento, md5(upper(strip_accents(t))) as maiusculas
        from (select doc_id, text || '{_LETTERS}' as t from documents)""",
)
def _(d):
    t = F.concat("text", F.lit(_LETTERS))
    return d("documents").select(
        "doc_id",
        F.md5(text.strip_accents(t)).alias("sem_acento"),
        F.md5(text.plain_upper(t)).alias("maiusculas"),
    )


@query(
    "trim_and_blank_x2",
    """select doc_id, length(trim(both '* ' from text)) as n, nullif(trim(source), '') as source,
              nullif(trim(case when lang = 'en' then '  ' else lang end), '') as lang from documents""",
)
def _(d):
    lang = F.when(F.col("lang") == "en", "  ").otherwise(F.col("lang"))
    return d("documents").select(
        "doc_id",
        F.length(F.btrim("text", F.lit("* "))).cast("long").alias("n"),
        text.blank_to_null(F.col("source")).alias("source"),
        text.blank_to_null(lang).alias("lang"),
    )


_PARTS = r"string_split_regex(strip_accents(upper(trim(text, ' *'))), '\s*[/;-]\s*')"


@query(
    "cause_split_p5_x4",
    f"""select doc_id, len(p) as partes, md5(p[1]) as origem, md5(p[2]) as tipo, md5(p[3]) as causa,
               md5(case when len(p) >= 4 then array_to_string(p[4:], ' - ') end) as detalhe
        from (select doc_id, {_PARTS} as p from documents)""",
)
def _(d):
    split = d("documents").select("doc_id", text.cause_parts(F.col("text")).alias("p"))
    p = F.col("p")
    return split.select(
        "doc_id",
        F.size(p).cast("long").alias("partes"),
        *[F.md5(text.cause_level(p, i)).alias(n) for i, n in ((1, "origem"), (2, "tipo"), (3, "causa"))],
        F.md5(text.cause_detail(p)).alias("detalhe"),
    )


@query(
    "synonyms_p6",
    """select case o_orderpriority when '1-URGENT' then '1' when '2-HIGH' then '1'
                   when '5-LOW' then 'LOW' else o_orderpriority end as prioridade, count(*) as n
       from orders group by 1""",
)
def _(d):
    same = {"1-URGENT": "1", "2-HIGH": "1", "5-LOW": "LOW"}
    name = text.canonical(F.col("o_orderpriority"), same).alias("prioridade")
    return d("orders").groupBy(name).agg(F.count(F.lit(1)).alias("n"))


@query(
    "safe_cast_x1_x14",
    """select event_id, try_cast(value as integer) as de_numero,
              try_cast(cast(value as varchar) as integer) as de_texto,
              try_cast(event_type as integer) as de_palavra,
              try_cast(value * 1e8 as integer) as grande,
              try_cast(cast(event_id as varchar) || 'd' as integer) as com_sufixo,
              try_cast('  ' || cast(event_id as varchar) || ' ' as integer) as com_brancos,
              try_cast(cast(event_id % 100 as varchar) || 'e3' as integer) as com_expoente,
              try_cast(case when event_id % 2 = 0 then '' else '-' end as integer) as vazio,
              try_cast('1_' || cast(event_id as varchar) as integer) as com_traco,
              try_cast('0x' || cast(event_id % 90 + 10 as varchar) as integer) as hexadecimal from events""",
)
def _(d):
    rows = d("events").select(
        "event_id",
        F.col("value").alias("numero"),
        F.col("value").cast("string").alias("texto"),
        F.col("event_type").alias("palavra"),
        (F.col("value") * 1e8).alias("grande"),
        F.concat(F.col("event_id").cast("string"), F.lit("d")).alias("com_sufixo"),
        F.concat(F.lit("  "), F.col("event_id").cast("string"), F.lit(" ")).alias("com_brancos"),
        F.concat((F.col("event_id") % 100).cast("string"), F.lit("e3")).alias("com_expoente"),
        F.when(F.col("event_id") % 2 == 0, "").otherwise("-").alias("vazio"),
        F.concat(F.lit("1_"), F.col("event_id").cast("string")).alias("com_traco"),
        F.concat(F.lit("0x"), (F.col("event_id") % 90 + 10).cast("string")).alias("hexadecimal"),
    )
    forms = ["com_sufixo", "com_brancos", "com_expoente", "vazio", "com_traco", "hexadecimal"]
    return rows.select(
        "event_id",
        *[numbers.to_int(rows, form).alias(form) for form in forms],
        numbers.to_int(rows, "numero").alias("de_numero"),
        numbers.to_int(rows, "texto").alias("de_texto"),
        numbers.to_int(rows, "palavra").alias("de_palavra"),
        numbers.to_int(rows, "grande").alias("grande"),
    )


@query(
    "ratios_over_zero_x15",
    """select user_id, count(*) as n, round(sum(case when event_type = 'error' then 1 else 0 end)
                / nullif(cast(sum(case when event_type = 'view' then 1 else 0 end) as double), 0), 6) as razao
       from events group by user_id""",
)
def _(d):
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    return d("events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(numbers.ratio(n("error"), n("view")), 6).alias("razao")
    )


# --- normalisation ----------------------------------------------------------------------

_ORDER_LINES = """from lineitem l join orders o on o.o_orderkey = l.l_orderkey
                  left join part p on p.p_partkey = l.l_partkey"""
_START = "o.o_orderdate + to_hours(cast(l.l_partkey % 24 as integer))"
_KEPT = """* exclude (inicio, fim), cast(starts_with(tipo, 'PROGRAMADA') as varchar) as programada,
    date_diff('second', timestamp '2017-01-01', inicio)::integer as inicio_s,
    try_cast(epoch(fim::timestamp) - epoch(inicio) as integer) as duracao_s"""

_LEGACY = f"""
    select {_KEPT} from (
      select cast(year(fim) as integer) as ano, conjunto, cast(null as integer) as municipio_ibge,
             distribuidora, alimentador, subestacao, inicio, fim,
             case partes[1] when 'INTERNO' then 'INTERNA' else partes[1] end as origem,
             partes[2] as tipo, partes[3] as causa,
             case when len(partes) >= 4 then array_to_string(partes[4:], ' - ') end as detalhe,
             cast(null as varchar) as localizacao, cast(null as varchar) as motivo_expurgo,
             nivel_tensao, consumidores_afetados, 1000 as consumidores_conjunto
      from (select *, regexp_split_to_array(upper(strip_accents(trim(both '* ' from cru))), '\\s*[-;/]\\s*') as partes from (
        select cast(o.o_custkey as integer) as conjunto, 'D' || cast(l.l_suppkey as varchar) as distribuidora,
               'A' || cast(l.l_partkey as varchar) as alimentador,
               case when l.l_linenumber <> 1 then 'S1' end as subestacao,
               case when l.l_linenumber <> 6 then {_START} end as inicio, l.l_shipdate as fim,
               case when l.l_returnflag = 'R' then '***Interno' else '* Interna' end || sep
                 || case when l.l_returnflag = 'A' then 'Programada' else 'Não programada' end || sep
                 || lower(p.p_type) || sep || p.p_brand || case when l.l_linenumber = 7 then ' - SEP' else '' end as cru,
               try_cast('1380' || cast(l.l_linenumber as varchar) || '.5' as integer) as nivel_tensao,
               cast(l.l_quantity as integer) as consumidores_afetados
        from (select *, [' - ', ';', '/'][l_linenumber % 3 + 1] as sep from lineitem) l
        join orders o on o.o_orderkey = l.l_orderkey left join part p on p.p_partkey = l.l_partkey)))
    where inicio is not null"""

_CURRENT = f"""
    select {_KEPT} from (
      select cast(year(l.l_shipdate) as integer) as ano, cast(o.o_custkey as integer) as conjunto,
             case when l.l_linenumber <> 2 then cast(l.l_suppkey as integer) end as municipio_ibge,
             'D' || cast(l.l_suppkey as varchar) as distribuidora, cast(l.l_partkey as varchar) as alimentador,
             case when l.l_linenumber <> 1 then 'S1' end as subestacao, {_START} as inicio, l.l_shipdate as fim,
             'INTERNA' as origem,
             case l.l_returnflag when 'A' then 'PROGRAMADA' when 'R' then 'NAO PROGRAMADA' end as tipo,
             p.p_type as causa, case when p.p_brand = 'Brand#1' then 'CORROSAO' else upper(p.p_brand) end as detalhe,
             l.l_returnflag as localizacao,
             case when l.l_returnflag = 'R' then 'Situação de emergência' end as motivo_expurgo,
             try_cast(cast(13800.5 as double) as integer) as nivel_tensao,
             cast(l.l_quantity as integer) as consumidores_afetados, 1000 as consumidores_conjunto
      {_ORDER_LINES})"""

_SUMMARY = """select programada, origem, tipo, causa, detalhe, count(*) as n,
    cast(sum(ano) as bigint) as anos, cast(sum(conjunto) as bigint) as conjuntos,
    cast(sum(municipio_ibge) as bigint) as municipios, count(distinct distribuidora) as distribuidoras,
    count(distinct alimentador) as alimentadores, count(subestacao) as subestacoes,
    cast(sum(inicio_s) as bigint) as inicios, cast(sum(duracao_s) as bigint) as duracoes,
    count(localizacao) as localizacoes, count(motivo_expurgo) as expurgos,
    cast(sum(nivel_tensao) as bigint) as tensoes, cast(sum(consumidores_afetados) as bigint) as afetados,
    cast(sum(consumidores_conjunto) as bigint) as totais from ({}) group by all"""


def _fact_summary(fact: DataFrame) -> DataFrame:
    total = lambda c, name: F.sum(F.col(c).cast("long")).alias(name)
    return fact.groupBy("programada", "origem", "tipo", "causa", "detalhe").agg(
        F.count(F.lit(1)).alias("n"),
        total("ano", "anos"),
        total("conjunto", "conjuntos"),
        total("municipio_ibge", "municipios"),
        F.countDistinct("distribuidora").alias("distribuidoras"),
        F.countDistinct("alimentador").alias("alimentadores"),
        F.count("subestacao").alias("subestacoes"),
        total("inicio_s", "inicios"),
        total("duracao_s", "duracoes"),
        F.count("localizacao").alias("localizacoes"),
        F.count("motivo_expurgo").alias("expurgos"),
        total("nivel_tensao", "tensoes"),
        total("consumidores_afetados", "afetados"),
        total("consumidores_conjunto", "totais"),
    )


def _readable(fact: DataFrame) -> DataFrame:
    """The three-valued flag as text, so null compares as null everywhere."""
    return fact.withColumn("programada", F.col("programada").cast("string"))


@query("normalise_legacy_p3_p4", _LEGACY)
def _(d):
    return _readable(normalise.normalise(fx.legacy_source(d)))


@query("normalise_current_p2_p4", _CURRENT)
def _(d):
    return _readable(normalise.normalise(fx.current_source(d)))


@query("normalise_both_layouts_u2", _SUMMARY.format(f"{_LEGACY} union all {_CURRENT}"))
def _(d):
    both = [normalise.normalise(s) for s in (fx.legacy_source(d), fx.current_source(d))]
    return _fact_summary(_readable(normalise.union_years(both)))


# --- bridge and dimensions -----------------------------------------------------------------


@query("links_per_uf_a1", "select conjunto, uf, count(*) as n from bruta group by conjunto, uf")
def _(d):
    return dims.links_per_uf(fx.raw_bridge(d))


@query("majority_uf_a2_w1", "select * from majoritaria")
def _(d):
    return dims.majority_uf(fx.raw_bridge(d))


@query("clean_bridge_j1", "select * from limpa")
def _(d):
    return dims.clean_bridge(fx.raw_bridge(d))


@query(
    "dropped_links_a38_j17",
    "select (select count(*) from bruta) - (select count(*) from limpa) as descartados",
)
def _(d):
    return dims.dropped_links(fx.raw_bridge(d))


@query("zone_names_a3_u1", "select * from nomes")
def _(d):
    return dims.zone_names(dims.name_rows([fx.name_source(d, True), fx.name_source(d, False)]))


@query(
    "zone_dimension_a4_j2",
    """select l.conjunto, n.nome, any_value(l.uf) as uf, count(*) as qtd_municipios, count(*) = 1 as municipio_unico,
              min(l.municipio_ibge) as municipio_ibge_unico, string_agg(l.municipio, ', ' order by l.municipio) as municipios
       from limpa l left join nomes n on n.conjunto = l.conjunto group by l.conjunto, n.nome""",
)
def _(d):
    names = dims.zone_names(dims.name_rows([fx.name_source(d, True), fx.name_source(d, False)]))
    return dims.zone_dimension(dims.clean_bridge(fx.raw_bridge(d)), names)


# --- audits ------------------------------------------------------------------------------------

_BROKEN = {
    "no_zone": "count(*) - count(conjunto)",
    "no_start": "count(*) - count(inicio)",
    "start_outside": "count(*) filter (inicio < timestamp '1996-01-01' or inicio >= timestamp '2001-01-01')",
    "negative_customers": "count(*) filter (sign(consumidores_afetados) = -1)",
    "negative_duration": "count(*) filter (sign(duracao_s) = -1)",
    "more_than_all": "count(*) filter (consumidores_conjunto - consumidores_afetados < 0)",
    "other_year": "count(*) filter (date_part('year', inicio) is distinct from ano and ano is not null and inicio is not null)",
    "no_duration": "count(*) filter (sign(duracao_s) = 0)",
    "no_customers": "count(*) filter (sign(consumidores_afetados) = 0)",
    "no_detail": "count(*) - count(detalhe)",
    "no_cause": "count(*) - count(causa)",
    "unknown_voltage": "count(*) filter (nivel_tensao in (9999))",
    "over_three_days": "count(*) filter (duracao_s > 3 * 86400)",
}
_AUDIT = " union all ".join(
    f"select '{label.format(1996, 2000)}' as regra, {_BROKEN[name]} as n, count(*) as total, "
    f"cast({'null' if limit is None else limit} as bigint) as tolerado from fato"
    for name, label, limit in FACT_RULES
)


@query(
    "fact_audit_p12_a25",
    f"""select regra, n, round(100 * n / cast(total as double), 6) as pct, tolerado,
               case when tolerado is null then case when n > 0 then 'aviso' else 'ok' end
                    when n > tolerado then 'FALHA' else 'ok' end as situacao
        from ({_AUDIT})""",
)
def _(d):
    checked = audit.check(fx.fact_view(d), audit.fact_rules(1996, 2000))
    return checked.withColumn("pct", F.round("pct", 6))


_UNMATCHED = {
    "fact_zone": "fato where conjunto is null or conjunto not in (select conjunto from dim_conjunto)",
    "bridge_city": "ponte where municipio_ibge not in (select municipio_ibge from dim_municipio)",
    "bridge_shape": "(select conjunto from ponte except select conjunto from geo_conjunto)",
}


@query(
    "referential_audit_j16",
    "select *, case when n <= coalesce(tolerado, 0) then 'ok' when tolerado is null then 'aviso' else 'FALHA' end as situacao from ("
    + " union all ".join(
        f"select '{label}' as regra, count(*) as n, cast({'null' if limit is None else limit} as bigint) as tolerado from {_UNMATCHED[name]}"
        for name, label, limit in REFERENCE_RULES
    )
    + ")",
)
def _(d):
    look = fx.lookups(d)
    return audit.referential(
        fx.fact_view(d, cause=False),
        look.ponte_conjunto_municipio,
        look.dim_conjunto,
        look.dim_municipio,
        look.geo_conjunto,
    )


@query(
    "cube_reconciles_with_fact_a26",
    """select (select count(*) from fato) as fato,
              (select cast(sum(interrupcoes) as bigint) from mart_mensal) as cubo,
              (select count(*) from fato) = (select sum(interrupcoes) from mart_mensal) as fecha""",
)
def _(d):
    fact = fx.fact_view(d)
    return audit.reconcile(fact, cubes.monthly_cube(fact))


# --- files: written to shared scratch and read back ------------------------------------------------


@query(
    "parquet_scan_s1",
    """select o_orderstatus, o_orderpriority, count(*) as n, min(o_orderdate) as primeira,
              max(o_orderdate) as ultima from orders group by all""",
)
def _(d):
    return files.parquet(d.spark, f"{d.path}/orders.parquet").groupBy(
        "o_orderstatus", "o_orderpriority"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderdate").alias("primeira"),
        F.max("o_orderdate").alias("ultima"),
    )


def _written_fact(d: Data) -> str:
    """Stored fact by year of start, the stand-in for the year of the file."""
    path = files.scratch(d.spark, "interrupcoes")
    year = F.year(F.timestamp_seconds(F.col("inicio_s").cast("long") + 1483228800))
    files.write_fact(fx.stored_fact(d).withColumn("ano_arquivo", year), path)
    return path


@query(
    "fact_sink_and_partitioned_scan_s10_s4_o1",
    """select cast(year(inicio) as integer) as ano_arquivo, ano, count(*) as n,
              cast(sum(duracao_s) as bigint) as segundos, count(distinct conjunto) as conjuntos
       from fato group by 1, 2""",
)
def _(d):
    stored = files.stored_fact(d.spark, _written_fact(d))
    return stored.groupBy("ano_arquivo", "ano").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("duracao_s").cast("long")).alias("segundos"),
        F.countDistinct("conjunto").alias("conjuntos"),
    )


@query(
    "written_rows_per_year_s25_a42",
    "select cast(year(inicio) as integer) as ano_arquivo, count(*) as linhas from fato group by 1",
)
def _(d):
    return files.file_metrics(d.spark, _written_fact(d), ["ano_arquivo"]).select("ano_arquivo", "linhas")


@query(
    "year_from_file_name_s3",
    "select cast(year(o_orderdate) as integer) as ano, count(*) as n from orders group by 1",
)
def _(d):
    # One folder per year, named as the publisher names its files.
    root = files.scratch(d.spark, "bronze")
    rows = d("orders").select("o_orderkey", F.year("o_orderdate").alias("a"))
    named = rows.withColumn("arquivo", F.concat(F.lit("interrupcoes-"), F.col("a").cast("string")))
    named.select("o_orderkey", "arquivo").write.partitionBy("arquivo").parquet(root)
    back = d.spark.read.parquet(root).select("o_orderkey", files.file_year().alias("ano"))
    return back.groupBy("ano").agg(F.count(F.lit(1)).alias("n"))


@query("cube_sink_s14_o2", "select * from mart_duracao")
def _(d):
    path = files.scratch(d.spark, "mart_duracao")
    files.write_sorted(cubes.duration_cube(fx.fact_view(d)), path, ["conjunto", "ano"])
    return d.spark.read.parquet(path)


@query("climate_sink_s11_o3", "select * from clima")
def _(d):
    path = files.scratch(d.spark, "clima_conjunto_hora")
    files.write_sorted(fx.climate_hours(d), path, ["conjunto", "instante_utc"])
    return d.spark.read.parquet(path).select(
        "conjunto", "instante_utc", F.col("chuva_c").cast("int"), F.col("rajada_c").cast("int")
    )


@query(
    "bridge_csv_s5_p18",
    "select * from bruta where uf <> 'NATION_9'",
)
def _(d):
    # One state is written without its municipality code, so those rows must go.
    path = files.scratch(d.spark, "ponte.csv")
    code = F.when(F.col("uf") != "NATION_9", F.col("municipio_ibge").cast("string"))
    fx.raw_bridge(d).select(
        F.lit("2026-09-09").alias("DatGeracaoConjuntoDados"),
        F.col("conjunto").cast("string").alias("IdeConjUnidConsumidoras"),
        code.alias("CodMunicipio"),
        F.col("municipio").alias("NomMunicipio"),
        F.col("uf").alias("SigUF"),
    ).write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    return dims.bridge_rows(files.bridge_csv(d.spark, path))


@query(
    "municipality_json_s6",
    """select cast(c_custkey as integer) as municipio_ibge, c_name as municipio, upper(left(n_name, 2)) as uf,
              n_name as uf_nome, r_name as regiao
       from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
       where c_mktsegment <> 'FURNITURE'""",
)
def _(d):
    # Customers as nested municipality records; one segment has no parent.
    path = files.scratch(d.spark, "municipios.json")
    regions = d("region").withColumnRenamed("r_regionkey", "n_regionkey")
    nations = d("nation").join(regions, "n_regionkey").withColumnRenamed("n_nationkey", "c_nationkey")
    uf = F.struct(
        F.upper(F.left("n_name", F.lit(2))).alias("sigla"),
        F.col("n_name").alias("nome"),
        F.struct(F.col("r_name").alias("nome")).alias("regiao"),
    ).alias("UF")
    parent = F.struct(F.struct(uf).alias("mesorregiao"))
    d("customer").join(nations, "c_nationkey").select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_name").alias("nome"),
        F.when(F.col("c_mktsegment") != "FURNITURE", parent).alias("microrregiao"),
    ).write.json(path)
    return dims.municipalities(files.municipalities_json(d.spark, path, multiline=False))


@query(
    "geojson_features_s7",
    """select k as municipio_ibge, cast(count(distinct anel) filter (externo) as bigint) as partes,
              cast(count(distinct anel) as bigint) as aneis, round(any_value(area), 6) as area_graus
       from aneis join contorno using (k) group by k""",
)
def _(d):
    path = files.scratch(d.spark, "malhas.geojson")
    pairs = lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    shape = F.transform("partes", lambda part: F.transform(part, pairs))
    one = F.size("partes") == 1
    geometry_of = lambda kind, c: F.to_json(F.struct(F.lit(kind).alias("type"), c.alias("coordinates")))
    shape_json = F.when(one, geometry_of("Polygon", F.get(shape, F.lit(0)))).otherwise(
        geometry_of("MultiPolygon", shape)
    )
    document = F.concat(
        F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"codarea":"'),
        F.col("municipio_ibge").cast("string"),
        F.lit('"},"geometry":'),
        shape_json,
        F.lit("}]}"),
    )
    fx.meshes(d).select(document.alias("value")).write.text(path)
    features = files.geojson(d.spark, path, multiline=False)
    read = geo.mesh(features, F.lit("XX"))
    sizes = geo.shapes(read, "municipio_ibge").select("municipio_ibge", F.round("area_graus", 6).alias("area_graus"))
    return read.select(
        "municipio_ibge",
        F.size("partes").cast("long").alias("partes"),
        F.size(F.flatten("partes")).cast("long").alias("aneis"),
    ).join(sizes, "municipio_ibge")


@query(
    "registered_layers_s9_s12",
    """select uf, cast(sum(interrupcoes) as bigint) as interrupcoes, count(distinct i.conjunto) as conjuntos
       from mart_duracao i join dim_conjunto d on d.conjunto = i.conjunto group by uf""",
)
def _(d):
    root = files.scratch(d.spark, "camadas")
    paths = layers.Paths(f"{root}/bronze", f"{root}/prata", f"{root}/ouro")
    files.write_fact(
        fx.stored_fact(d, cause=False).withColumn("ano_arquivo", F.col("ano")), paths.silver("interrupcoes")
    )
    versions.save(
        d.spark, paths.ouro, "dim_conjunto", lambda path: files.write_table(fx.dim_conjunto(d), path)
    )
    layers.register(d.spark, paths)
    return d.spark.sql(
        """select uf, sum(interrupcoes) as interrupcoes, count(distinct i.conjunto) as conjuntos
           from mart_duracao i join dim_conjunto d on d.conjunto = i.conjunto group by uf"""
    )


# --- catalogue and refresh ---------------------------------------------------------------------------


@query(
    "resource_per_year_s19",
    """select ano, pos, url, formato from (
         select cast(regexp_extract(nome, '(20\\d{2})', 1) as integer) as ano, pos, url, formato,
                row_number() over (partition by nome order by (formato = 'ZIP'), pos) as k
         from (select 'arquivo ' || cast(year(o_orderdate) + 20 as varchar) as nome, o_orderkey as pos,
                      'u' || cast(o_orderkey as varchar) as url,
                      case o_orderstatus when 'F' then 'ZIP' when 'O' then 'PARQUET' end as formato from orders)
         where formato is not null)
       where k = 1 and ano >= 2017""",
)
def _(d):
    return catalog.pick_resources(fx.resources(d)).select("ano", "pos", "url", "formato")


@query("changed_resources_s17", "select chave, mudou from mudanca")
def _(d):
    return catalog.changed(fx.catalog_rows(d), fx.manifest_rows(d)).select("chave", "mudou")


@query(
    "pending_years_s18",
    """select ano, count(*) as n from mudanca
       where ano in (2016, 2018, 2020) and (mudou or ano not in (select year(o_orderdate) + 20 from orders
             where o_orderpriority = '2-HIGH' and o_totalprice > 0))
       group by ano""",
)
def _(d):
    present = (
        d("orders").filter("o_orderpriority = '2-HIGH' and o_totalprice > 0")
        .select((F.year("o_orderdate") + 20).alias("ano")).distinct()
    )
    due = catalog.pending_years(fx.catalog_rows(d), fx.manifest_rows(d), [2016, 2018, 2020], present)
    return due.groupBy("ano").agg(F.count(F.lit(1)).alias("n"))


@query(
    "latest_publication_s18",
    "select coalesce(max(coalesce(last_modified, '')), '') as publicado_em from catalogo",
)
def _(d):
    return catalog.latest_publication(fx.catalog_rows(d))


@query(
    "manifest_upsert_s21",
    """select coalesce(m.chave, c.chave) as chave,
              case when c.chave is not null then c.last_modified else m.last_modified end as last_modified,
              case when c.chave is not null then c.size else m.size end as size,
              case when c.chave is not null then nullif(c.hash, '') else m.hash end as hash,
              case when c.chave is not null then 'agora' else 'antes' end as baixado_em
       from manifesto m full outer join (select * from mudanca where mudou) c on c.chave = m.chave""",
)
def _(d):
    manifest = fx.manifest_rows(d)
    loaded = catalog.changed(fx.catalog_rows(d), manifest).filter("mudou").select(
        "chave", "url", "last_modified", "size", "hash",
        F.concat("chave", F.lit(".parquet")).alias("arquivo"),
        F.lit("agora").alias("baixado_em"), F.lit(1).cast("long").alias("linhas"),
    )
    merged = catalog.upsert_manifest(manifest, loaded)
    return merged.select("chave", "last_modified", "size", "hash", "baixado_em")


@query(
    "months_to_fetch_s22_u4",
    """select strftime(m, '%Y-%m-%d') as mes from (
         select unnest(generate_series(date_trunc('month', (select min(o_orderdate) from orders))::timestamp,
                                       (select max(o_orderdate) from orders), interval 1 month)) as m)
       where date_trunc('month', m)::timestamp not in (
               select date_trunc('month', o_orderdate)::timestamp from orders
               where o_orderstatus = 'F' and o_totalprice > 440000)
          or date_diff('day', cast(m as date), cast((select max(o_orderdate) from orders) as date)) <= 61""",
)
def _(d):
    orders = d("orders").select("o_orderdate", "o_orderstatus", "o_totalprice")
    span = orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    calendar = span.select(F.explode(catalog.months(F.col("a"), F.col("b"))).alias("mes"))
    have = orders.filter("o_orderstatus = 'F' and o_totalprice > 440000")
    present = have.select(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("mes"))
    due = catalog.months_to_fetch(calendar, present, span.select("b").scalar())
    return due.select(F.col("mes").cast("string").alias("mes"))


@query(
    "climate_lag_s23",
    """select strftime(max(o_orderdate), '%Y%m') as ultimo_mes, '202001' as disponivel_ate, 
              strftime(max(o_orderdate), '%Y%m') < '202001' as atrasado from orders""",
)
def _(d):
    present = d("orders").select(F.date_format("o_orderdate", "yyyyMM").alias("competencia"))
    return catalog.climate_lag(present, F.lit("2020-01-31"))


@query(
    "stale_periods_s24",
    """select competencia from (
         select strftime(o_orderdate, '%Y%m') as competencia, max(o_orderkey) as entrada,
                min(case when o_orderstatus = 'F' then o_orderkey + 14000 end) as saida from orders group by 1)
       where saida is null or entrada > saida""",
)
def _(d):
    month = F.date_format("o_orderdate", "yyyyMM").alias("competencia")
    inputs = d("orders").select(month, F.col("o_orderkey").alias("modificado"))
    outputs = d("orders").filter("o_orderstatus = 'F'").select(
        month, (F.col("o_orderkey") + 14000).alias("modificado")
    )
    return files.stale_outputs(inputs, outputs)


# --- tables kept up to date -----------------------------------------------------------------


def _republished(d: Data) -> layers.Paths:
    """A fact whose year 1995 came again with even zones only, after its cubes were made."""
    root = files.scratch(d.spark, "base")
    paths = layers.Paths(f"{root}/bronze", f"{root}/prata", f"{root}/ouro")
    rows = fx.stored_fact(d).withColumn(partials.YEAR, F.col("ano"))
    files.write_fact(rows, paths.silver(layers.FACT))
    partials.renew(d.spark, paths, details=fx.WEATHER_BRANDS)
    files.write_fact(rows.filter("ano = 1995 and conjunto % 2 = 0"), paths.silver(layers.FACT))
    if partials.renew(d.spark, paths, details=fx.WEATHER_BRANDS) != [1995]:
        raise RuntimeError("another year than 1995 was made anew")
    return paths


# What is left of an event table after that.
_LEFT = "(ano <> 1995 or conjunto % 2 = 0)"


@query(
    "cubes_by_source_year_s14",
    f"""select conjunto, mes, causa, cast(programada as varchar) as programada, causa_climatica, distribuidora,
               count(*) as interrupcoes, sum(atingidos)::bigint as consumidores,
               round(sum(duracao_min), 4) as duracao_total_min, round(sum(atingidos * duracao_min), 4) as consumidor_minuto
        from linhas where {_LEFT} group by conjunto, mes, causa, programada, causa_climatica, distribuidora""",
)
def _(d):
    cube = partials.cube(d.spark, _republished(d), "mart_mensal")
    rounded = [F.round(c, 4).alias(c) for c in ("duracao_total_min", "consumidor_minuto")]
    return cube.select(
        "conjunto", "mes", "causa", F.col("programada").cast("string").alias("programada"), "causa_climatica", "distribuidora",
        "interrupcoes", "consumidores", *rounded,
    )


@query(
    "hour_and_duration_cubes_by_source_year_s14",
    f"""select 'hora' as cubo, conjunto, ano, dia_semana::double as a, hora::double as b, causa_climatica, count(*) as interrupcoes
        from linhas where {_LEFT} group by all
        union all
        select 'duracao', conjunto, ano, if(piso > 0, piso, duracao_min - duracao_min % 15), null, causa_climatica, count(*)
        from linhas where {_LEFT} and duracao_min >= 0 group by all""",
)
def _(d):
    paths = _republished(d)
    week, length = (partials.cube(d.spark, paths, name) for name in ("mart_hora_semana", "mart_duracao"))
    same = lambda name, a, b: [F.lit(name).alias("cubo"), "conjunto", "ano", a.cast("double").alias("a"), b.cast("double").alias("b"), "causa_climatica", "interrupcoes"]
    return week.select(*same("hora", F.col("dia_semana"), F.col("hora"))).unionByName(length.select(*same("duracao", F.col("faixa_min"), F.lit(None))))


@query(
    "zones_by_period_bitmaps_a16_a24",
    f"""select * from (with r as (select * from linhas where {_LEFT})
        select 'mes' as grao, mes as periodo, count(distinct conjunto) as conjuntos from r group by mes
        union all select 'trimestre', time_bucket(interval 3 months, mes), count(distinct conjunto) from r group by 2
        union all select 'ano', date_trunc('year', mes)::timestamp, count(distinct conjunto) from r group by 2)""",
)
def _(d):
    maps = partials.zone_bitmaps(d.spark, _republished(d))
    grains = {"mes": "month", "trimestre": "quarter", "ano": "year"}
    return normalise.union_years([zones.zones_by_period(maps, grain).select(F.lit(name).alias("grao"), "periodo", "conjuntos") for name, grain in grains.items()])


@query(
    "zones_under_a_filter_bitmaps_a14",
    f"""select count(distinct i.conjunto) as conjuntos from linhas i join dim_conjunto dc on dc.conjunto = i.conjunto
        where {_LEFT.replace("conjunto", "i.conjunto")} and mes >= timestamp '1994-01-01' and mes < timestamp '1997-01-01'
          and not programada and causa_climatica and dc.uf in ('NATION_4', 'NATION_7')""",
)
def _(d):
    f = Filtro(1994, 1996, ufs=("NATION_4", "NATION_7"), programada="nao", so_climaticas=True)
    return zones.zones_in(partials.zone_bitmaps(d.spark, _republished(d)), f, fx.lookups(d))


@query(
    "counted_while_written_s25_p12",
    """select regra, n, tolerado from (
         select 'chuva ou rajada nula' as regra, count(*) filter (chuva_c is null or rajada_c is null) as n, cast(0 as bigint) as tolerado from clima
         union all select 'chuva negativa', count(*) filter (chuva_c < 0), 0 from clima
         union all select 'rajada não positiva', count(*) filter (rajada_c <= 0), 0 from clima
         union all select 'chuva acima de 100 mm/h', count(*) filter (chuva_c > 10000), 0 from clima
         union all select 'rajada acima de 150 km/h', count(*) filter (rajada_c > 15000), 0 from clima
         union all select 'linhas', count(*), null from clima)""",
)
def _(d):
    rules = audit.climate_rules()
    path = files.scratch(d.spark, "clima_conjunto_hora")
    seen = files.write_sorted(fx.climate_hours(d), path, ["conjunto", "instante_utc"], measures=audit.rule_counts(rules))
    total = d.spark.createDataFrame([("linhas", seen["linhas"], None)], "regra string, n long, tolerado long")
    return audit.check_written(d.spark, seen, rules).select("regra", "n", "tolerado").unionByName(total)
