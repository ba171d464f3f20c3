"""The given tables read as the engine's tables.

``lineitem`` and ``orders`` give the fact, ``customer`` the zones, ``events`` the
hourly climate, ``embeddings`` the grid arrays. Each helper is a projection or
a join over whole tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stormledger.config import EPOCH
from stormledger.functions import times
from stormledger.operators import fact
from stormledger.operators.filters import Lookups

# --- fixed values -----------------------------------------------------------

# Brands that play the weather-related causes.
WEATHER_BRANDS = ("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6")
UNKNOWN_BRAND = "Brand#25"
UNKNOWN_TYPE = "PROMO"
SECONDS_PER_DAY_APART = 420
ZONE_CUSTOMERS = 45
RAIN_EVENTS = ("error", "signup")


@dataclass(frozen=True)
class Data:
    spark: SparkSession
    path: str

    def __call__(self, name: str) -> DataFrame:
        return _table(self.spark, f"{self.path}/{name}.parquet")


@lru_cache(maxsize=256)
def _table(spark: SparkSession, path: str) -> DataFrame:
    """One reader per session and table: each new one would read footers again."""
    return spark.read.parquet(path)


# --- fact -------------------------------------------------------------------------


def line_rows(d: Data, cause: bool = True) -> DataFrame:
    """Lines with their order and, when the cause is asked for, their part."""
    lines = d("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_shipdate",
    )
    orders = d("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    rows = lines.join(orders, "l_orderkey")
    if not cause:
        return rows
    parts = d("part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    return rows.join(parts, "l_partkey", "left")


def stored_fact(d: Data, cause: bool = True) -> DataFrame:
    """Day-grain fact in stored form. Half of the durations are negative."""
    text = F.lit(None).cast("string")
    days = F.date_diff("l_shipdate", "o_orderdate")
    flag = F.col("l_returnflag")
    return line_rows(d, cause).select(
        F.year("l_shipdate").alias("ano"),
        F.col("o_custkey").cast("int").alias("conjunto"),
        F.lit(None).cast("int").alias("municipio_ibge"),
        F.concat(F.lit("D"), F.col("l_suppkey").cast("string")).alias("distribuidora"),
        text.alias("alimentador"),
        text.alias("subestacao"),
        (
            F.date_diff("o_orderdate", F.lit(EPOCH).cast("date")) * F.lit(86_400)
            + (F.col("l_partkey") % 24).cast("int") * F.lit(3600)
        ).alias("inicio_s"),
        (days * F.lit(SECONDS_PER_DAY_APART)).alias("duracao_s"),
        F.when(flag == "R", True).when(flag == "A", False).alias("programada"),
        text.alias("origem"),
        text.alias("tipo"),
        (F.nullif("p_type", F.lit(UNKNOWN_TYPE)) if cause else text).alias("causa"),
        (F.nullif("p_brand", F.lit(UNKNOWN_BRAND)) if cause else text).alias("detalhe"),
        text.alias("localizacao"),
        text.alias("motivo_expurgo"),
        F.when(F.col("l_linenumber") == 7, 9999).otherwise(13800).alias("nivel_tensao"),
        F.col("l_quantity").cast("int").alias("consumidores_afetados"),
        F.lit(ZONE_CUSTOMERS).alias("consumidores_conjunto"),
    )


def fact_view(d: Data, cause: bool = True) -> DataFrame:
    return fact.fact_view(stored_fact(d, cause), WEATHER_BRANDS)


# --- dimensions ---------------------------------------------------------------------


def dim_conjunto(d: Data) -> DataFrame:
    """Customers as zones; those in debt are missing, so their rows are orphans."""
    many = F.col("c_mktsegment") == "BUILDING"
    nations = d("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        d("customer")
        .filter(F.col("c_acctbal") >= 0)
        .join(nations, "c_nationkey")
        .select(
            F.col("c_custkey").cast("int").alias("conjunto"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("nome"),
            F.col("n_name").alias("uf"),
            F.when(many, 2).otherwise(1).cast("long").alias("qtd_municipios"),
            F.concat(F.lit("M"), F.col("c_custkey").cast("string")).alias("municipios"),
        )
    )


def zone_bridge(d: Data) -> DataFrame:
    """A customer is linked to its nation and, for one segment, to the next one too."""
    nation = F.col("c_nationkey")
    both = F.when(
        F.col("c_mktsegment") == "BUILDING", F.array(nation, (nation + 1) % 25)
    ).otherwise(F.array(nation))
    return d("customer").select(
        F.col("c_custkey").cast("int").alias("conjunto"), F.explode(both).alias("municipio_ibge")
    )


def dim_municipio(d: Data) -> DataFrame:
    regions = d("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return d("nation").join(regions, "n_regionkey").select(
        F.col("n_nationkey").alias("municipio_ibge"),
        F.col("n_name").alias("municipio"),
        F.upper(F.left("r_name", F.lit(2))).alias("uf"),
        F.col("r_name").alias("regiao"),
    )


def geo_conjunto(d: Data) -> DataFrame:
    """Zones that have a shape: every customer of some means."""
    return d("customer").filter(F.col("c_acctbal") >= 500).select(
        F.col("c_custkey").cast("int").alias("conjunto"),
        F.concat(F.lit("POINT ("), F.col("c_custkey").cast("string"), F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(")")).alias("wkt"),
    )


def lookups(d: Data) -> Lookups:
    return Lookups(dim_conjunto(d), zone_bridge(d), dim_municipio(d), geo_conjunto(d))


def raw_bridge(d: Data) -> DataFrame:
    """Supplier x customer links with the customer's nation: many states per zone."""
    nations = d("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("uf"))
    customers = d("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    links = (
        d("lineitem").select("l_orderkey", "l_suppkey")
        .join(d("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
        .select("l_suppkey", "o_custkey")
        .distinct()
    )
    return (
        links.join(customers, "o_custkey")
        .join(nations, "c_nationkey")
        .select(
            F.col("l_suppkey").cast("int").alias("conjunto"),
            F.col("o_custkey").cast("int").alias("municipio_ibge"),
            F.col("c_name").alias("municipio"),
            "uf",
        )
    )


def name_source(d: Data, legacy: bool) -> DataFrame:
    """Part names as zone names in either layout, keyed by brand number."""
    key = F.regexp_extract("p_brand", r"(\d+)", 1)
    name = F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("DscConjuntoUnidadeConsumidora")
    rows = d("part")
    if legacy:
        return rows.filter("p_size <= 25").select(
            key.cast("long").alias("IdeConjuntoUnidadeConsumidora"), name
        )
    return rows.filter("p_size > 25").select(
        key.alias("CodConjUnidadeConsumidora"), name, F.lit(0).alias("CodMunicipioIBGE")
    )


# --- source layouts -------------------------------------------------------------------


def _separator() -> Column:
    return F.element_at(F.array(F.lit(" - "), F.lit(";"), F.lit("/")), (F.col("l_linenumber") % 3 + 1).cast("int"))


def legacy_source(d: Data) -> DataFrame:
    """The 18-column layout: one cause text, three separators, accents, synonyms."""
    sep = _separator()
    first = F.when(F.col("l_returnflag") == "R", "***Interno").otherwise("* Interna")
    kind = F.when(F.col("l_returnflag") == "A", "Programada").otherwise("Não programada")
    tail = F.when(F.col("l_linenumber") == 7, F.lit(" - SEP")).otherwise(F.lit(""))
    cause = F.concat(first, sep, kind, sep, F.lower("p_type"), sep, F.col("p_brand"), tail)
    hours = (F.col("l_partkey") % 24).cast("int")
    text = lambda value: F.lit(value).cast("string")
    return line_rows(d).select(
        F.lit(None).cast("date").alias("DatGeracaoConjuntoDados"),
        F.col("o_custkey").alias("IdeConjuntoUnidadeConsumidora"),
        text("X").alias("DscConjuntoUnidadeConsumidora"),
        F.concat(F.lit(" A"), F.col("l_partkey").cast("string")).alias("DscAlimentadorSubestacao"),
        F.when(F.col("l_linenumber") == 1, "  ").otherwise(" S1").alias("DscSubestacaoDistribuicao"),
        F.col("l_orderkey").cast("string").alias("NumOrdemInterrupcao"),
        text("X").alias("DscTipoInterrupcao"),
        F.lit(0).alias("IdeMotivoInterrupcao"),
        F.when(F.col("l_linenumber") != 6, times.add_hours(F.col("o_orderdate"), hours)).alias("DatInicioInterrupcao"),
        F.col("l_shipdate").alias("DatFimInterrupcao"),
        cause.alias("DscFatoGeradorInterrupcao"),
        F.concat(F.lit("1380"), F.col("l_linenumber").cast("string"), F.lit(".5")).alias("NumNivelTensao"),
        F.col("l_quantity").alias("NumUnidadeConsumidora"),
        F.lit(1000).alias("NumConsumidorConjunto"),
        F.year("l_shipdate").alias("NumAno"),
        text("DIST").alias("NomAgenteRegulado"),
        F.concat(F.lit(" D"), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("SigAgente"),
        F.lit(1).alias("NumCPFCNPJ"),
    )


def current_source(d: Data) -> DataFrame:
    """The 26-column layout: codes as text, the cause already in four columns."""
    hours = (F.col("l_partkey") % 24).cast("int")
    text = lambda value: F.lit(value).cast("string")
    none = F.lit(None).cast("string")
    return line_rows(d).select(
        F.lit(None).cast("date").alias("DatGeracaoConjuntoDados"),
        text("1").alias("NumCNPJDistribuidora"),
        text("DIST").alias("NomAgente"),
        F.concat(F.lit(" D"), F.col("l_suppkey").cast("string")).alias("SigAgente"),
        F.concat(F.col("l_suppkey").cast("string"), F.when(F.col("l_linenumber") == 2, "x").otherwise("")).alias("CodMunicipioIBGE"),
        F.col("l_orderkey").cast("string").alias("CodInterrupcao"),
        none.alias("CodEvento"),
        none.alias("CodOcorrencia"),
        F.col("o_custkey").cast("string").alias("CodConjUnidadeConsumidora"),
        text("X").alias("DscConjuntoUnidadeConsumidora"),
        F.col("l_partkey").alias("CodAlimentador"),
        F.when(F.col("l_linenumber") == 1, "  ").otherwise(" S1").alias("CodSubestacao"),
        F.year("l_shipdate").cast("string").alias("AnoCompetencia"),
        F.month("l_shipdate").alias("MesCompetencia"),
        F.concat(F.lit(" "), F.col("l_returnflag")).alias("DscLocalizacaoInterrupcao"),
        F.when(F.col("l_returnflag") == "R", "Situação de emergência").alias("DscMotivoExpurgo"),
        times.add_hours(F.col("o_orderdate"), hours).alias("DatInicioInterrupcao"),
        F.col("l_shipdate").alias("DatFimInterrupcao"),
        text(" interno ").alias("DscFatoGeradorOrigem"),
        F.when(F.col("l_returnflag") == "A", "Programada").when(F.col("l_returnflag") == "R", "Não progamada").alias("DscFatoGeradorTipo"),
        F.lower("p_type").alias("DscFatoGeradorCausa"),
        F.when(F.col("p_brand") == "Brand#1", "Maresia ou corrosão").otherwise(F.col("p_brand")).alias("DscFatoGeradorDetalhe"),
        F.lit(13800.5).alias("NumNivelTensao"),
        F.col("l_quantity").cast("string").alias("QtdConsumidoresAfetados"),
        F.lit(1000).alias("QtdConsumidoresAtivos"),
        none.alias("DscTipoElementoInterrompido"),
    )


# --- hourly climate ----------------------------------------------------------------------


def event_fact(d: Data) -> DataFrame:
    """Hour-grain fact: the events that stand for interruptions, in local time."""
    return d("events").filter(~F.col("event_type").isin(*RAIN_EVENTS)).select(
        F.year("ts").alias("ano"),
        F.col("user_id").cast("int").alias("conjunto"),
        F.col("ts").alias("inicio"),
        F.col("event_type").alias("causa"),
        F.concat(F.lit("D"), (F.col("user_id") % 7).cast("string")).alias("distribuidora"),
        (F.col("event_type") == "click").alias("programada"),
        (F.col("event_type") == "view").alias("causa_climatica"),
    )


def climate_hours(d: Data) -> DataFrame:
    """Users x hours, dense. Rain adds up the values of two event types.

    The hours run from the first to the last one seen, as an explode per user.
    """
    events = d("events").select(
        F.col("user_id").cast("int").alias("conjunto"),
        times.trunc("hour", times.local_to_utc(F.col("ts"))).alias("instante_utc"),
        F.when(F.col("event_type").isin(*RAIN_EVENTS), F.col("value")).alias("chuva"),
        F.col("value").alias("tudo"),
    )
    span = events.agg(F.min("instante_utc").alias("a"), F.max("instante_utc").alias("b"))
    hours = F.sequence(span.select("a").scalar(), span.select("b").scalar(), F.expr("interval 1 hour"))
    dense = events.select("conjunto").distinct().withColumn("instante_utc", F.explode(hours))
    seen = events.groupBy("conjunto", "instante_utc").agg(
        F.sum("chuva").alias("chuva"), F.sum("tudo").alias("tudo")
    )
    cents = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)) * 100.0)
    # Size estimates do not see the explode. Building on the seen hours keeps the
    # dense side from ever being broadcast; the key is fine, so no hash table is large.
    return dense.join(seen.hint("shuffle_hash"), ["conjunto", "instante_utc"], "left").select(
        "conjunto",
        "instante_utc",
        F.round(cents("chuva") / 20.0).cast("int").alias("chuva_c"),
        (F.round(cents("tudo") / 5.0) + 1000.0).cast("int").alias("rajada_c"),
    )


# --- geometry and grid -----------------------------------------------------------------------


def meshes(d: Data) -> DataFrame:
    """One concave polygon per customer; some have a hole, some a second part.

    Ring directions alternate, so the orientation step has work to do.
    """
    k = F.col("c_custkey")
    # Roots keep the corners off round numbers, where rounding could go either way.
    root = lambda n: F.sqrt((k + n).cast("double")) / F.lit(9973.0)
    x = (F.lit(-51.0) + (k * 37 % 1000) / F.lit(100.0) + root(1)).alias("x")
    y = (F.lit(-22.5) + (k * 61 % 800) / F.lit(100.0) + root(2)).alias("y")
    w = (F.lit(0.3) + (k % 7) * F.lit(0.05) + root(3)).alias("w")
    h = (F.lit(0.25) + (k % 5) * F.lit(0.07) + root(5)).alias("h")
    base = d("customer").select(
        k.cast("int").alias("municipio_ibge"), F.col("c_nationkey").cast("string").alias("uf"), k.alias("k"), x, y, w, h
    )
    X, Y, W, H, K = (F.col(c) for c in ("x", "y", "w", "h", "k"))
    point = lambda dx, dy: F.struct((X + dx).alias("x"), (Y + dy).alias("y"))
    zero = F.lit(0.0)
    outer = F.array(
        point(zero, zero), point(W, F.lit(0.03)), point(W * 0.9, H),
        point(W * 0.45, H * 0.4), point(F.lit(0.02), H * 0.9),
    )
    hole = F.array(point(W * 0.3, H * 0.1), point(W * 0.6, H * 0.15), point(W * 0.5, H * 0.3))
    second = F.array(point(W + 0.1, zero), point(W + 0.3, F.lit(0.1)), point(W + 0.1, F.lit(0.25)))
    turn = lambda ring: F.when(K % 2 == 1, F.reverse(ring)).otherwise(ring)
    first = F.when(K % 5 == 0, F.array(turn(outer), hole)).otherwise(F.array(turn(outer)))
    parts = F.when(K % 4 == 0, F.array(first, F.array(turn(second)))).otherwise(F.array(first))
    return base.select("municipio_ibge", "uf", parts.alias("partes"))


def shape_bridge(d: Data) -> DataFrame:
    """Three customers per zone, and every third one shared with the zone before."""
    k = F.col("c_custkey").cast("int")
    zone = F.floor(k / 3).cast("int")
    both = F.when((k % 3 == 0) & (zone > 0), F.array(zone, zone - 1)).otherwise(F.array(zone))
    return d("customer").select(
        F.explode(both).alias("conjunto"), k.alias("municipio_ibge"), F.col("c_name").alias("municipio"),
        F.col("c_nationkey").cast("string").alias("uf"),
    )


def bricks(d: Data) -> DataFrame:
    """A wall of one brick per customer, every other row shifted, cut into zones with gaps.

    Corners meet the middle of sides. Of ten by ten bricks one zone has about
    three in five and another the rest, so zones have holes, islands and parts
    that meet in a point. Half of the rings run the other way.
    """
    k = F.col("c_custkey")
    i, j = k % 100, F.floor(k / 100)
    x, y = F.lit(-60.0) + (2 * i + j % 2) * F.lit(0.125), F.lit(-30.0) + j * F.lit(0.25)
    zone = ((F.floor(j / 10) * 10 + F.floor(i / 10)) * 2 + F.when(k * 7919 % 101 < 61, 0).otherwise(1)).cast("int")
    at = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    ring = F.array(at(0.0, 0.0), at(0.25, 0.0), at(0.25, 0.25), at(0.0, 0.25))
    ring = F.when(k % 2 == 1, F.reverse(ring)).otherwise(ring)
    return d("customer").select(k, x.alias("x"), y.alias("y"), zone.alias("conjunto")).select("conjunto", k.cast("int").alias("municipio_ibge"), F.array(F.array(ring)).alias("partes"))


def crossed(d: Data) -> DataFrame:
    """One ring per customer that crosses itself, with a spike that it runs forth and back."""
    k = F.col("c_custkey")
    w, h = F.lit(0.5) + (k % 7) * F.lit(0.05), F.lit(0.4) + (k % 5) * F.lit(0.07)
    x, y = F.lit(-51.0) + (k * 37 % 1000) / F.lit(100.0), F.lit(-22.5) + (k * 61 % 800) / F.lit(100.0)
    at = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    W, H = F.col("w"), F.col("h")
    ring = F.array(at(F.lit(0.0), F.lit(0.0)), at(W, H), at(W + 1.0, H), at(W, H), at(W, H * 0.1), at(F.lit(0.0), H * 0.8))
    rows = d("customer").select(k.cast("int").alias("municipio_ibge"), x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"))
    return rows.select("municipio_ibge", F.array(F.array(ring)).alias("partes"))


def grid_steps(d: Data) -> DataFrame:
    """Embeddings as hourly 8 x 8 fields: rain in metres, gust in metres per second."""
    v = F.col("embedding")
    axis = lambda start: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.lit(start) + i * F.lit(0.25))
    when = times.add_hours(F.lit("2024-01-01").cast("timestamp_ntz"), F.col("vec_id"))
    return d("embeddings").select(
        when.alias("valid_time"),
        axis(-20.0).alias("latitude"),
        axis(-48.0).alias("longitude"),
        F.transform(v, lambda e: e.cast("double") * 0.01).alias("tp"),
        F.transform(v, lambda e: F.abs(e.cast("double")) * 40.0).alias("fg10"),
    )


# --- catalogue of resources ----------------------------------------------------------------------


def resources(d: Data) -> DataFrame:
    """Orders as published files: a year in the name, a format, a position."""
    status = F.col("o_orderstatus")
    return d("orders").select(
        F.concat(F.lit("arquivo "), (F.year("o_orderdate") + 20).cast("string")).alias("name"),
        F.when(status == "F", "zip").when(status == "O", "Parquet").alias("format"),
        F.col("o_orderkey").alias("pos"),
        F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("url"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_modified"),
        F.round("o_totalprice").cast("long").alias("size"),
    )


def catalog_rows(d: Data) -> DataFrame:
    """Orders as catalogue entries; a third of them carry no hash."""
    key = F.col("o_orderkey")
    return d("orders").select(
        key.cast("string").alias("chave"),
        (F.year("o_orderdate") + 20).alias("ano"),
        F.concat(F.lit("u"), key.cast("string")).alias("url"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_modified"),
        F.round("o_totalprice").cast("long").alias("size"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("h"), (key % 10).cast("string"))).otherwise("").alias("hash"),
    )


def manifest_rows(d: Data) -> DataFrame:
    """An older snapshot: most orders, some with another date, size or hash."""
    key, urgent = F.col("o_orderkey"), F.left("o_orderpriority", F.lit(1))
    none = F.lit(None).cast("string")
    return d("orders").filter(urgent != "5").select(
        key.cast("string").alias("chave"),
        F.concat(F.lit("u"), key.cast("string")).alias("url"),
        F.when(urgent != "1", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_modified"),
        (F.round("o_totalprice") + F.when(urgent == "2", 1).otherwise(0)).cast("long").alias("size"),
        F.when(urgent != "3", F.concat(F.lit("h"), (key % 9).cast("string"))).alias("hash"),
        none.alias("arquivo"),
        F.lit("antes").alias("baixado_em"),
        F.lit(None).cast("long").alias("linhas"),
    )
