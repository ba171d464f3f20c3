"""Checks on the curated base. They report and never repair."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stormledger.config import CLIMATE_RULES, FACT_RULES, FIRST_YEAR, LAST_YEAR, REFERENCE_RULES

Rule = tuple[str, Column, int | None]


def _ruled(fixed, conditions: dict[str, Column], *values) -> list[Rule]:
    """Labels and tolerances of the fixed list, each with its condition."""
    return [(label.format(*values), conditions[name], tolerated) for name, label, tolerated in fixed]


def fact_rules(first: int = FIRST_YEAR, last: int = LAST_YEAR) -> list[Rule]:
    """(label, condition, tolerated); None only warns.

    The numbers are the defects the source is known to carry.
    """
    c, start_year = F.col, F.year("inicio")
    affected, minutes = c("consumidores_afetados"), c("duracao_min")
    conditions = {
        "no_zone": c("conjunto").isNull(),
        "no_start": c("inicio").isNull(),
        "start_outside": ~start_year.between(first, last),
        "negative_customers": affected < 0,
        "negative_duration": minutes < 0,
        "more_than_all": affected > c("consumidores_conjunto"),
        "other_year": c("ano") != start_year,
        "no_duration": minutes == 0,
        "no_customers": affected == 0,
        "no_detail": c("detalhe").isNull(),
        "no_cause": c("causa").isNull(),
        "unknown_voltage": c("nivel_tensao") == 9999,
        "over_three_days": minutes > 4320,
    }
    return _ruled(FACT_RULES, conditions, first, last)


def file_year_rule(column: str = "ano_arquivo") -> Rule:
    """Year of the source file against the year of the start."""
    return ("ano do arquivo diferente do ano de início", F.col(column) != F.year("inicio"), None)


def climate_rules() -> list[Rule]:
    rain, gust = F.col("chuva_c"), F.col("rajada_c")
    conditions = {
        "missing": rain.isNull() | gust.isNull(),
        "negative_rain": rain < 0,
        "no_gust": gust <= 0,
        "rain_over": rain > 10_000,
        "gust_over": gust > 15_000,
    }
    return _ruled(CLIMATE_RULES, conditions)


def _verdict(n: Column, tolerated: Column) -> Column:
    return (
        F.when(tolerated.isNull() & (n > 0), "aviso")
        .when(tolerated.isNotNull() & (n > tolerated), "FALHA")
        .otherwise("ok")
    )


def rule_counts(rules: list[Rule]) -> dict[str, Column]:
    """An aggregate per rule, for ``check`` or for the job that writes the rows."""
    return {f"r{i}": F.count_if(condition) for i, (_, condition, _) in enumerate(rules)}


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rules in one pass over the rows: label, count, percentage, verdict."""
    measures = [c.alias(name) for name, c in rule_counts(rules).items()]
    return told(df.agg(F.count(F.lit(1)).alias("total"), *measures), rules)


def check_written(spark: SparkSession, counts: dict[str, int], rules: list[Rule]) -> DataFrame:
    """The same report from counts that a write has gathered."""
    names = ["linhas", *rule_counts(rules)]
    row = spark.createDataFrame([tuple(counts[name] for name in names)], ", ".join(f"{name} long" for name in names))
    return told(row.withColumnRenamed("linhas", "total"), rules)


def told(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """The report from one row of counts."""
    entries = [
        F.struct(
            F.lit(label).alias("regra"),
            F.col(f"r{i}").alias("n"),
            F.lit(tolerated).cast("long").alias("tolerado"),
        )
        for i, (label, _, tolerated) in enumerate(rules)
    ]
    n, total, tolerated = F.col("n"), F.col("total"), F.col("tolerado")
    return counts.select("total", F.inline(F.array(*entries))).select(
        "regra",
        "n",
        (F.lit(100.0) * n / F.nullif(total.cast("double"), F.lit(0.0))).alias("pct"),
        "tolerado",
        _verdict(n, tolerated).alias("situacao"),
    )


def _missing(left: DataFrame, right: DataFrame, key: str, label: str, tolerated) -> DataFrame:
    """How many rows on the left have no partner; a null key has none.

    Rows are counted per key first, so the join sees one row per key.
    """
    per_key = left.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce(F.sum("n"), F.lit(0))
    limit = F.lit(tolerated).cast("long")
    return per_key.join(right.select(key), key, "left_anti").agg(n.alias("n")).select(
        F.lit(label).alias("regra"),
        "n",
        limit.alias("tolerado"),
        _verdict(F.col("n"), limit).alias("situacao"),
    )


def referential(
    fact: DataFrame, bridge: DataFrame, dim_conjunto: DataFrame, dim_municipio: DataFrame, geo: DataFrame
) -> DataFrame:
    zones = bridge.select("conjunto").distinct()
    sides = {
        "fact_zone": (fact, dim_conjunto, "conjunto"),
        "bridge_city": (bridge, dim_municipio, "municipio_ibge"),
        "bridge_shape": (zones, geo, "conjunto"),
    }
    checked = [_missing(*sides[name], label, tolerated) for name, label, tolerated in REFERENCE_RULES]
    return reduce(DataFrame.unionByName, checked)


def rows_per_year(fact: DataFrame, year: str = "ano") -> DataFrame:
    return fact.groupBy(year).agg(F.count(F.lit(1)).alias("linhas"))


def reconcile(fact: DataFrame, cube: DataFrame) -> DataFrame:
    """Fact rows against the cube's sum of events."""
    total = cube.agg(F.coalesce(F.sum("interrupcoes"), F.lit(0)).alias("cubo"))
    return fact.agg(F.count(F.lit(1)).alias("fato")).select(
        "fato", total.scalar().alias("cubo")
    ).withColumn("fecha", F.col("fato") == F.col("cubo"))


def completeness(clima: DataFrame) -> DataFrame:
    """The zone-hour table must be a full rectangle; how many pairs are missing?"""
    return clima.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.countDistinct("instante_utc").alias("horas"),
        F.countDistinct("conjunto").alias("conjuntos"),
    ).withColumn("faltando", F.col("horas") * F.col("conjuntos") - F.col("linhas"))


def failures(checked: DataFrame) -> list[str]:
    """Labels of failed rules, a handful at most; empty is what one hopes for."""
    failed = checked.filter(F.col("situacao") == "FALHA").select("regra", "n", "tolerado")
    return [f"{r.regra}: {r.n} (tolerado {r.tolerado})" for r in failed.collect()]
