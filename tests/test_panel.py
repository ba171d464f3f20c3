from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stormledger.operators import audit, cubes, dims, fact, panel
from stormledger.operators.filters import Filtro, Lookups

FACT = (
    "ano int, conjunto int, distribuidora string, inicio timestamp_ntz, duracao_min double, programada boolean, "
    "causa string, detalhe string, causa_climatica boolean, consumidores_afetados int, consumidores_conjunto int, nivel_tensao int"
)


@pytest.fixture(scope="module")
def rows(spark):
    out = []
    for i in range(400):
        zone = 1 if i % 3 == 0 else i % 7 + 2
        out.append((
            2018 + i % 4, zone, f"D{i % 5}", datetime(2018 + i % 4, i % 12 + 1, i % 28 + 1, i % 24), float(i * 11 % 900),
            [True, False, None][i % 3], [None, "A", "B", "C", "D"][i % 5], "VENTO" if i % 2 else None, bool(i % 2),
            (i * 7 % 50) if zone != 1 else 1, 40, 13800,
        ))
    return spark.createDataFrame(out, FACT)


@pytest.fixture(scope="module")
def lookups(spark):
    dim = spark.createDataFrame(
        [(z, f"Z{z}" if z != 3 else None, "MG" if z % 2 else "RJ", 1 + z % 2, f"m{z}") for z in range(1, 7)],
        "conjunto int, nome string, uf string, qtd_municipios long, municipios string",
    )
    bridge = spark.createDataFrame([(z, m) for z in range(1, 7) for m in (10, 10 + z)], "conjunto int, municipio_ibge int")
    cities = spark.createDataFrame([(m, f"c{m}", "MG", "SUDESTE" if m < 13 else "SUL") for m in range(10, 17)], "municipio_ibge int, municipio string, uf string, regiao string")
    geo = spark.createDataFrame([(z, f"POINT ({z} 0)") for z in (1, 2, 4)], "conjunto int, wkt string")
    return Lookups(dim, bridge, cities, geo)


def test_stored_and_live_cubes_answer_alike(rows, lookups):
    f = Filtro(2018, 2020, ufs=("MG",), programada="nao")
    live, stored = cubes.monthly_rows(rows), cubes.monthly_cube(rows)
    same = lambda q: [tuple(r) for r in q(live).collect()] == [tuple(r) for r in q(stored).collect()]
    assert same(lambda c: panel.series(c, f, lookups, "quarter"))
    assert same(lambda c: panel.zone_ranking(c, f, lookups))
    assert same(lambda c: panel.distributor_ranking(c, f, lookups))
    assert same(lambda c: panel.coverage_by_year(c))
    assert stored.agg(F.sum("interrupcoes")).first()[0] == rows.count()


def test_orphans_leave_only_under_a_geographic_filter(rows, lookups):
    total = lambda f: panel.series(cubes.monthly_rows(rows), f, lookups, "year").agg(F.sum("interrupcoes")).first()[0]
    assert total(Filtro()) == 400
    known = rows.join(lookups.dim_conjunto, "conjunto", "left_semi").count()
    assert total(Filtro(ufs=("MG", "RJ"))) == known < 400


def test_geographic_filters_do_not_multiply_rows(rows, lookups):
    total = lambda f: panel.series(cubes.monthly_rows(rows), f, lookups, "year").agg(F.sum("interrupcoes")).first()[0]
    assert total(Filtro(municipio_ibge=10)) == rows.filter("conjunto < 7").count()
    assert total(Filtro(regioes=("SUDESTE", "SUL"))) == rows.filter("conjunto < 7").count()
    assert total(Filtro(municipio_ibge=12)) == rows.filter("conjunto = 2").count()


def test_planned_has_three_states(rows, lookups):
    n = lambda p: Filtro(programada=p).rows(cubes.monthly_rows(rows)).count()
    assert n("todas") == 400 and n("programada") + n("nao") == rows.filter("programada is not null").count()


def test_reduced_filter_keeps_what_the_cube_has(rows):
    f = Filtro(distribuidoras=("D1",), causas=("A",), programada="nao", so_climaticas=True)
    assert f.rows(cubes.weekly_rows(rows), reduced=True).count() == rows.filter("causa_climatica").count()
    with pytest.raises(ValueError, match="causa.*distribuidora.*programada"):
        f.rows(cubes.weekly_rows(rows))


def test_open_period_has_no_last_year(rows, lookups):
    late = cubes.monthly_rows(rows).withColumn("mes", F.col("mes") + F.expr("interval 40 years"))
    count = lambda f: f.rows(late).count()
    assert count(Filtro()) == 400 and count(Filtro(ano_ini=2059)) + count(Filtro(ano_fim=2058)) == 400
    assert count(Filtro(2059, 2059)) == 100
    hours = cubes.weekly_rows(rows)
    assert Filtro(ano_ini=2020).rows(hours).count() == rows.filter("ano >= 2020").count()


def test_top_n_is_cut_by_the_shown_measure(rows, lookups):
    live = cubes.monthly_rows(rows)
    orders = {}
    for by in ("interrupcoes", "consumidores"):
        top = panel.zone_ranking(live, Filtro(), lookups, by, limit=5).collect()
        values = [r[by] for r in top]
        assert values == sorted(values, reverse=True) and len(top) == 5
        orders[by] = [r.conjunto for r in top]
    assert orders["interrupcoes"] != orders["consumidores"]
    for query in (panel.zone_ranking, panel.distributor_ranking, panel.zone_map):
        with pytest.raises(ValueError, match="ranking measure"):
            query(live, Filtro(), lookups, "conjunto; drop table x")


def test_zone_labels(rows, lookups):
    labels = {r.conjunto: r.rotulo for r in panel.zone_ranking(cubes.monthly_rows(rows), Filtro(), lookups, limit=20).collect()}
    assert labels[2] == "Z2 · m2" and labels[1] == "Z1 · 2 municípios"
    assert labels[3] == "Conjunto 3 · 2 municípios" and labels[8] is None
    drawn = panel.zone_map(cubes.monthly_rows(rows), Filtro(), lookups).collect()
    assert {r.conjunto for r in drawn} == {1, 2, 4} and all(r.wkt for r in drawn)


def test_median_lies_in_its_band(rows, lookups):
    durations = cubes.duration_rows(rows)
    median = panel.median_duration(durations, Filtro(), lookups).first()[0]
    values = sorted(r[0] for r in rows.select("duracao_min").collect())
    assert abs(median - values[len(values) // 2]) <= 15
    assert panel.median_duration(durations, Filtro(1990, 1991), lookups).first()[0] is None
    wide = durations.filter(F.lit(False)).select("conjunto", "ano", "causa_climatica", "faixa_min", "interrupcoes")
    wide = wide.union(rows.sparkSession.createDataFrame([(1, 2018, False, 720.0, 4)], wide.schema))
    assert panel.median_duration(wide, Filtro(), lookups).first()[0] == 727.5


def test_summary_over_nothing(rows, lookups):
    row = panel.summary(cubes.monthly_rows(rows), cubes.duration_rows(rows), Filtro(1990, 1991), lookups).first()
    assert row.conjuntos == 0 and row.interrupcoes is None and row.fracao_climatica is None and row.duracao_mediana is None


def test_weather_share_counts_unknown_as_not(spark):
    df = spark.createDataFrame([("VENTO",), (None,), ("X",), ("VENTO",)], "detalhe string")
    assert df.select(F.avg(fact.weather_related(F.col("detalhe")).cast("int"))).first()[0] == 0.5


def test_partial_periods_are_marked_not_removed(spark, lookups):
    points = [(z, datetime(2018, m, 1)) for m in range(1, 7) for z in range(10) if 1 < m < 6 or z < 3]
    live = spark.createDataFrame(points, "conjunto int, mes timestamp_ntz").withColumns(
        {"interrupcoes": F.lit(1), "consumidores": F.lit(1)}
    )
    window = panel.full_window(live)
    assert tuple(window.first()) == (datetime(2018, 2, 1), datetime(2018, 5, 1))
    marked = panel.mark_partial(panel.series(live, Filtro(), lookups), window).orderBy("periodo").collect()
    assert [r.parcial for r in marked] == [True, False, False, False, False, True]


def test_tail_folds_by_global_order(rows, lookups):
    live = cubes.monthly_rows(rows)
    order = panel.causes_by_weight(live)
    points = panel.by_cause(live, Filtro(causas=("D", "NAO INFORMADA")), lookups)
    folded = panel.fold_tail(points, order, keep=2)
    kept = [r.causa for r in order.limit(2).collect()]
    assert {r.causa for r in folded.collect()} <= set(kept) | {"Outras"}
    assert folded.agg(F.sum("interrupcoes")).first() == points.agg(F.sum("interrupcoes")).first()
    label = panel.cause_label(points).filter("causa = 'NAO INFORMADA'").first().rotulo
    assert label == "Nao informada"


def test_matrix_has_all_days_and_hours(rows, lookups):
    only = rows.filter(F.dayofweek("inicio") == 3)
    cells = panel.hour_by_weekday(cubes.weekly_rows(only), Filtro(), lookups)
    matrix = panel.weekday_matrix(cells).collect()
    assert [r.dia_semana for r in matrix] == list(range(7)) and len(matrix[0]) == 25
    assert sum(sum(r[1:]) for r in matrix) == only.count() == sum(matrix[2][1:])


def test_durations_and_tail(rows, lookups):
    bands = panel.duration_distribution(cubes.duration_rows(rows), Filtro(), lookups)
    assert bands.agg(F.sum("interrupcoes")).first()[0] == 400
    tail = panel.duration_tail(bands).first()
    assert tail.acima_720 == rows.filter("duracao_min >= 720").count() / 400 and tail.acima_4320 == 0.0


def test_audit_judges_by_tolerance(rows):
    bad = rows.withColumn("conjunto", F.when(F.col("conjunto") != 5, F.col("conjunto")))
    checked = {r.regra: r for r in audit.check(bad, audit.fact_rules()).collect()}
    assert len(checked) == 13
    assert checked["conjunto nulo"].situacao == "FALHA" and checked["conjunto nulo"].n > 0
    assert checked["afetados maior que o conjunto inteiro"].situacao == "ok"
    assert checked["afetados maior que o conjunto inteiro"].n > 0
    assert checked["sem causa"].situacao == "aviso" and checked["sem causa"].pct == 20.0
    assert audit.failures(audit.check(bad, audit.fact_rules()))[0].startswith("conjunto nulo")
    assert audit.failures(audit.check(rows, audit.fact_rules())) == []
    filed = rows.withColumn("ano_arquivo", F.lit(2018))
    assert audit.check(filed, [audit.file_year_rule()]).first().n == 300


def test_totals_and_references(rows, lookups, spark):
    assert audit.reconcile(rows, cubes.monthly_cube(rows)).first().fecha is True
    assert audit.reconcile(rows, cubes.monthly_cube(rows.limit(10))).first().fecha is False
    cities = lookups.dim_municipio.filter("municipio_ibge <> 10")
    out = {r.regra: r for r in audit.referential(rows, lookups.ponte_conjunto_municipio, lookups.dim_conjunto, cities, lookups.geo_conjunto).collect()}
    assert [r.n for r in out.values()] == [rows.filter("conjunto > 6").count(), 6, 3]
    assert [r.situacao for r in out.values()] == ["aviso", "FALHA", "FALHA"]


def test_grid_holes_are_counted(spark):
    full = [(z, datetime(2024, 1, 1, h)) for z in range(3) for h in range(5)]
    clima = spark.createDataFrame(full[:-2], "conjunto int, instante_utc timestamp_ntz")
    assert audit.completeness(clima).first().faltando == 2


def test_reporting_grain(rows):
    out = panel.reporting_grain(rows, min_rows=79).collect()
    assert len(out) == 5 and out[0].pct_uma_unidade >= out[-1].pct_uma_unidade
    assert panel.reporting_grain(rows).count() == 0


BRIDGE = [
    (15457, 4318804, "Soledade", "RS"), (15457, 4316808, "Sarandi", "RS"), (15457, 4300001, "Outra", "RS"),
    (15457, 2515302, "Soledade", "PB"), (15457, 4126256, "Sarandi", "PR"),
    (1, 2929305, "Sao Goncalo dos Campos", "BA"), (3, 2201002, "Arraial", "PI"), (3, 2202075, "Cajazeiras do Piaui", "PI"),
    (9, 3300000, "B", "RJ"), (9, 3100000, "A", "MG"), (4, 1, "x", None), (4, 2, "y", "SP"),
]


def test_bridge_keeps_the_majority_state(spark):
    raw = spark.createDataFrame(BRIDGE, "conjunto int, municipio_ibge int, municipio string, uf string")
    clean = dims.clean_bridge(raw)
    ufs = {(r.conjunto, r.uf) for r in clean.collect()}
    assert ufs == {(15457, "RS"), (1, "BA"), (3, "PI"), (9, "MG"), (4, "SP")}
    assert dims.dropped_links(raw).first()[0] == raw.count() - clean.count() == 4
    names = spark.createDataFrame([(3, "b"), (3, "a"), (3, "b"), (1, "z"), (1, "y")], "conjunto int, nome string")
    dim = {r.conjunto: r for r in dims.zone_dimension(clean, dims.zone_names(names)).collect()}
    assert dim[1].municipio_unico is True and dim[3].municipio_unico is False
    assert dim[3].nome == "b" and dim[1].nome == "y" and dim[9].nome is None
    assert dim[15457].municipios == "Outra, Sarandi, Soledade" and dim[15457].municipio_ibge_unico == 4300001


def test_filtered_queries_start_no_job_and_sum_before_the_join(rows, lookups, spark):
    """One plan at every size: no row is counted while it is built."""
    f = Filtro(ufs=("MG",), regioes=("SUDESTE", "SUL"), so_climaticas=True)
    live, hours, bands = cubes.monthly_rows(rows), cubes.weekly_rows(rows), cubes.duration_rows(rows)
    spark.sparkContext.setJobGroup("build", "building plans")
    built = [
        panel.series(live, f, lookups),
        panel.by_cause(live, f, lookups),
        panel.distributor_ranking(live, f, lookups),
        panel.hour_by_weekday(hours, f, lookups),
        panel.duration_distribution(bands, f, lookups),
        panel.median_duration(bands, f, lookups),
        panel.options(live, lookups),
    ]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("", "")
    assert all(df.count() for df in built)
    assert built[0]._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") >= 2
    kept = rows.filter("causa_climatica and conjunto in (1, 3, 5)").count()
    assert built[0].agg(F.sum("interrupcoes")).first()[0] == kept
