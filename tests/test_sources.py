import os

import pytest
from pyspark.sql import functions as F

from stormledger.operators import panel
from stormledger.operators.filters import Filtro
from stormledger.plans import cycle
from stormledger.sources import catalog, files, layers, versions
from tests.test_geometry import SQUARE, frame, shifted
from tests.test_normalise import current, legacy

RESOURCE = "chave string, url string, last_modified string, size long, hash string"
MANIFEST = RESOURCE + ", arquivo string, baixado_em string, linhas long"


@pytest.mark.parametrize(
    "old, new, changed",
    [
        (None, ("d1", 10, ""), True),
        (("d1", 10, None), ("d1", 10, ""), False),
        (("d1", 10, ""), ("d2", 10, None), True),
        (("d1", 10, None), ("d1", 11, None), True),
        (("d1", 10, "a"), ("d2", 11, "a"), False),
        (("d1", 10, "a"), ("d1", 10, "b"), True),
        (("d1", 10, "a"), ("d1", 10, ""), False),
        (("d1", 10, ""), ("d2", 10, "b"), True),
        ((None, None, None), (None, None, None), False),
    ],
)
def test_change_detection(spark, old, new, changed):
    offered = spark.createDataFrame([("k", "u", *new)], RESOURCE)
    known = spark.createDataFrame([("k", "u", *old, "f", "t", None)] if old else [], MANIFEST)
    assert catalog.changed(offered, known).first().mudou is changed


def listing(spark):
    rows = [
        ("Interrupções 2016", "PARQUET", 0), ("Interrupções 2018", "zip", 1), ("Interrupções 2018", "parquet", 2),
        ("Interrupções 2018", "Parquet", 3), ("Interrupções 2019", "ZIP", 4), ("Interrupções 2019", "zip", 5),
        ("Dicionário 2020", "PDF", 6), ("sem ano", "PARQUET", 7), (None, "ZIP", 8), ("Interrupções 2021", None, 9),
    ]
    return spark.createDataFrame(
        [(n, f, p, f"u{p}", f"2024-0{p + 1 if p < 9 else 1}", 10, None) for n, f, p in rows],
        "name string, format string, pos int, url string, last_modified string, size long, hash string",
    )


def test_one_resource_per_year(spark):
    got = {r.ano: (r.formato, r.pos) for r in catalog.pick_resources(listing(spark)).collect()}
    assert got == {2018: ("PARQUET", 2), 2019: ("ZIP", 4)}


def test_pending_years_and_publication(spark):
    offered = catalog.pick_resources(listing(spark)).withColumn("chave", F.col("ano").cast("string"))
    known = offered.select(
        "chave", "url", "last_modified", "size", "hash", F.lit("f").alias("arquivo"),
        F.lit("t").alias("baixado_em"), F.lit(1).cast("long").alias("linhas"),
    )
    years = lambda df: sorted(r.ano for r in df.collect())
    assert years(catalog.pending_years(offered, known)) == []
    assert years(catalog.pending_years(offered, known.filter("chave <> '2019'"))) == [2019]
    assert years(catalog.pending_years(offered, known.limit(0), [2018])) == [2018]
    have = spark.createDataFrame([(2018,)], "ano int")
    assert years(catalog.pending_years(offered, known, None, have)) == [2019]
    assert catalog.latest_publication(offered).first()[0] == "2024-05"
    assert catalog.latest_publication(offered.limit(0)).first()[0] == ""


def test_manifest_upsert(spark):
    old = spark.createDataFrame([("a", "u", "d1", 1, "h", "f", "t", 5), ("b", "u", "d1", 1, "h", "f", "t", 5)], MANIFEST)
    new = spark.createDataFrame([("b", "v", "d2", 2, "", "g", "now", None), ("c", "v", "d2", 2, "x", "g", "now", 7)], MANIFEST)
    rows = {r.chave: r for r in catalog.upsert_manifest(old, new).collect()}
    assert set(rows) == {"a", "b", "c"} and rows["a"].linhas == 5
    assert rows["b"].hash is None and rows["b"].linhas is None and rows["b"].url == "v"


def test_months_to_fetch(spark):
    calendar = spark.range(1).select(
        F.explode(catalog.months(F.lit("2017-01-15"), F.lit("2017-06-02"))).alias("mes")
    )
    assert calendar.count() == 6
    present = calendar.filter("mes <> '2017-02-01'")
    due = lambda redo: [str(r.mes) for r in catalog.months_to_fetch(calendar, present, F.lit("2017-06-10"), redo).orderBy("mes").collect()]
    # 2017-04-10 is 61 days before: April is 70 days old, May 40, June 9.
    assert due(True) == ["2017-02-01", "2017-05-01", "2017-06-01"]
    assert due(False) == ["2017-02-01"]


def test_climate_lag(spark):
    have = lambda *m: spark.createDataFrame([(x,) for x in m], "competencia string")
    lag = lambda df: catalog.climate_lag(df, F.lit("2026-03-04")).first()
    assert lag(have()).atrasado is False and lag(have()).ultimo_mes is None
    assert lag(have("201912", "202001")).atrasado is True
    assert lag(have("202602")).atrasado is False and lag(have("202602")).disponivel_ate == "202602"


def test_outputs_older_than_inputs(spark, tmp_path):
    for folder, name, stamp in [("in", "202001", 100), ("out", "202001", 200), ("in", "202002", 300), ("out", "202002", 200), ("in", "202003", 100), ("in", "202004", 100), ("out", "202004", 100)]:
        (tmp_path / folder).mkdir(exist_ok=True)
        file = tmp_path / folder / f"m-{name}.bin"
        file.write_bytes(b"x")
        os.utime(file, (stamp, stamp))
    times = lambda folder: files.modification_times(spark, str(tmp_path / folder), r"m-(\d{6})")
    assert sorted(r[0] for r in files.stale_outputs(times("in"), times("out")).collect()) == ["202002", "202003"]


def test_bridge_csv_is_latin1(spark, tmp_path):
    file = tmp_path / "ponte.csv"
    file.write_text(
        "DatGeracaoConjuntoDados;IdeConjUnidConsumidoras;CodMunicipio;NomMunicipio;SigUF\n"
        "2026-09-09;1;2929305;São Gonçalo;BA\n2026-09-09;;2929305;X;BA\n2026-09-09;2;;X;BA\n",
        encoding="latin-1",
    )
    from stormledger.operators import dims

    rows = dims.bridge_rows(files.bridge_csv(spark, str(file))).collect()
    assert [tuple(r) for r in rows] == [(1, 2929305, "São Gonçalo", "BA")]


def test_fact_overwrites_only_its_years(spark, tmp_path):
    path = str(tmp_path / "fato")
    rows = lambda year, n: spark.range(n).select(
        F.lit(year).alias("ano"), F.col("id").cast("int").alias("conjunto"), F.lit(1).alias("inicio_s"), F.lit(year).alias("ano_arquivo")
    )
    files.write_fact(rows(2018, 5).union(rows(2019, 7)), path)
    files.write_fact(rows(2019, 2), path)
    got = {r.ano_arquivo: r for r in files.file_metrics(spark, path, ["ano_arquivo"]).collect()}
    assert {y: r.linhas for y, r in got.items()} == {2018: 5, 2019: 2} and got[2018].bytes > 0
    assert files.stored_fact(spark, path).filter("detalhe is null").count() == 7


def test_versions_switch_at_once(spark, tmp_path):
    root = str(tmp_path)
    assert versions.current(spark, root) == {}
    save = lambda n: versions.save(spark, root, "t", lambda path: spark.range(n).write.parquet(path))
    first = save(3)
    reader = spark.read.parquet(versions.current(spark, root)["t"])
    with pytest.raises(RuntimeError):
        versions.save(spark, root, "t", lambda path: (_ for _ in ()).throw(RuntimeError("lost")))
    assert versions.current(spark, root)["t"] == first
    save(5)
    assert spark.read.parquet(versions.current(spark, root)["t"]).count() == 5 and reader.count() == 3


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Two year files, one per layout, with bridge, mesh and two days of grid."""
    root = str(tmp_path_factory.mktemp("base"))
    paths = layers.Paths(f"{root}/bronze", f"{root}/prata", f"{root}/ouro")
    starts = F.timestamp_seconds(F.lit(1740823200) + F.col("IdeConjuntoUnidadeConsumidora") * 3600).cast("timestamp_ntz")
    old = legacy(spark, ["INTERNA - NAO PROGRAMADA - MEIO AMBIENTE - VENTO"] * 30, DatInicioInterrupcao=starts)
    old = old.withColumn("IdeConjuntoUnidadeConsumidora", F.col("IdeConjuntoUnidadeConsumidora") % 3 + 1)
    old.write.parquet(f"{paths.bronze}/interrupcoes-2025.parquet")
    current(spark, CodConjUnidadeConsumidora=F.lit("1"), DscConjuntoUnidadeConsumidora=F.lit("Novo")).write.parquet(
        f"{paths.bronze}/interrupcoes-2026.parquet"
    )
    cities = spark.createDataFrame(
        [(10, "Alfa", ((("MG", "Minas", ("Sudeste",)),),)), (11, "Beta", ((("MG", "Minas", ("Sudeste",)),),)), (12, "Ilha", None)],
        "id int, nome string, microrregiao struct<mesorregiao:struct<UF:struct<sigla:string,nome:string,regiao:struct<nome:string>>>>",
    )
    bridge = spark.createDataFrame(
        [("x", "1", "10", "Alfa", "MG"), ("x", "2", "10", "Alfa", "MG"), ("x", "2", "11", "Beta", "MG")],
        "DatGeracaoConjuntoDados string, IdeConjUnidConsumidoras string, CodMunicipio string, NomMunicipio string, SigUF string",
    )
    mesh = frame(spark, {10: [[shifted(SQUARE, -45.1, -19.1)]], 11: [[shifted(SQUARE, -44.1, -19.1)]]})
    axis = lambda a, n: F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.lit(a) + i * F.lit(0.25))
    steps = spark.range(72).select(
        F.timestamp_seconds(F.lit(1740787200) + F.col("id") * 3600).cast("timestamp_ntz").alias("valid_time"),
        axis(-19.5, 7).alias("latitude"), axis(-45.5, 11).alias("longitude"),
        F.transform(F.sequence(F.lit(0), F.lit(95)), lambda i: F.when(F.col("id") % 24 == 15, 0.006).otherwise(0.0)).alias("tp"),
        F.transform(F.sequence(F.lit(0), F.lit(95)), lambda i: F.lit(7.0)).alias("fg10"),
    )
    return paths, cities, bridge, mesh, steps


def test_cycle_from_files_to_panel(spark, base):
    paths, cities, bridge, mesh, steps = base
    assert cycle.curate_fact(spark, paths) == [2025, 2026]
    per_year = {r.ano_arquivo: r.linhas for r in cycle.curated_rows(spark, paths).collect()}
    assert per_year == {2025: 30, 2026: 1}
    cycle.curate_dimensions(spark, paths, cities, bridge)
    cycle.curate_geometry(spark, paths, mesh)
    cycle.curate_weights(spark, paths, mesh)
    cycle.curate_climate(spark, paths, steps)
    sizes = {r.tabela: r.linhas for r in cycle.publish(spark, paths).collect()}
    assert sizes["dim_municipio"] == 2 and sizes["dim_conjunto"] == 2
    assert sizes["mart_clima_perfil_defasagem"] > 0 and sizes["mart_clima_risco_por_chuva"] == 2
    assert cycle.published_totals(cycle.publish(spark, paths)).first().tabelas == len(sizes) == 11

    # Published after the fact was written: queries read the stored cube, not the fact.
    layers.register(spark, paths)
    read = layers.measure_rows(spark, "mart_mensal").inputFiles()
    assert read and all("/ouro/mart_mensal/" in f for f in read)
    # Written again since: cubes are live over the fact.
    cycle.curate_fact(spark, paths)
    layers.register(spark, paths)
    assert all("/prata/interrupcoes/" in f for f in layers.measure_rows(spark, "mart_mensal").inputFiles())
    assert layers.mode(spark) == "completo" and "clima_conjunto_hora" in layers.tables(spark)
    live = panel.coverage_by_year(layers.measure_rows(spark, "mart_mensal")).collect()
    assert [(r.ano, r.interrupcoes) for r in live] == [(2025, 30), (2026, 1)]
    top = panel.zone_ranking(layers.measure_rows(spark, "mart_mensal"), Filtro(), layers.lookups(spark)).collect()
    assert {r.conjunto: r.rotulo for r in top}[1] == "X · Alfa"

    # Published: only gold, and the same answers.
    layers.register(spark, layers.Paths(paths.bronze, paths.prata, paths.ouro, published=True))
    assert layers.mode(spark) == "publicado" and "clima_conjunto_hora" not in layers.tables(spark)
    stored = panel.coverage_by_year(layers.measure_rows(spark, "mart_mensal")).collect()
    assert stored == live and spark.table("mart_clima_risco_por_rajada").count() == 1
    hours = spark.read.parquet(paths.silver("clima_conjunto_hora"))
    assert hours.groupBy("conjunto").count().collect() == [(1, 72), (2, 72)] or hours.count() == 144


def test_monthly_cycle_works_only_on_what_changed(spark, base):
    paths, *_ = base
    offered = spark.createDataFrame(
        [("Interrupções 2025", "PARQUET", 0, "u0", "d1", 1, None), ("Interrupções 2026", "PARQUET", 1, "u1", "d1", 1, None)],
        "name string, format string, pos int, url string, last_modified string, size long, hash string",
    )
    asked = []
    there = lambda ano, url: asked.append((ano, url)) or True
    known = catalog.load_manifest(spark, paths.ouro)
    assert known.count() == 0
    first = cycle.monthly_cycle(spark, paths, offered, known, there)
    assert first["anos"] == [2025, 2026] and "mart_mensal" in first["tabelas"] and asked == [(2025, "u0"), (2026, "u1")]
    known = catalog.save_manifest(spark, paths.ouro, first["manifesto"])
    assert {r.arquivo for r in known.collect()} == {"interrupcoes-2025.parquet", "interrupcoes-2026.parquet"}
    again = cycle.monthly_cycle(spark, paths, offered, known, there)
    assert again["anos"] == [] and again["tabelas"] == [] and len(asked) == 2
    newer = offered.withColumn("size", F.when(F.col("pos") == 1, 2).otherwise(F.col("size")).cast("long"))
    # A change that could not be fetched leaves the manifest as it was and is found again.
    lost = cycle.monthly_cycle(spark, paths, newer, known, lambda ano, url: False)
    assert lost["anos"] == [] and sorted(lost["manifesto"].collect()) == sorted(known.collect())
    second = cycle.monthly_cycle(spark, paths, newer, catalog.load_manifest(spark, paths.ouro), there)
    assert second["anos"] == [2026]
    saved = catalog.save_manifest(spark, paths.ouro, second["manifesto"])
    assert {r.chave: r.size for r in saved.collect()}["interrupcoes:2026"] == 2
    report, problems = cycle.audit_all(spark, paths)
    assert {r.tabela for r in report.select("tabela").distinct().collect()} == {"interrupcoes", "clima_conjunto_hora", "referencias"}
    assert len(problems) == report.filter("situacao = 'FALHA'").count()


def test_two_files_of_a_year_stop_the_load(spark, tmp_path):
    paths = layers.Paths(*[str(tmp_path / x) for x in ("bronze", "prata", "ouro")])
    assert cycle.curate_fact(spark, paths) == []
    spark.range(1).write.parquet(f"{paths.bronze}/interrupcoes-2025.parquet")
    spark.range(1).write.parquet(f"{paths.bronze}/copia/interrupcoes-2025.parquet")
    assert cycle.source_years(spark, paths.bronze).count() == 1
    spark.range(1).write.parquet(f"{paths.bronze}/interrupcoes-2025-novo.parquet")
    with pytest.raises(ValueError, match="two files for 2025"):
        cycle.curate_fact(spark, paths)


def test_fact_files_follow_the_tasks_not_tasks_times_years(spark, tmp_path):
    rows = spark.range(20_000).select(
        (2015 + F.col("id") % 7).cast("int").alias("ano_arquivo"), (F.col("id") % 997).cast("int").alias("conjunto"),
        F.col("id").cast("int").alias("inicio_s"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        files.write_fact(rows, str(tmp_path / "fato"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    per_year = files.file_metrics(spark, str(tmp_path / "fato"), ["ano_arquivo"]).collect()
    assert len(per_year) == 7 and all(r.arquivos <= 200 / 7 + 2 for r in per_year)


def test_months_of_climate_do_not_touch_each_other(spark, base, tmp_path):
    """January, February, January again: 744 and 696 hours each time."""
    old, *_, steps = base
    paths = layers.Paths(old.bronze, str(tmp_path / "prata"), str(tmp_path / "ouro"))
    for name in ("interrupcoes", "peso_conjunto_celula"):
        table = spark.read.parquet(old.silver(name))
        writer = table.write.partitionBy("ano_arquivo") if name == "interrupcoes" else table.write
        writer.parquet(paths.silver(name))
    one = steps.limit(1)

    def month(first, hours):
        at = F.timestamp_seconds(F.lit(first) + F.col("h") * 3600).cast("timestamp_ntz")
        return one.crossJoin(spark.range(hours).withColumnRenamed("id", "h")).withColumn("valid_time", at).drop("h")

    january, february = month(1704067200, 744), month(1706745600, 696)
    loads = [(january, ["202401"], {202401: 744}), (february, ["202402"], {202401: 744, 202402: 696}), (january, ["202401"], {202401: 744, 202402: 696})]
    for load, stale, hours in loads:
        assert cycle.curate_climate(spark, paths, load) == stale
        stored = spark.read.parquet(paths.silver("clima_conjunto_hora"))
        zones = stored.select("conjunto").distinct().count()
        assert {r.competencia: r["count"] / zones for r in stored.groupBy("competencia").count().collect()} == hours
        assert spark.read.parquet(paths.silver("clima_grade")).select("instante_utc").distinct().count() == sum(hours.values())
    assert cycle.curate_climate(spark, paths, february, everything=True) == ["202401", "202402"]


def test_a_zone_of_a_later_file_gets_its_hours_of_all_stored_months(spark, base, tmp_path):
    old, *_, steps = base
    paths = layers.Paths(str(tmp_path / "bronze"), str(tmp_path / "prata"), str(tmp_path / "ouro"))
    for name in ("peso_conjunto_celula", "dim_conjunto"):
        spark.read.parquet(old.silver(name)).write.parquet(paths.silver(name))
    known = [r[0] for r in spark.read.parquet(old.silver("clima_conjunto_hora")).select("conjunto").distinct().orderBy("conjunto").collect()]
    whole = spark.read.parquet(old.silver("interrupcoes"))
    assert len(known) > 1
    whole.filter(F.col("conjunto") == known[0]).write.partitionBy("ano_arquivo").parquet(paths.silver("interrupcoes"))
    cycle.curate_climate(spark, paths, steps)
    hours = lambda: {r.conjunto: r["count"] for r in spark.read.parquet(paths.silver("clima_conjunto_hora")).groupBy("conjunto").count().collect()}
    assert set(hours()) == {known[0]}
    offered = spark.createDataFrame(
        [("Interrupções 2025", "PARQUET", 0, "u0", "d1", 1, None)],
        "name string, format string, pos int, url string, last_modified string, size long, hash string",
    )

    def fetch(ano, url):
        spark.read.parquet(f"{old.bronze}/interrupcoes-2025.parquet").write.parquet(f"{paths.bronze}/interrupcoes-2025.parquet")
        return True

    done = cycle.monthly_cycle(spark, paths, offered, catalog.load_manifest(spark, paths.ouro), fetch)
    now, had = hours(), whole.filter("ano_arquivo = 2025").select("conjunto").distinct().collect()
    assert done["anos"] == [2025] and done["clima"] and {r[0] for r in had} & set(known) <= set(now)
    assert len(now) > 1 and len(set(now.values())) == 1
    assert cycle.renew_zone_hours(spark, paths) == []
    # Weights with a cell that the stored grid was cut by.
    weights = spark.read.parquet(old.silver("peso_conjunto_celula"))
    weights.union(weights.limit(1).withColumn("celula", F.col("celula") + 100_000)).write.mode("overwrite").parquet(paths.silver("peso_conjunto_celula"))
    assert cycle.months_without_cells(spark, paths) == done["clima"]


def test_zones_of_all_states_need_a_box(spark, base):
    paths, _, _, mesh, _ = base
    with pytest.raises(ValueError, match="box"):
        cycle.curate_weights(spark, paths, mesh, uf=None)


def test_old_versions_are_pruned(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        versions.save_all(spark, root, {t: lambda path, n=n: spark.range(n + 1).write.parquet(path) for t in ("a", "b")})
    gone = versions.prune(spark, root, keep=2)
    assert len(gone) == 4 and not any(os.path.exists(p) for p in gone)
    assert {t: spark.read.parquet(p).count() for t, p in versions.current(spark, root).items()} == {"a": 4, "b": 4}


def test_scratch_prefers_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert files.scratch(spark, "x").startswith(shared)


def test_source_years_come_from_names(spark, base):
    paths, *_ = base
    assert sorted(r.ano for r in cycle.source_years(spark, paths.bronze).collect()) == [2025, 2026]
    assert len(files.columns(spark, f"{paths.bronze}/interrupcoes-2026.parquet")) == 26
