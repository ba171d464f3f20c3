"""Tables that are kept up to date read only what changed and equal a full rebuild."""

import glob
import os
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stormledger.operators import audit, cubes, fact, zones
from stormledger.operators.filters import Filtro, Lookups
from stormledger.plans import cycle, partials
from stormledger.sources import files, layers
from tests.test_sources import base  # noqa: F401

T0 = datetime(2024, 1, 1)


def rows(spark, years, zones_=7, step=1):
    """A stored fact; events of a year's file may start in the year after."""
    n = F.col("id")
    return spark.range(0, 400 * len(years), step).select(
        F.element_at(F.array(*[F.lit(y) for y in years]), (n % len(years) + 1).cast("int")).alias("ano_arquivo"),
        (n * 13 % zones_ * 40_000).cast("int").alias("conjunto"),
        F.lit("CEMIG").alias("distribuidora"),
        F.when(n % 3 > 0, F.concat(F.lit("c"), n % 4)).alias("causa"),
        F.when(n % 5 == 0, "VENTO").alias("detalhe"),
        F.when(n % 7 > 0, n % 2 == 0).alias("programada"),
        (n * 100_000 % 60_000_000).cast("int").alias("inicio_s"),
        F.when(n % 11 == 0, -60).otherwise(n % 50_000).cast("int").alias("duracao_s"),
        (n % 90).cast("int").alias("consumidores_afetados"),
        F.lit(100).alias("consumidores_conjunto"),
        F.lit(13800).alias("nivel_tensao"),
    ).withColumn("ano", F.col("ano_arquivo"))


@pytest.fixture
def paths(tmp_path):
    return layers.Paths(*[str(tmp_path / x) for x in ("bronze", "prata", "ouro")])


def same(spark, paths):
    """Every cube and every bitmap against one over the whole fact."""
    view = fact.fact_view(files.stored_fact(spark, paths.silver(layers.FACT)))
    for name, (stored, _, _) in cubes.CUBES.items():
        full, kept = stored(view), partials.cube(spark, paths, name)
        order = lambda df: sorted(map(str, df.select([F.round(c, 6).alias(c) if t == "double" else c for c, t in full.dtypes]).collect()))
        assert order(full) == order(kept), name
    maps = partials.zone_bitmaps(spark, paths)
    events = cubes.monthly_rows(view)
    for grain in ("month", "quarter", "year"):
        want = events.groupBy(F.date_trunc(grain, "mes").cast("timestamp_ntz").alias("p")).agg(F.countDistinct("conjunto")).collect()
        assert sorted(map(tuple, zones.zones_by_period(maps, grain).collect())) == sorted(map(tuple, want))


def spoil(folder):
    """The rows of a folder's files cannot be read any more; footers and times stay."""
    found = glob.glob(f"{folder}/*.parquet")
    assert found
    for file in found:
        stamp = os.stat(file)
        with open(file, "r+b") as out:
            content = out.read()
            rows_end = len(content) - 8 - int.from_bytes(content[-8:-4], "little")
            out.seek(4)
            out.write(b"x" * (rows_end - 4))
        os.utime(file, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
        sums = os.path.join(folder, f".{os.path.basename(file)}.crc")
        if os.path.exists(sums):
            os.remove(sums)


def test_a_republished_year_replaces_its_share_only(spark, paths):
    stored = paths.silver(layers.FACT)
    files.write_fact(rows(spark, [2018, 2019, 2020]), stored)
    assert partials.renew(spark, paths) == [2018, 2019, 2020]
    same(spark, paths)
    assert partials.renew(spark, paths) == []
    files.write_fact(rows(spark, [2019], zones_=3, step=2), stored)
    keep = {y: sorted(glob.glob(f"{stored}/ano_arquivo={y}/*.parquet")) for y in (2018, 2020)}
    copies = {f: open(f, "rb").read() for fs in keep.values() for f in fs}
    for y in keep:
        spoil(f"{stored}/ano_arquivo={y}")
    assert partials.renew(spark, paths) == [2019]  # the other years' rows cannot even be read
    for f, content in copies.items():
        with open(f, "wb") as out:
            out.write(content)
    # Their files are newer now, their rows the same.
    same(spark, paths)
    files.write_fact(rows(spark, [2021]), stored)
    assert 2021 in partials.renew(spark, paths)
    same(spark, paths)
    assert partials.renew(spark, paths, everything=True) == [2018, 2019, 2020, 2021]
    same(spark, paths)


def test_a_year_that_is_gone_is_in_no_cube(spark, paths):
    stored = paths.silver(layers.FACT)
    files.write_fact(rows(spark, [2018, 2019]), stored)
    partials.renew(spark, paths)
    for f in glob.glob(f"{stored}/ano_arquivo=2018/*"):
        os.remove(f)
    assert partials.renew(spark, paths) == []
    same(spark, paths)


def test_bitmaps_unite_and_meet(spark):
    data = [(y, z) for y in range(4) for z in (1, 2, 32_768, 32_769, -5, 0, 70_000 + y, 5 * y)] + [(9, None)]
    df = spark.createDataFrame(data, "y int, conjunto int")
    maps = zones.bitmaps(df, "y")
    got = {r.y: r.conjuntos for r in zones.counted(maps, "y").collect()}
    assert got == {y: len({z for a, z in data if a == y}) for y in range(4)}
    assert zones.counted(zones.united(maps)).first().conjuntos == len({z for _, z in data if z is not None})
    other = spark.createDataFrame([(2,), (70_001,), (99,), (32_769,)], "conjunto int")
    met = {r.y: r.conjuntos for r in zones.counted(zones.common(maps, zones.bitmaps(other), "y"), "y").collect()}
    assert met == {0: 2, 1: 3, 2: 2, 3: 2}


def test_zones_under_a_filter(spark):
    events = spark.createDataFrame(
        [(datetime(2018 + i % 3, 1 + i % 12, 1), i % 2 == 0, i % 5 == 0, i % 31) for i in range(300)],
        "mes timestamp_ntz, programada boolean, causa_climatica boolean, conjunto int",
    )
    dim = spark.createDataFrame([(z, "MG" if z % 3 else "SP") for z in range(31)], "conjunto int, uf string")
    look, maps = Lookups(dim), zones.bitmaps(events, *zones.KEYS)
    for f in (Filtro(), Filtro(2019, 2019), Filtro(ufs=("SP",)), Filtro(2018, 2019, ufs=("MG",), programada="nao", so_climaticas=True), Filtro(1999, 2000)):
        want = f.apply(events, look).agg(F.countDistinct("conjunto")).first()[0]
        assert zones.zones_in(maps, f, look).first().conjuntos == want
    with pytest.raises(ValueError, match="causa"):
        zones.zones_in(maps, Filtro(causas=("x",)), look)


def test_writes_count_their_rows(spark, tmp_path):
    df = spark.range(0, 5000, 1, 7).withColumn("k", F.col("id") % 10)
    bad = {"bad": F.count_if(F.col("id") % 4 == 1), "top": F.max("id")}
    for write in (
        lambda p: files.write_table(df, p, measures=bad),
        lambda p: files.write_sorted(df, p, ["k", "id"], measures=bad),
        lambda p: files.write_periods(df, p, "k", ["id"], measures=bad),
    ):
        path = files.scratch(spark, "counted")
        assert write(path) == {"linhas": 5000, "bad": 1250, "top": 4999}
        assert spark.read.parquet(path).count() == 5000
        size = files.stored_bytes(spark, path)
        assert size["bytes"] == files.file_metrics(spark, path).first().bytes > 0 and size["arquivos"] >= 1


def test_rule_counts_of_a_write_give_the_same_report(spark, tmp_path):
    hours = spark.createDataFrame([(None, 5), (3, -1), (20_000, 16_000), (1, 1)], "chuva_c int, rajada_c int")
    rules = audit.climate_rules()
    counts = files.write_table(hours, str(tmp_path / "h"), measures=audit.rule_counts(rules))
    assert audit.check_written(spark, counts, rules).collect() == audit.check(hours, rules).collect()


def test_a_cycle_without_new_zones_reads_no_hour_and_no_grid_row(spark, base, tmp_path):  # noqa: F811
    old, *_, steps = base
    paths = layers.Paths(old.bronze, str(tmp_path / "prata"), str(tmp_path / "ouro"))
    zone = spark.createDataFrame([(z,) for z in (1, 2)], "conjunto int")
    weights = zone.select("conjunto", F.explode(F.array(*[F.lit(c) for c in (2830540, 2830541, 2840540)])).alias("celula"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.lit(1 / 3).alias("peso"))
    files.write_table(weights, paths.silver("peso_conjunto_celula"))
    files.write_fact(rows(spark, [2018]).withColumn("conjunto", F.col("conjunto") % 2 + 1), paths.silver(layers.FACT))
    grid = spark.range(72).select((T0.hour + F.col("id")).alias("h")).select(
        F.explode(F.array(*[F.lit(c) for c in (2830540, 2830541, 2840540)])).alias("celula"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("h").cast("int"))).alias("instante_utc"),
        F.lit(100).cast("short").alias("chuva_c"), F.lit(900).cast("short").alias("rajada_c"),
        F.date_format(F.lit(T0), "yyyyMM").alias(layers.PERIOD),
    )
    files.write_periods(grid, paths.silver("clima_grade"), layers.PERIOD, ["celula"])
    assert cycle.renew_zone_hours(spark, paths) == ["202401"]
    assert cycle.renew_zone_hours(spark, paths) == [] and cycle.months_without_cells(spark, paths) == []
    for table in ("clima_grade", "clima_conjunto_hora"):
        for folder in glob.glob(f"{paths.silver(table)}/{layers.PERIOD}=*"):
            spoil(folder)
    files.write_fact(rows(spark, [2019]).withColumn("conjunto", F.lit(1)), paths.silver(layers.FACT))
    assert cycle.renew_zone_hours(spark, paths) == [] and cycle.months_without_cells(spark, paths) == []
    with pytest.raises(Exception):
        spark.read.parquet(paths.silver("clima_grade")).select(F.sum("celula")).collect()
    # A new cell asks for the month again without reading it.
    more = weights.limit(1).withColumn("celula", F.lit(2999999))
    files.write_table(weights.union(more), paths.silver("peso_conjunto_celula") + "2")
    files.write_table(spark.read.parquet(paths.silver("peso_conjunto_celula") + "2"), paths.silver("peso_conjunto_celula"))
    assert cycle.months_without_cells(spark, paths) == ["202401"]


def test_bucketed_sides_do_not_move(spark, tmp_path):
    hours = spark.range(4000).select((F.col("id") % 40).cast("int").alias("conjunto"), F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("instante_utc"), F.lit(5).alias("chuva_c"), F.lit(6).alias("rajada_c"))
    events = hours.filter("instante_utc < '1970-02-01'").select("conjunto", "instante_utc", F.lit(2).cast("long").alias("interrupcoes"))
    keys = ["conjunto", "instante_utc"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert files.write_bucketed(hours, "horas_em_baldes", str(tmp_path / "h"), keys, 8)["linhas"] == 4000
        files.write_bucketed(events, "contagens_em_baldes", str(tmp_path / "e"), keys, 8)
        stored = spark.table("horas_em_baldes")
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        from stormledger.operators import exposure

        both = exposure.exposure_base(stored, spark.table("contagens_em_baldes"))
        assert "SortMergeJoin" in plan(both) and "Exchange" not in plan(both)
        one = exposure.exposure_base(stored, events)
        assert plan(one).count("Exchange hashpartitioning") == 1
        plain = exposure.exposure_base(hours, events)
        assert sorted(both.collect()) == sorted(one.collect()) == sorted(plain.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for table in ("horas_em_baldes", "contagens_em_baldes"):
            spark.sql(f"drop table if exists {table}")


def test_writes_leave_no_shuffle_files(spark, paths):
    """A cycle writes one table after the other; what each has shuffled goes when it is done."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in re.split(r"[,/]", disk.getAllFiles().mkString(",")) if f.startswith("shuffle_")}
    before, setting = shuffled(), spark.conf.get(files._TIDY)
    files.write_fact(rows(spark, [2018, 2019]), paths.silver(layers.FACT))
    cube = cubes.monthly_cube(fact.fact_view(files.stored_fact(spark, paths.silver(layers.FACT))))
    for k in range(3):
        files.write_sorted(cube, paths.silver(f"cubo{k}"), ["conjunto"])
    until = time.time() + 20
    while shuffled() - before and time.time() < until:  # files go in the background
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(files._TIDY) == setting
    assert cube.count() == cube.count() == spark.read.parquet(paths.silver("cubo0")).count()


def test_a_large_fact_is_made_into_cubes_year_by_year(spark, paths, monkeypatch):
    years = [2018, 2019, 2020]
    files.write_fact(rows(spark, years), paths.silver(layers.FACT))
    assert partials._batches(spark, paths, years) == [years] and partials._batches(spark, paths, []) == []
    sizes = files.period_bytes(spark, paths.silver(layers.FACT), partials._STAMP)
    monkeypatch.setattr(partials, "BATCH_BYTES", sizes["2018"] + sizes["2019"])
    assert partials._batches(spark, paths, years) == [[2018, 2019], [2020]]
    monkeypatch.setattr(partials, "BATCH_BYTES", 1)
    assert partials._batches(spark, paths, years) == [[y] for y in years]
    assert partials.renew(spark, paths) == years and partials.renew(spark, paths) == []
    same(spark, paths)
