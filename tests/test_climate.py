from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stormledger.config import GUST_BANDS, RAIN_BANDS
from stormledger.functions import bands, numbers, times
from stormledger.operators import exposure, grid
from stormledger.operators.filters import Filtro, Lookups


T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize(
    "local, utc",
    [
        ("2017-01-15 12:00", "2017-01-15 14:00"),
        ("2018-12-15 12:00", "2018-12-15 14:00"),
        ("2017-07-15 12:00", "2017-07-15 15:00"),
        ("2019-03-15 12:00", "2019-03-15 15:00"),
        ("2020-01-15 12:00", "2020-01-15 15:00"),
        ("2026-01-15 12:00", "2026-01-15 15:00"),
        ("2018-11-04 00:30", "2018-11-04 03:30"),  # the hour that does not exist
        ("2018-02-17 23:30", "2018-02-18 02:30"),  # the hour that happens twice
    ],
)
def test_local_time_follows_the_zone_database(spark, local, utc):
    df = spark.createDataFrame([(local,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert df.select(times.local_to_utc(F.col("t"))).first()[0] == datetime.fromisoformat(utc)


def test_every_value_has_exactly_one_band(spark):
    rain = [0.0, 0.0001, 0.4999, 0.5, 0.9999, 1.0, 1.9999, 2.0, 4.9999, 5.0, 99.0, -1.0]
    gust = [0.0, 19.99, 20.0, 29.99, 30.0, 49.99, 50.0, 59.99, 60.0, 200.0, 40.0, None]
    df = spark.createDataFrame(list(zip(rain, gust)), "r double, g double")
    rows = df.select(bands.rain_band(F.col("r")), bands.gust_band(F.col("g"))).collect()
    assert [r[0] for r in rows] == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, None]
    assert [r[1] for r in rows] == [0, 0, 1, 1, 2, 3, 4, 4, 5, 5, 3, None]
    labels = df.select(bands.band_label(bands.rain_band(F.col("r")), RAIN_BANDS)).first()
    assert labels[0] == "sem chuva" and len(GUST_BANDS) == 6


def test_duration_bands(spark):
    values = [0.0, 14.99, 15.0, 719.9, 720.0, 1439.0, 1440.0, 4319.0, 4320.0, 1e6]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    got = [r[0] for r in df.select(bands.duration_band(F.col("d"))).collect()]
    assert got == [0, 0, 15, 705, 720, 720, 1440, 1440, 4320, 4320]


def test_grid_hour_moves_back_and_values_round_to_even(spark):
    step = spark.createDataFrame(
        [(datetime(2017, 1, 1, 15), [-20.0], [-45.0, -44.75], [0.000005, 0.5], [10.0, -1.0])],
        "valid_time timestamp_ntz, latitude array<double>, longitude array<double>, tp array<double>, fg10 array<double>",
    )
    rows = grid.grid_rows(step).orderBy("celula").collect()
    assert {r.instante_utc for r in rows} == {datetime(2017, 1, 1, 14)}
    assert [r.celula for r in rows] == [280 * 10_000 + 540, 280 * 10_000 + 541]
    assert [(r.chuva_c, r.rajada_c) for r in rows] == [(0, 3600), (32000, 0)]
    halves = spark.createDataFrame([(0.005,), (0.015,), (0.025,)], "v double")
    got = [r[0] for r in halves.select(numbers.scaled_short(F.col("v") , 100, 320)).collect()]
    assert got == [0, 2, 2]


def world(spark, hours=24 * 20, zones=4):
    """Dense zone-hours with storms, and events that follow some of them."""
    def rain(z, h):
        return 700 if (h * (z + 3)) % 41 in (0, 1, 7) else (h % 3) * 10

    def events(z, h):
        return 0 if z == 3 else int(rain(z, h - 1) >= 500) + int((h + z) % 17 == 0)

    clima = [(z, T0 + timedelta(hours=h), rain(z, h), 1000 + h % 60 * 100) for z in range(zones) for h in range(hours)]
    counts = [(z, T0 + timedelta(hours=h), events(z, h)) for z in range(zones) for h in range(hours) if events(z, h)]
    return (
        spark.createDataFrame(clima, "conjunto int, instante_utc timestamp_ntz, chuva_c short, rajada_c short"),
        spark.createDataFrame(counts, "conjunto int, instante_utc timestamp_ntz, interrupcoes long"),
        clima,
        {(z, t): n for z, t, n in counts},
    )


def brute_profile(clima, counts, window, quiet, cut):
    rain = {(z, t): r for z, t, r, _ in clima}
    local = lambda t: (t - timedelta(hours=3)).hour
    cells = {}
    for z, t in rain:
        n, k = cells.get((t.month, local(t)), (0, 0))
        cells[t.month, local(t)] = (n + counts.get((z, t), 0), k + 1)
    out = {}
    for (z, t), r in rain.items():
        if r < cut or any(rain.get((z, t - timedelta(hours=k)), 0) >= cut for k in range(1, quiet + 1)):
            continue
        for k in range(-window, window + 1):
            at = t + timedelta(hours=k)
            if (z, at) in rain:
                h, n, e = out.get(k, (0, 0, 0.0))
                total, size = cells[at.month, local(at)]
                out[k] = (h + 1, n + counts.get((z, at), 0), e + total / size)
    return out


def test_lag_profile_against_brute_force(spark):
    clima, counts, rows, by_hour = world(spark)
    expected = brute_profile(rows, by_hour, 12, 6, 500)
    got = exposure.lag_profile(clima, counts, threshold=5, window=12).collect()
    assert [r.hora_rel for r in got] == sorted(expected) and len(got) == 25
    for r in got:
        hours, n, usual = expected[r.hora_rel]
        assert (r.conjunto_horas, r.interrupcoes) == (hours, n)
        assert r.taxa == pytest.approx(n / hours)
        assert r.taxa_esperada == pytest.approx(usual / hours)
        assert r.lift == pytest.approx(n / usual)


def test_both_onset_forms_agree_across_block_borders(spark):
    clima, _, rows, _ = world(spark)
    one = {tuple(r) for r in exposure.storm_onsets(clima).collect()}
    heavy = {(z, t) for z, t, r, _ in rows if r >= 500}
    brute = {(z, t) for z, t in heavy if not any((z, t - timedelta(hours=k)) in heavy for k in range(1, 7))}
    assert one == brute and one != heavy
    for block in (1, 5, 7, 720):
        assert {tuple(r) for r in exposure.storm_onsets_windowed(clima, block_hours=block).collect()} == brute


def test_quiet_zone_stays_in_the_denominator(spark):
    clima, counts, rows, by_hour = world(spark)
    curve = exposure.rain_risk(exposure.exposure_base(clima, counts)).collect()
    assert sum(r.conjunto_horas for r in curve) == len(rows)
    assert sum(r.interrupcoes for r in curve) == sum(by_hour.values())
    assert all(r.taxa == r.interrupcoes / r.conjunto_horas for r in curve)


def test_period_narrows_events_only_unless_clipped(spark):
    clima, counts, rows, _ = world(spark)
    assert exposure.exposure_base(clima, counts).count() == len(rows)
    clipped = exposure.exposure_base(clima, counts, clip=Filtro(2024, 2024)).count()
    assert clipped == len([1 for _, t, _, _ in rows if (t - timedelta(hours=3)).year == 2024]) < len(rows)


def test_hourly_counts_use_known_zones_and_utc(spark):
    fact = spark.createDataFrame(
        [(2018, 1, datetime(2018, 12, 15, 12, 20)), (2018, 1, datetime(2018, 12, 15, 12, 50)), (2018, 9, datetime(2018, 12, 15, 12, 0))],
        "ano int, conjunto int, inicio timestamp_ntz",
    )
    dim = spark.createDataFrame([(1, "MG")], "conjunto int, uf string")
    rows = exposure.hourly_counts(fact, Filtro(ufs=("MG",)), Lookups(dim)).collect()
    assert [tuple(r) for r in rows] == [(1, datetime(2018, 12, 15, 14), 2)]


def test_multiples_and_peak(spark):
    curve = spark.createDataFrame([(0, 0.2), (1, 0.8), (2, 0.6)], "faixa_id int, taxa double")
    assert exposure.last_over_first(curve).first()[0] == pytest.approx(3.0)
    assert [r.multiplo for r in exposure.risk_multiples(curve).orderBy("faixa_id").collect()] == pytest.approx([1, 4, 3])
    zero = spark.createDataFrame([(0, 0.0), (1, 0.5)], "faixa_id int, taxa double")
    assert exposure.last_over_first(zero).first()[0] is None
    assert [r.multiplo for r in exposure.risk_multiples(zero).orderBy("faixa_id").collect()] == [0.0, 0.5]
    assert exposure.last_over_first(zero.limit(0)).first()[0] is None
    profile = spark.createDataFrame(
        [(-7, 9.0), (-2, 1.0), (-1, 3.0), (0, None), (1, 9.0), (2, 4.0)], "hora_rel int, lift double"
    )
    assert tuple(exposure.lag_peak(profile).first()) == (-7, 9.0, 2.0)


def test_weighted_mean_of_zones_the_fact_has(spark):
    cells = spark.createDataFrame(
        [(c, T0 + timedelta(hours=h), c * 10 + h, 100 * c) for c in (1, 2, 3) for h in range(50)],
        "celula int, instante_utc timestamp_ntz, chuva_c short, rajada_c short",
    )
    weights = spark.createDataFrame([(7, 1, 0.25), (7, 2, 0.75), (8, 3, 1.0), (9, 1, 1.0)], "conjunto int, celula int, peso double")
    fact = spark.createDataFrame([(7,), (8,), (7,)], "conjunto int")
    rows = grid.zone_hours(cells, weights, fact)
    assert rows.count() == 100 and rows.filter("conjunto = 9").count() == 0
    got = rows.filter(F.col("conjunto") == 7).orderBy("instante_utc").first()
    assert (got.chuva_c, got.rajada_c) == (18, 175)  # 17.5 rounds half up


def test_opened_grid_is_never_broadcast(spark):
    """A step of the grid counts as one value, so its rows look few; sums are those of plain rows, repeated ones too."""
    at = datetime(2024, 1, 7, 22)
    hours = [(cell, at + timedelta(hours=h), 100 * cell + h, 7) for cell in (1, 2, 3) for h in range(4)]
    grid_rows = spark.createDataFrame([*hours, hours[0], (1, None, 4, None)], "celula int, instante_utc timestamp_ntz, chuva_c short, rajada_c short")
    weights = spark.createDataFrame([(5, 1, 0.25), (5, 2, 0.75), (6, 2, 1.0), (7, 9, 1.0)], "conjunto int, celula int, peso double")
    rows = grid.zone_hours(grid_rows, weights, weights.filter("conjunto <> 6"))
    found = {(r.conjunto, r.instante_utc): (r.chuva_c, r.rajada_c) for r in rows.collect()}
    plain = {(5, at + timedelta(hours=h)): (175 + h + (25 if h == 0 else 0), 9 if h == 0 else 7) for h in range(4)}
    assert found == plain | {(5, None): (1, None)}
    assert "BroadcastHashJoin [celula" not in rows._jdf.queryExecution().executedPlan().toString()


def moved_rows(df):
    """Rows that each shuffle of a frame wrote, once it has run."""
    def walk(node):
        name, below = node.nodeName(), node.children()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        own = [node.metrics().get("shuffleRecordsWritten").get().value()] if name == "Exchange" else []
        return own + [n for k in range(below.size()) for n in walk(below.apply(k))]

    return walk(df._jdf.queryExecution().executedPlan())


def test_no_shuffle_holds_the_product_of_hours_and_zones(spark):
    """Sixty zones on the same two cells in three weeks: a cell's hours move once a week, not once a zone."""
    weeks = [T0 + timedelta(weeks=k) for k in range(3)]
    cells = spark.createDataFrame([(c, at, 100 * c, 7) for c in (1, 2) for at in weeks], "celula int, instante_utc timestamp_ntz, chuva_c short, rajada_c short")
    zones = range(60)
    weights = spark.createDataFrame([(z, c, 0.5) for z in zones for c in (1, 2)] + [(99, 1, 1.0), (99, 2, None), (None, 1, 1.0)], "conjunto int, celula int, peso double")
    rows = grid.zone_hours(cells, weights, spark.createDataFrame([(z,) for z in [*zones, 99]], "conjunto int"))
    found = sorted((r.conjunto, r.instante_utc, r.chuva_c, r.rajada_c) for r in rows.collect())
    assert found == sorted([(z, at, 150, 7) for z in zones for at in weeks] + [(99, at, 100, 7) for at in weeks])
    assert max(moved_rows(rows)) <= 2 * 60 + 3
    whole = grid.zone_hours(cells, weights)
    assert whole.count() == 3 * 62 and whole.filter("conjunto is null and chuva_c = 100").count() == 3
