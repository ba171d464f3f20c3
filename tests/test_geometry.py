import random

import pytest
from pyspark.sql import functions as F

from stormledger.functions import geometry as g
from stormledger.operators import geo

SQUARE = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
CONCAVE = [(0.0, 0.0), (1.3, 0.1), (1.1, 1.0), (0.6, 0.35), (0.05, 0.9)]
HOLE = [(0.4, 0.1), (0.8, 0.12), (0.6, 0.25)]
FAR = [(2.0, 0.2), (2.6, 0.3), (2.1, 0.7)]


def frame(spark, shapes, uf="MG"):
    rows = [(k, uf, [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in parts]) for k, parts in shapes.items()]
    return spark.createDataFrame(rows, f"municipio_ibge int, uf string, partes {g.PARTS}")


def shifted(ring, dx, dy):
    return [(x + dx, y + dy) for x, y in ring]


def inside(parts, x, y):
    """Even-odd rule, independent of ring direction."""
    hit = False
    for ring in (r for part in parts for r in part):
        for (xa, ya), (xb, yb) in zip(ring, ring[1:] + ring[:1]):
            if (ya > y) != (yb > y) and x < (xb - xa) * (y - ya) / (yb - ya) + xa:
                hit = not hit
    return hit


def test_area_and_centroid_whatever_the_direction(spark):
    shapes = {
        1: [[SQUARE]], 2: [[SQUARE[::-1]]], 3: [[CONCAVE, HOLE]], 4: [[CONCAVE[::-1], HOLE]],
        5: [[CONCAVE, HOLE[::-1]]], 6: [[SQUARE], [shifted(SQUARE, 5, 0)]],
    }
    rows = {r.municipio_ibge: r for r in geo.shapes(frame(spark, shapes), "municipio_ibge").collect()}
    assert rows[1].area_graus == rows[2].area_graus == pytest.approx(1.0)
    assert rows[1].lon == rows[2].lon == pytest.approx(0.5)
    assert rows[3].area_graus == pytest.approx(rows[4].area_graus) == pytest.approx(rows[5].area_graus)
    assert rows[6].area_graus == pytest.approx(2.0) and rows[6].lon == pytest.approx(3.0)
    assert (rows[6].oeste, rows[6].leste, rows[6].norte) == (0.0, 6.0, 1.0)


def test_closed_and_open_rings_are_the_same(spark):
    shapes = {1: [[CONCAVE]], 2: [[CONCAVE + CONCAVE[:1]]]}
    a, b = (r.area_graus for r in geo.shapes(frame(spark, shapes), "municipio_ibge").orderBy("municipio_ibge").collect())
    assert a == pytest.approx(b)


def test_overlap_against_point_sampling(spark):
    rng = random.Random(7)
    shapes = {}
    for k in range(6):
        dx, dy = -45 + rng.random() * 2, -19 + rng.random() * 2
        parts = [[shifted(CONCAVE, dx, dy), shifted(HOLE, dx, dy)], [shifted(FAR, dx, dy)]]
        shapes[k] = [[ring[::-1] if k % 2 else ring for ring in part] for part in parts]
    meshes = frame(spark, shapes)
    cells = geo.cell_overlap(meshes).collect()
    n, step = 60, 0.25
    seen = {(r.municipio_ibge, r.celula): r.area for r in cells}
    for r in cells:
        parts, hits = shapes[r.municipio_ibge], 0
        for i in range(n):
            for j in range(n):
                hits += inside(parts, r.lon + ((i + 0.5) / n - 0.5) * step, r.lat + ((j + 0.5) / n - 0.5) * step)
        assert r.area == pytest.approx(hits / n / n * step * step, abs=0.0006)
        assert r.celula == round((r.lat + 90) / 0.25) * 10_000 + round((r.lon + 180) / 0.25)
    sizes = {r.municipio_ibge: r.area_graus for r in geo.shapes(meshes, "municipio_ibge").collect()}
    for k, size in sizes.items():
        assert sum(a for (m, _), a in seen.items() if m == k) == pytest.approx(size)


def test_rows_follow_crossed_and_covered_cells(spark):
    """A shape far above the box's bottom makes no row below itself, one that covers the box fills it."""
    small = frame(spark, {1: [[shifted([(0.0, 0.0), (0.01, 0.0), (0.01, 0.01)], -44.99, -15.99)]]})
    assert geo.cell_overlap(small).count() == 1
    box = (-19.0, -45.0, -20.0, -44.0)  # 5 x 5 cells
    big = frame(spark, {1: [[[(-60.0, -30.0), (-30.0, -30.0), (-30.0, -10.0), (-60.0, -10.0)]]], 2: [[[(-60.0, -30.0), (-30.0, -30.0), (-30.0, -19.5), (-60.0, -19.5)]]]})
    rows = geo.cell_overlap(big, box=box).collect()
    full = [r for r in rows if r.municipio_ibge == 1]
    assert len(full) == 25 and all(r.area == pytest.approx(0.0625) for r in full)
    half = {(r.lat, r.lon): r.area for r in rows if r.municipio_ibge == 2}
    assert len(half) == 15 and half[(-19.5, -44.5)] == pytest.approx(0.0625 / 2) and half[(-20.0, -44.0)] == pytest.approx(0.0625)
    # A frame: its inner cells have no area, though the sweep passes them.
    ring = [[[(-46.0, -21.0), (-43.0, -21.0), (-43.0, -18.0), (-46.0, -18.0)], [(-45.6, -20.6), (-43.4, -20.6), (-43.4, -18.4), (-45.6, -18.4)]]]
    assert geo.cell_overlap(frame(spark, {3: ring}), box=box).count() == 0


def test_weights_sum_to_one_and_leave_border_cells_out(spark):
    meshes = frame(spark, {
        1: [[shifted(SQUARE, -45.125, -19.125)]],  # exactly 16 cells
        2: [[shifted(SQUARE, -45.1251 + 1, -19.125)]],  # 1e-4 into the neighbours
        3: [[[(-44.0, -18.0), (-44.0, -18.0), (-44.0, -18.0)]]],  # no area
    })
    bridge = spark.createDataFrame(
        [(10, 1, "a", "MG"), (10, 1, "a", "MG"), (11, 2, "b", "MG"), (12, 1, "a", "MG"), (12, 2, "b", "MG"), (13, 3, "c", "MG")],
        "conjunto int, municipio_ibge int, municipio string, uf string",
    )
    weights = geo.zone_weights(bridge, meshes)
    per_zone = {r.conjunto: (r.n, r.s) for r in weights.groupBy("conjunto").agg(F.count("*").alias("n"), F.sum("peso").alias("s")).collect()}
    assert set(per_zone) == {10, 11, 12}
    assert all(s == pytest.approx(1.0) for _, s in per_zone.values())
    assert per_zone[10][0] == 16 and per_zone[11][0] == 16 and per_zone[12][0] == 32
    summary = geo.weights_summary(weights).first()
    assert (summary.conjuntos, summary.pares) == (3, 64)


def test_cells_outside_the_box_do_not_count(spark):
    meshes = frame(spark, {1: [[shifted(SQUARE, -52.0, -19.125)]]})
    cells = geo.cell_overlap(meshes).collect()
    assert cells and min(c.lon for c in cells) == -51.25
    assert geo.grid_cells(spark).count() == 37 * 47


def test_geojson_and_wkt(spark, tmp_path):
    file = tmp_path / "MG.geojson"
    file.write_text(
        '{"type":"FeatureCollection","features":['
        '{"type":"Feature","properties":{"codarea":"31"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1.5,0],[1.5,1],[0,0]]]}},'
        '{"type":"Feature","properties":{"codarea":"32"},"geometry":{"type":"MultiPolygon",'
        '"coordinates":[[[[0,0],[1,0],[1,1],[0,0]],[[0.5,0.1],[0.6,0.1],[0.6,0.2],[0.5,0.1]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}]}',
        encoding="utf-8",
    )
    from stormledger.sources import files

    mesh = geo.mesh(files.geojson(spark, str(file)), F.lit("MG"))
    rows = {r.municipio_ibge: r for r in geo.municipality_geometry(mesh).collect()}
    assert rows[31].wkt == "POLYGON ((0 0, 1.5 0, 1.5 1, 0 0))"
    assert rows[31].area_graus == pytest.approx(0.75) and rows[31].uf == "MG"
    assert rows[32].wkt.startswith("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0), (0.5 0.1,")
    assert rows[32].area_graus == pytest.approx(0.5 - 0.005 + 0.5)
    bridge = spark.createDataFrame([(1, 31), (1, 32), (2, 31)], "conjunto int, municipio_ibge int")
    zones = {r.conjunto: r for r in geo.zone_geometry(bridge, mesh).collect()}
    assert zones[2].wkt == rows[31].wkt and zones[1].area_graus == pytest.approx(1.745)
    assert zones[1].wkt.count("((") == 3


def test_shapes_are_never_broadcast(spark):
    """Size estimates count a shape as one value, so small keys may carry gigabytes."""
    meshes = frame(spark, {1: [[SQUARE]], 2: [[CONCAVE, HOLE], [FAR]]})
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "conjunto int, municipio_ibge int")
    box, results = (3.0, -1.0, -1.0, 4.0), {}
    results["cities"] = geo.municipality_geometry(meshes)
    results["zones"] = geo.zone_geometry(bridge, meshes)
    results["weights"] = geo.zone_weights(bridge, meshes, box=box)
    for name, df in results.items():
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert len(rows) > 1 and "Broadcast" not in plan, name
    assert sum(r.peso for r in results["weights"].collect() if r.conjunto == 1) == pytest.approx(1.0)


def test_weights_are_made_once_and_dealt_by_zone_once(spark):
    """Totals come from the rows that they scale: no join, and a null zone has no weights."""
    columns = "conjunto int, celula int, lat double, lon double, peso double"
    shares = spark.createDataFrame([(1, 10, 0.0, 0.0, 0.5), (1, 11, 0.0, 0.0, 1.5), (1, 11, 0.0, 0.0, 2.0), (2, 10, 0.0, 0.0, 3.0), (None, 10, 0.0, 0.0, 1.0)], columns)
    scaled = geo.renormalised(shares)
    assert sorted((r.conjunto, r.celula, r.peso) for r in scaled.collect()) == [(1, 10, 0.125), (1, 11, 0.375), (1, 11, 0.5), (2, 10, 1.0)]
    assert "Join" not in scaled._jdf.queryExecution().executedPlan().toString()
    meshes = frame(spark, {1: [[shifted(SQUARE, -45.125, -19.125)]]})
    bridge = spark.createDataFrame([(10, 1), (11, 1)], "conjunto int, municipio_ibge int")
    weights = geo.zone_weights(bridge, meshes)
    places = {r.celula: (r.lat, r.lon) for r in geo.cell_overlap(meshes).collect()}
    assert {r.celula: (r.lat, r.lon) for r in weights.collect()} == places and len(places) == 16
