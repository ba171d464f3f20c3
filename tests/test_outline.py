"""Dissolved and repaired outlines against point sampling and a restatement on a lattice."""

import math
import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from stormledger.functions import geometry as g
from stormledger.operators import geo, outline
from tests.test_geometry import CONCAVE, FAR, HOLE, SQUARE, frame, inside, shifted


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def outlines(df, key="k"):
    return {r[key]: [[[(p.x, p.y) for p in ring] for ring in part] for part in r.partes] for r in df.collect()}


def keyed(spark, shapes):
    """(key, parts) rows as shapes of a key."""
    rows = [(k, [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in part] for part in parts]) for k, parts in shapes]
    return spark.createDataFrame(rows, f"k string, partes {g.PARTS}")


def area(ring):
    return sum(xa * yb - xb * ya for (xa, ya), (xb, yb) in zip(ring, ring[1:] + ring[:1])) / 2


def total(parts):
    return sum(abs(area(p[0])) - sum(abs(area(h)) for h in p[1:]) for p in parts)


def corners(ring):
    """Points where a ring turns."""
    n = len(ring)
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])
    return {ring[i] for i in range(n) if abs(turn(ring[i - 1], ring[i], ring[(i + 1) % n])) > 1e-12}


def valid(parts):
    for part in parts:
        for i, ring in enumerate(part):
            assert len(set(ring)) == len(ring) >= 3  # no corner twice
            assert (area(ring) < 0) == (i == 0)  # outer rings clockwise, holes the other way
            assert ring[0] == min(ring)


@pytest.fixture(scope="module")
def shaped(spark):
    frame_ = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    shapes = {
        "neighbours": [[[box(0, 0, 1, 1)]], [[box(1, 0, 2, 1)]], [[box(0, 1, 1, 2)]]],
        "ring": [[[box(x, y, x + 1, y + 1)]] for x, y in frame_],
        "island": [[[box(x, y, x + 1, y + 1)]] for x, y in frame_] + [[[box(1.25, 1.25, 1.75, 1.75)]]],
        "apart": [[[box(0, 0, 1, 1)]], [[box(5, 0, 6, 1)]]],
        "corner": [[[box(0, 0, 1, 1)]], [[box(1, 1, 2, 2)]]],
        # The gap touches the outside in one point.
        "touching hole": [[[box(0, 0, 3, 1)]], [[box(0, 1, 1, 2)]], [[[(0, 2), (1, 2), (2, 3), (0, 3)]]], [[[(2, 1), (3, 1), (3, 2), (2, 3)]]]],
        "junction": [[[box(0, 0, 2, 1)]], [[box(-1, 1, 1, 2)]], [[box(1, 1, 3, 2)]]],
        "same twice": [[[box(0, 0, 1, 1)]], [[box(0, 0, 1, 1)]], [[box(1, 0, 2, 1)]]],
        "hole given": [[[box(0, 0, 4, 4), box(1, 1, 2, 2)]], [[box(4, 0, 5, 4)[::-1]]]],
        "filled hole": [[[box(0, 0, 4, 4), box(1, 1, 2, 2)]], [[box(1, 1, 2, 2)]]],
        "flat": [[[[(0, 0), (1, 1), (2, 2)]]], [[box(0, 0, 1, 1)]]],
    }
    rows = keyed(spark, [(k, parts) for k, many in shapes.items() for parts in many])
    return shapes, outlines(outline.dissolved(rows, "k"))


def test_outlines_are_simple_rings_and_keep_the_area(shaped):
    shapes, found = shaped
    assert set(found) == set(shapes)
    for k, parts in found.items():
        valid(parts)
        if k not in ("same twice", "flat"):
            assert total(parts) == pytest.approx(sum(total([part]) for many in shapes[k] for part in many))


def test_known_outlines(shaped):
    _, found = shaped
    assert [corners(p[0]) for p in found["neighbours"]] == [{(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)}]
    assert [(corners(p[0]), [corners(h) for h in p[1:]]) for p in found["ring"]] == [({(0, 0), (3, 0), (3, 3), (0, 3)}, [{(1, 1), (2, 1), (2, 2), (1, 2)}])]
    assert sorted(len(p) for p in found["island"]) == [1, 2]
    assert [corners(p[0]) for p in found["apart"]] == [set(box(0, 0, 1, 1)), set(box(5, 0, 6, 1))]
    assert [corners(p[0]) for p in found["corner"]] == [set(box(0, 0, 1, 1)), set(box(1, 1, 2, 2))]
    assert [len(p) for p in found["touching hole"]] == [2] and (2, 3) in found["touching hole"][0][0] and (2, 3) in found["touching hole"][0][1]
    assert [corners(p[0]) for p in found["junction"]] == [{(0, 0), (2, 0), (2, 1), (3, 1), (3, 2), (-1, 2), (-1, 1), (0, 1)}]
    assert [corners(p[0]) for p in found["same twice"]] == [set(box(0, 0, 2, 1))]
    assert [len(p) for p in found["hole given"]] == [2]
    assert [len(p) for p in found["filled hole"]] == [1]
    assert total(found["flat"]) == 1


def bricks(seed, wide=9, tall=8):
    """Bricks of two half-cells, every other row shifted, so corners meet the middle of sides."""
    r = random.Random(seed)
    return [(2 * i + j % 2, j) for j in range(tall) for i in range(wide) if r.random() < 0.6]


def lattice(cells):
    """(outer rings, holes, boundary length) of a set of unit cells that are joined by sides only."""
    cells = set(cells)
    def components(some, steps):
        left, n = set(some), 0
        while left:
            n += 1
            todo = deque([left.pop()])
            while todo:
                x, y = todo.popleft()
                for dx, dy in steps:
                    if (x + dx, y + dy) in left:
                        left.remove((x + dx, y + dy))
                        todo.append((x + dx, y + dy))
        return n
    sides = [(1, 0), (-1, 0), (0, 1), (0, -1)]
    xs, ys = [x for x, _ in cells], [y for _, y in cells]
    gaps = {(x, y) for x in range(min(xs) - 1, max(xs) + 2) for y in range(min(ys) - 1, max(ys) + 2)} - cells
    outside = sum((x + dx, y + dy) not in cells for x, y in cells for dx, dy in sides)
    return components(cells, sides), components(gaps, sides) - 1, outside


@pytest.mark.parametrize("turn", [0.0, 0.37])
def test_brick_walls_against_a_lattice(spark, turn):
    """Turned by an angle, corners lie on sides only up to rounding."""
    move = lambda x, y: (x * math.cos(turn) - y * math.sin(turn), x * math.sin(turn) + y * math.cos(turn))
    shapes, want = [], {}
    for seed in range(12):
        wall = bricks(seed)
        for i, (x, y) in enumerate(wall):
            ring = [move(*p) for p in box(x, y, x + 2, y + 1)]
            shapes.append((str(seed), [[ring[::-1] if i % 2 else ring]]))
        want[str(seed)] = lattice([(x + d, y) for x, y in wall for d in (0, 1)])
    found = outlines(outline.dissolved(keyed(spark, shapes), "k"))
    for k, parts in found.items():
        length = sum(math.dist(a, b) for part in parts for ring in part for a, b in zip(ring, ring[1:] + ring[:1]))
        holes = sum(len(p) - 1 for p in parts)
        outer, gaps, sides = want[k]
        assert (len(parts), holes, round(length, 6)) == (outer, gaps, sides)
        assert total(parts) == pytest.approx(2 * sum(s[0] == k for s in shapes))
        for part in parts:
            for ring in part:
                assert len(set(ring)) == len(ring)


def test_points_inside_are_the_same_before_and_after(spark):
    r = random.Random(8)
    parts = [[[CONCAVE, HOLE]], [[shifted(SQUARE, 5, 0)]], [[shifted(SQUARE, 6, 0.5)]], [[FAR]]]
    found = outlines(outline.dissolved(keyed(spark, [("z", p) for p in parts]), "k"))["z"]
    for _ in range(3000):
        x, y = r.uniform(-0.5, 7.5), r.uniform(-0.5, 2)
        assert inside(found, x, y) == any(inside(p, x, y) for p in parts)


def test_repair_against_point_sampling(spark):
    bow = [(0, 0), (2, 2), (2, 0), (0, 2)]
    star = [(math.cos(2.4 * math.pi * k / 3 + 0.1), math.sin(2.4 * math.pi * k / 3 + 0.1)) for k in range(5)]
    spike = [(0, 0), (2, 0), (2, 1), (4, 1), (2, 1), (2, 2), (0, 2)]
    eight = [(0, 0), (1, 0), (1, 1), (2, 1), (2, 2), (1, 2), (1, 1), (0, 1)]
    r = random.Random(3)
    scribble = [(r.random(), r.random()) for _ in range(14)]
    shapes = {
        "bow tie": [[bow]], "star": [[star]], "spike": [[spike]], "eight": [[eight]], "scribble": [[scribble]], "whole": [[CONCAVE, HOLE], [FAR]],
        "hole outside": [[box(0, 0, 2, 2), box(1, 1, 3, 3)]],
    }
    found = outlines(outline.repaired(keyed(spark, list(shapes.items())), "k"))
    sums = {x.k: x for x in outline.measured(outline.repaired(keyed(spark, list(shapes.items())), "k"), "k").collect()}
    for k, parts in shapes.items():
        valid(found[k])
        for _ in range(2500):
            x, y = r.uniform(-1.2, 4.2), r.uniform(-1.2, 3.2)
            assert inside(found[k], x, y) == inside(parts, x, y), (k, x, y)
        assert sums[k].area_graus == pytest.approx(total(found[k])) and inside(parts, sums[k].lon, sums[k].lat)
    assert total(found["bow tie"]) == pytest.approx(2) and len(found["bow tie"]) == 2
    assert total(found["spike"]) == pytest.approx(4)


def test_anchor_lies_inside(spark):
    ring = [box(0, 0, 4, 4), box(0.5, 0.5, 3.5, 3.5)]
    comb = [(0, 0), (9, 0), (9, 5), (8, 5), (8, 1), (1, 1), (1, 5), (0, 5)]
    shapes = {1: [[SQUARE]], 2: [[CONCAVE, HOLE]], 3: [ring], 4: [[comb]], 5: [[SQUARE], [shifted(FAR, 9, 9)]], 6: [ring, [box(10, 10, 11, 11)]]}
    shapes = {k: [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in parts] for k, parts in shapes.items()}
    rows = frame(spark, shapes).select("municipio_ibge", g.anchor(F.col("partes")).alias("a")).collect()
    for r in rows:
        assert inside(shapes[r.municipio_ibge], r.a.x, r.a.y)
    centroid = {r.municipio_ibge: r for r in geo.shapes(frame(spark, shapes), "municipio_ibge").collect()}
    assert not inside(shapes[3], centroid[3].lon, centroid[3].lat) and not inside(shapes[4], centroid[4].lon, centroid[4].lat)
    assert all(abs(r.a.width) > 0 for r in rows)
    flat = frame(spark, {7: [[[(1.0, 2.0), (3.0, 2.0)]]]}).select(g.anchor(F.col("partes")).alias("a")).first()
    assert (flat.a.x, flat.a.y) == (1.0, 2.0)


def test_only_broken_shapes_are_changed(spark):
    bow = [(0, 0), (2, 2), (2, 0), (0, 2)]
    shapes = {"bow": [[bow]], "good": [[CONCAVE[::-1], HOLE], [FAR]], "doubled": [[[(0, 0), (1, 0), (2, 0), (1, 0), (1, 1)]]]}
    found = outlines(outline.sound(keyed(spark, list(shapes.items())), "k"))
    assert found["good"] == [[[tuple(map(float, p)) for p in ring] for ring in part] for part in shapes["good"]]
    assert len(found["bow"]) == 2 and [corners(p[0]) for p in found["doubled"]] == [{(0, 0), (1, 0), (1, 1)}]


def test_no_shapes(spark):
    assert outline.dissolved(keyed(spark, []), "k").count() == 0
    assert Counter(outlines(outline.repaired(keyed(spark, [("x", [])]), "k"))) == Counter()


def test_small_shapes_lie_in_one_cell(spark):
    """Their sides meet once, not again in each cell that two of them pass."""
    sides = outline._numbered(outline.segments(keyed(spark, [("a", [[box(0, 0, 4, 4)]]), ("b", [[box(0, 0, 3, 1)], [box(5, 5, 6, 6)]])]), "k"), "k", "few")
    cells = outline._cells(sides, "k")
    assert cells.count() == sides.count() == 12
    many = outline._numbered(outline.segments(keyed(spark, [("c", [[box(x, y, x + 1, y + 1)] for x in range(0, 40, 2) for y in range(0, 40, 2)])]), "k"), "k", "many")
    per_cell = [r["count"] for r in outline._cells(many, "k").groupBy("i", "j").count().collect()]
    assert len(per_cell) > 50 and max(per_cell) <= 4 * outline.IN_CELL


def test_cuts_of_broken_shapes_are_found_once(spark, monkeypatch):
    calls, cuts = [], outline.cuts
    monkeypatch.setattr(outline, "cuts", lambda *a, **b: calls.append(1) or cuts(*a, **b))
    shapes = keyed(spark, [("bow", [[[(0, 0), (2, 2), (2, 0), (0, 2)]]]), ("sound", [[box(0, 0, 1, 1)]])])
    found = outlines(outline.sound(shapes, "k"))
    assert sorted(found) == ["bow", "sound"] and len(found["bow"]) == 2 and len(calls) == 1
