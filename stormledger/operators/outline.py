"""Outlines of joined polygons: shared borders dissolved, rings put together, crossings repaired.

Everything is a join or an aggregate over directed segments that have the inside
on their left. Segments that two neighbours share run in opposite directions and
cancel; what is left is noded, so that a corner of one shape on another's side (a
T-junction) or a crossing becomes an end of both, and cancels once more. Which
segment follows which is settled corner by corner, rings are numbered and ordered
by pointer jumping, and a ring that lies in an odd number of others is a hole.

No state, zone or ring is worked on as one group until its points are put into
the outline, which is one value of the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from stormledger.functions import geometry as g
from stormledger.sources.files import scratch

#: Distance, in degrees, below which a corner lies on a side.
TOLERANCE = 1e-9
#: Decimal places of a crossing, so that lines that meet in one point do.
PLACES = 10
#: Segments that meet in a cell: smaller cells hold most segments more than once.
IN_CELL = 16
_ENDS = ("xa", "ya", "xb", "yb")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written and read back: lineage is cut, and numbers given to rows stay theirs."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def segments(shapes: DataFrame, key: str) -> DataFrame:
    """Sides of all rings, outer rings counter-clockwise and holes clockwise."""
    rings = shapes.select(key, F.explode(g.part_rings(F.col("partes"))).alias("r"))
    sign = g.ring_sign(g.signed_area(F.col("r.anel")), F.col("r.externo"))
    ring = F.when(sign < 0, F.reverse(F.col("r.anel"))).otherwise(F.col("r.anel"))
    sides = rings.select(key, F.explode(g.ring_edges(ring)).alias("e")).select(key, "e.*")
    return sides.filter((F.col("xa") != F.col("xb")) | (F.col("ya") != F.col("yb")))


def uncancelled(sides: DataFrame, key: str) -> DataFrame:
    """Directed segments less those that run the other way over the same two points."""
    a, b = F.struct(F.col("xa").alias("x"), F.col("ya").alias("y")), F.struct(F.col("xb").alias("x"), F.col("yb").alias("y"))
    net = (
        sides.select(key, F.least(a, b).alias("p"), F.greatest(a, b).alias("q"), F.when(a < b, 1).otherwise(-1).alias("way"))
        .groupBy(key, F.col("p.x").alias("px"), F.col("p.y").alias("py"), F.col("q.x").alias("qx"), F.col("q.y").alias("qy"))
        .agg(F.sum("way").alias("net"))
        .filter("net != 0")
    )
    on = F.col("net") > 0
    pick = lambda yes, no, name: F.when(on, F.col(yes)).otherwise(F.col(no)).alias(name)
    return net.select(key, pick("px", "qx", "xa"), pick("py", "qy", "ya"), pick("qx", "px", "xb"), pick("qy", "py", "yb"))


def _numbered(sides: DataFrame, key: str, name: str) -> DataFrame:
    return _kept(sides.select(key, F.monotonically_increasing_id().alias("id"), *_ENDS), name)


def _cells(sides: DataFrame, key: str) -> DataFrame:
    """Segments beside each cell they pass; a key has about a cell for every ``IN_CELL`` segments."""
    low, high = lambda a: F.least(f"{a}a", f"{a}b"), lambda a: F.greatest(f"{a}a", f"{a}b")
    frame = sides.groupBy(key).agg(
        F.min(low("x")).alias("west"),
        F.min(low("y")).alias("south"),
        F.greatest(F.max(high("x")) - F.min(low("x")), F.max(high("y")) - F.min(low("y"))).alias("size"),
        F.count(F.lit(1)).alias("n"),
    )
    # A little more room on each side, so that the outermost segments lie in no cell beyond.
    room = F.col("size") * 0.005
    h = F.col("size") * 1.01 / F.ceil(F.sqrt(F.col("n") / F.lit(float(IN_CELL))))
    frame = frame.select(F.col(key).alias("frame_key"), (F.col("west") - room).alias("west"), (F.col("south") - room).alias("south"), h.alias("h"))
    at = lambda value, origin, slack: F.floor((value - F.col(origin)) / F.col("h") + F.lit(slack)).cast("long")
    xa, ya, xb, yb = (F.col(c) for c in _ENDS)
    slope = (yb - ya) / F.nullif(xb - xa, F.lit(0.0))
    # Heights where the segment enters and leaves a column of cells, or its own ends there.
    height = lambda x: F.coalesce(ya + (F.greatest(low("x"), F.least(high("x"), x)) - xa) * slope, ya)
    left, right = F.col("west") + F.col("i") * F.col("h"), F.col("west") + (F.col("i") + 1) * F.col("h")
    upright = xa == xb
    bottom = F.when(upright, low("y")).otherwise(F.least(height(left), height(right)))
    top = F.when(upright, high("y")).otherwise(F.greatest(height(left), height(right)))
    placed = sides.join(frame, sides[key].eqNullSafe(F.col("frame_key"))).drop("frame_key")
    columns = placed.withColumn("i", F.explode(F.sequence(at(low("x"), "west", -1e-6), at(high("x"), "west", 1e-6))))
    cells = columns.withColumn("j", F.explode(F.sequence(at(bottom, "south", -1e-6), at(top, "south", 1e-6))))
    return cells.select(key, "id", *_ENDS, "i", "j")


def _cross(ax, ay, bx, by) -> Column:
    return ax * by - ay * bx


def cuts(sides: DataFrame, key: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Where segments (key, id, ends) are touched or crossed by another of their key: (key, id, at, x, y)."""
    cells = _cells(sides, key)
    one, two = cells.alias("s"), cells.alias("t")
    s, t = ([F.col(f"{name}.{c}") for c in _ENDS] for name in ("s", "t"))
    near = lambda a, b: (F.least(s[a], s[b]) <= F.greatest(t[a], t[b]) + tolerance) & (F.least(t[a], t[b]) <= F.greatest(s[a], s[b]) + tolerance)
    same_cell = (F.col(f"s.{key}").eqNullSafe(F.col(f"t.{key}"))) & (F.col("s.i") == F.col("t.i")) & (F.col("s.j") == F.col("t.j"))
    pairs = one.join(two, same_cell & (F.col("s.id") < F.col("t.id")) & near(0, 2) & near(1, 3))

    def touch(who: str, line: list[Column], x: Column, y: Column) -> tuple[Column, Column]:
        """Whether a point lies within a segment, and the cut it makes."""
        dx, dy, px, py = line[2] - line[0], line[3] - line[1], x - line[0], y - line[1]
        size = F.sqrt(dx * dx + dy * dy)
        along = (px * dx + py * dy) / size
        on = (F.abs(_cross(dx, dy, px, py)) <= size * tolerance) & (along > tolerance) & (along < size - tolerance)
        return on, F.struct(F.col(f"{who}.id").alias("id"), (along / size).alias("at"), x.alias("x"), y.alias("y"))

    touches = [touch("s", s, t[0], t[1]), touch("s", s, t[2], t[3]), touch("t", t, s[0], s[1]), touch("t", t, s[2], s[3])]
    side = lambda line, x, y: _cross(line[2] - line[0], line[3] - line[1], x - line[0], y - line[1])
    c, d, a, b = side(s, t[0], t[1]), side(s, t[2], t[3]), side(t, s[0], s[1]), side(t, s[2], s[3])
    proper = (F.signum(c) * F.signum(d) < 0) & (F.signum(a) * F.signum(b) < 0)
    for on, _ in touches:
        proper = proper & ~on
    on_s, on_t = a / F.nullif(a - b, F.lit(0.0)), c / F.nullif(c - d, F.lit(0.0))
    x, y = F.round(s[0] + on_s * (s[2] - s[0]), PLACES), F.round(s[1] + on_s * (s[3] - s[1]), PLACES)
    cut = lambda who, at: F.struct(F.col(f"{who}.id").alias("id"), at.alias("at"), x.alias("x"), y.alias("y"))
    found = F.array(*[F.when(on, p) for on, p in touches], F.when(proper, cut("s", on_s)), F.when(proper, cut("t", on_t)))
    return pairs.select(F.col(f"s.{key}").alias(key), F.explode(F.filter(found, lambda p: p.isNotNull())).alias("p")).select(key, "p.*")


def noded(sides: DataFrame, key: str, tolerance: float = TOLERANCE, known: DataFrame | None = None) -> DataFrame:
    """Segments (key, id, ends) cut wherever another of the key touches or crosses them; ``known`` are their cuts."""
    found = (
        (cuts(sides, key, tolerance) if known is None else known)
        .groupBy(F.col("id").alias("cut_id"))
        .agg(F.array_sort(F.collect_set(F.struct("at", "x", "y"))).alias("cuts"))
    )
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ends = point(F.col("xa"), F.col("ya")), point(F.col("xb"), F.col("yb"))
    inner = F.transform(F.col("cuts"), lambda p: point(p["x"], p["y"]))
    chain = F.when(F.col("cuts").isNull(), F.array(*ends)).otherwise(F.concat(F.array(ends[0]), inner, F.array(ends[1])))
    steps = F.zip_with(
        F.slice("c", F.lit(1), F.size("c") - 1),
        F.slice("c", F.lit(2), F.size("c") - 1),
        lambda p, q: F.struct(p["x"].alias("xa"), p["y"].alias("ya"), q["x"].alias("xb"), q["y"].alias("yb")),
    )
    out = sides.join(found, sides["id"] == found["cut_id"], "left").select(key, chain.alias("c"))
    return out.select(key, F.explode(steps).alias("e")).select(key, "e.*").filter((F.col("xa") != F.col("xb")) | (F.col("ya") != F.col("yb")))


# --- rings ------------------------------------------------------------------------


def _followed(sides: DataFrame, key: str) -> DataFrame:
    """Each segment with the one that follows it: (id, next).

    Around a corner, arrivals and departures are matched like brackets, in
    clockwise order: what arrives leaves by the next way that keeps the inside on
    its left, and no two paths cross.
    """
    angle = lambda dx, dy: F.atan2(dy, dx)
    dx, dy = F.col("xb") - F.col("xa"), F.col("yb") - F.col("ya")
    leaving = sides.select(key, F.col("xa").alias("x"), F.col("ya").alias("y"), F.struct((-angle(dx, dy)).alias("turn"), F.lit(False).alias("arrives"), "id").alias("e"))
    arriving = sides.select(key, F.col("xb").alias("x"), F.col("yb").alias("y"), F.struct((-angle(-dx, -dy)).alias("turn"), F.lit(True).alias("arrives"), "id").alias("e"))
    corners = leaving.unionAll(arriving).groupBy(key, "x", "y").agg(F.array_sort(F.collect_list("e")).alias("es"))
    pair = "array<struct<id:bigint,next:bigint>>"
    start = F.struct(F.array().cast("array<bigint>").alias("open"), F.array().cast("array<bigint>").alias("early"), F.array().cast(pair).alias("pairs"))
    made = lambda a, b: F.array(F.struct(a.alias("id"), b.alias("next")))

    def step(acc: Column, e: Column) -> Column:
        empty = F.size(acc["open"]) == 0
        last = F.element_at(acc["open"], -1)
        put = lambda open_, early, pairs: F.struct(open_.alias("open"), early.alias("early"), pairs.alias("pairs"))
        return (
            F.when(e["arrives"], put(F.concat(acc["open"], F.array(e["id"])), acc["early"], acc["pairs"]))
            .when(empty, put(acc["open"], F.concat(acc["early"], F.array(e["id"])), acc["pairs"]))
            .otherwise(put(F.slice(acc["open"], F.lit(1), F.size(acc["open"]) - 1), acc["early"], F.concat(acc["pairs"], made(last, e["id"]))))
        )

    # Departures before any arrival belong to the last ones, round the corner.
    rest = lambda acc: F.zip_with(F.reverse(acc["open"]), acc["early"], lambda a, b: F.struct(a.alias("id"), b.alias("next")))
    matched = F.aggregate("es", start, step, lambda acc: F.concat(acc["pairs"], rest(acc)))
    simple = F.when((F.size("es") == 2), made(F.filter("es", lambda e: e["arrives"])[0]["id"], F.filter("es", lambda e: ~e["arrives"])[0]["id"]))
    return corners.select(F.explode(F.coalesce(simple, matched)).alias("p")).select("p.*").filter("id is not null and next is not null")


def _ordered(sides: DataFrame, following: DataFrame, key: str) -> DataFrame:
    """Segments with their ring (its smallest segment) and place in it, by pointer jumping.

    Each round looks four times as far ahead: a segment knows the smallest one so
    far and how many steps ahead it is. A ring of n segments takes log4(n) rounds.
    """
    state = _kept(following.select("id", F.col("next").alias("to"), F.col("id").alias("ring"), F.lit(0).cast("long").alias("ahead")), "ring-0")
    reach, turn = 1, 0
    while True:
        look = state
        for hop in (1, 2, 3):
            far = state.select(F.col("id").alias("far_id"), F.col("to").alias("far_to"), F.col("ring").alias("far_ring"), F.col("ahead").alias("far_ahead"))
            better = F.col("far_ring") < F.col("ring")
            look = look.join(far, F.col("to") == F.col("far_id")).select(
                "id",
                F.col("far_to").alias("to"),
                F.least("ring", "far_ring").alias("ring"),
                F.when(better, F.col("far_ahead") + hop * reach).otherwise(F.col("ahead")).alias("ahead"),
                *([F.col("was")] if hop > 1 else [F.col("ring").alias("was")]),
            )
        turn, reach = turn + 1, reach * 4
        look = _kept(look, f"ring-{turn}")
        state = look.drop("was")
        if look.filter("ring != was").isEmpty():
            break
    sizes = state.groupBy(F.col("ring").alias("sized")).agg(F.count(F.lit(1)).alias("sides"))
    placed = state.join(sizes, F.col("ring") == F.col("sized")).select("id", "ring", F.pmod(F.col("sides") - F.col("ahead"), F.col("sides")).alias("place"))
    return sides.join(placed, "id")


def _split(sides: DataFrame, following: DataFrame, key: str) -> DataFrame:
    """Order of rings that pass no corner twice: those that do are cut there."""
    ordered = _kept(_ordered(sides, following, key), "rings")
    visit = F.struct("place", F.col("id").alias("leaves"))
    twice = ordered.groupBy(key, "ring", "xa", "ya").agg(F.array_sort(F.collect_list(visit)).alias("v")).filter(F.size("v") > 1)
    if twice.isEmpty():
        return ordered
    # What arrives for the next visit leaves where this visit did; the last arrives for the first.
    ahead = F.concat(F.slice("v", F.lit(2), F.size("v") - 1), F.slice("v", F.lit(1), F.lit(1)))
    moves = twice.select(F.explode(F.zip_with("v", ahead, lambda now, then: F.struct(now["leaves"].alias("new"), then["leaves"].alias("old")))).alias("m")).select("m.*")
    changed = (
        following.join(moves, F.col("next") == F.col("old"), "left")
        .select("id", F.coalesce("new", "next").alias("next"))
    )
    return _ordered(sides, changed, key)


def rings(sides: DataFrame, key: str) -> DataFrame:
    """Closed rings of directed segments (key, id, ends): ring, points, signed area."""
    following = _kept(_followed(sides, key), "followed")
    ordered = _split(sides, following, key)
    points = F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("xa").alias("x"), F.col("ya").alias("y")))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    found = ordered.groupBy(key, "ring").agg(points.alias("anel"))
    # The first point is the smallest one, so a ring does not depend on the order of its segments.
    first = F.array_position("anel", F.array_min("anel")).cast("int")
    turned = F.concat(F.slice("anel", first, F.size("anel")), F.slice("anel", F.lit(1), first - 1))
    return found.withColumn("anel", turned).withColumn("area", g.signed_area(F.col("anel")))


def parts(found: DataFrame, key: str) -> DataFrame:
    """Rings put into polygons: (key, partes), outer rings clockwise and holes the other way.

    A ring inside an even number of others is an outer one; any other is a hole
    of the smallest ring around it. Pairs are formed only where a box holds the
    middle of the ring's first side, which lies on no other ring.
    """
    axis = lambda name: F.transform("anel", lambda p: p[name])
    middle = lambda name: ((F.get("anel", F.lit(0))[name] + F.get("anel", F.lit(1))[name]) / 2.0).alias(f"m{name}")
    flat = _kept(found.filter("area != 0"), "flat-rings")
    inner = flat.select(F.col(key).alias("inner_key"), F.col("ring").alias("inner"), middle("x"), middle("y"))
    box = [F.array_min(axis("x")).alias("west"), F.array_max(axis("x")).alias("east"), F.array_min(axis("y")).alias("south"), F.array_max(axis("y")).alias("north")]
    outer = flat.select(key, "ring", "anel", F.abs("area").alias("size"), *box)
    in_box = F.col("mx").between(F.col("west"), F.col("east")) & F.col("my").between(F.col("south"), F.col("north"))
    around = (
        inner.join(outer, F.col("inner_key").eqNullSafe(F.col(key)) & (F.col("inner") != F.col("ring")) & in_box)
        .filter(g.ring_holds(F.col("anel"), F.col("mx"), F.col("my")))
        .groupBy("inner")
        .agg(F.count(F.lit(1)).alias("depth"), F.min_by("ring", F.struct("size", "ring")).alias("host"))
    )
    placed = flat.join(around, F.col("ring") == F.col("inner"), "left")
    hole = F.coalesce(F.col("depth") % 2 == 1, F.lit(False))
    turned = F.when((F.col("area") > 0) != hole, F.reverse("anel")).otherwise(F.col("anel"))
    # Turned around, a ring still begins at its smallest point.
    turned = F.when((F.col("area") > 0) != hole, F.concat(F.slice(turned, F.size(turned), F.lit(1)), F.slice(turned, F.lit(1), F.size(turned) - 1))).otherwise(turned)
    owned = placed.select(key, F.when(hole, F.col("host")).otherwise(F.col("ring")).alias("part"), F.struct(hole.alias("hole"), turned.alias("anel")).alias("r"))
    polygons = owned.groupBy(key, "part").agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["anel"]).alias("p"))
    return polygons.groupBy(key).agg(F.array_sort(F.collect_list("p")).alias("partes"))


def dissolved(shapes: DataFrame, key: str, tolerance: float = TOLERANCE) -> DataFrame:
    """One outline (key, partes) per key from shapes (key, partes) that touch but do not overlap.

    Borders between shapes of a key vanish, gaps between them become holes.
    Shapes that meet in one point stay separate parts. A shape listed twice
    counts once. Shapes without area leave nothing; a key of only such shapes
    has no row. A null key is a key like any other.
    """
    sides = _numbered(uncancelled(segments(shapes.select(key, "partes").distinct(), key), key), key, "borders")
    left = _numbered(uncancelled(noded(sides, key, tolerance), key), key, "outline-sides")
    return parts(rings(left, key), key)


def _sides(shapes: DataFrame, key: str) -> DataFrame:
    """Sides of all rings in the direction they are given in."""
    rows = shapes.select(key, F.explode(g.part_rings(F.col("partes"))).alias("r"))
    sides = rows.select(key, F.explode(g.ring_edges(F.col("r.anel"))).alias("e")).select(key, "e.*")
    return sides.filter((F.col("xa") != F.col("xb")) | (F.col("ya") != F.col("yb")))


def repaired(shapes: DataFrame, key: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Shapes (key, partes) without crossings: a point is inside where a line to it crosses an odd number of sides.

    Rings are cut where they cross or touch themselves or another ring of the
    shape; sides run over forth and back vanish. A key is one shape.
    """
    return _recut(noded(_numbered(_sides(shapes, key), key, "shape-sides"), key, tolerance), key)


def _recut(cut: DataFrame, key: str) -> DataFrame:
    return parts(rings(_numbered(uncancelled(cut, key), key, "cut-sides"), key), key)


def sound(shapes: DataFrame, key: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Shapes (key, partes), repaired where a side touches or crosses another or is run over twice; others as they are."""
    sides = _numbered(_sides(shapes, key), key, "sides")
    points = [F.struct(F.col(f"x{e}").alias("x"), F.col(f"y{e}").alias("y")) for e in "ab"]
    doubled = sides.groupBy(key, F.least(*points).alias("p"), F.greatest(*points).alias("q")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = _kept(cuts(sides, key, tolerance), "cuts")
    broken = _kept(found.select(key).union(doubled.select(key)).distinct(), "broken")
    if broken.isEmpty():
        return shapes.select(key, "partes")
    marked = shapes.select(key, "partes").join(broken.withColumn("broken", F.lit(True)), key, "left")
    whole = marked.filter("broken is null").select(key, "partes")
    # The sides of these shapes are numbered and their cuts are found already. A null key is never marked.
    cut = noded(sides.join(broken, key, "left_semi"), key, tolerance, found)
    return whole.unionByName(_recut(cut, key))


def zone_outlines(bridge: DataFrame, meshes: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Dissolved outline of each zone: (conjunto, partes)."""
    links = bridge.select("conjunto", "municipio_ibge").distinct()
    return dissolved(links.join(meshes, "municipio_ibge").select("conjunto", "partes"), "conjunto", tolerance)


def measured(outlines: DataFrame, *keys: str) -> DataFrame:
    """Outlines (partes) beside their well-known text, an anchor point inside and the area."""
    size = F.aggregate(g.part_rings(F.col("partes")), F.lit(0.0), lambda a, r: a + F.when(r["externo"], 1.0).otherwise(-1.0) * F.abs(g.signed_area(r["anel"])))
    anchor = g.anchor(F.col("partes"))
    return outlines.select(*keys, "partes", size.alias("area_graus"), anchor.alias("a")).select(
        *keys, g.wkt(F.col("partes")).alias("wkt"), F.col("a.x").alias("lon"), F.col("a.y").alias("lat"), "area_graus", "partes"
    )
