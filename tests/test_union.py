"""Union against JTS, driver side."""

import math
import random

import pytest
from shapes import Jts, polygons, square, star

from meshfold.operators import union
from meshfold.plans.cells import Limits

CASES = {
    "disjoint": [square(0, 0, 1), square(5, 5, 2)],
    "overlapping": [square(0, 0, 2), square(1, 1, 2)],
    "identical": [square(0, 0, 2), square(0, 0, 2)],
    "identical, other direction": [square(0, 0, 2), [square(0, 0, 2)[0][::-1]]],
    "nested": [square(0, 0, 9), square(2, 2, 3)],
    "nested, sharing an edge": [square(0, 0, 4), square(0, 1, 2)],
    "side by side": [square(0, 0, 2), square(2, 0, 2)],
    "partly side by side": [square(0, 0, 2), square(2, 1, 3)],
    "touching in a corner": [square(0, 0, 1), square(1, 1, 1)],
    "around a hole": [square(0, 0, 3), square(3, 0, 3), square(6, 0, 3), square(0, 3, 3), square(6, 3, 3),
                      square(0, 6, 3), square(3, 6, 3), square(6, 6, 3)],
    "hole filled": [[*square(0, 0, 9), *square(3, 3, 3)], square(3, 3, 3)],
    "hole partly filled": [[*square(0, 0, 9), *square(3, 3, 3)], square(2, 2, 2)],
    "same corner": [[[(0, 0), (4, 0), (0, 4), (0, 0)]], [[(0, 0), (4, 0), (4, 4), (0, 0)]]],
}


def _compare(spark, shapes, limits=Limits()):
    jts = Jts(spark)
    whole = jts.union(shapes)
    table = polygons(spark, dict(enumerate(shapes)))
    pieces = union.union_boundary(table, limits=limits).collect()
    area = sum(r["x1"] * r["y2"] - r["x2"] * r["y1"] for r in pieces) / 2
    length = sum(math.dist((r["x1"], r["y1"]), (r["x2"], r["y2"])) for r in pieces)
    assert (area, length) == (pytest.approx(whole.getArea(), abs=1e-7), pytest.approx(whole.getLength(), abs=1e-7))
    return table, whole


@pytest.mark.parametrize("name", CASES)
def test_area_and_outline(spark, name):
    _compare(spark, CASES[name])


def test_random_polygons(spark):
    rng = random.Random(9)
    jts, shapes = Jts(spark), []
    while len(shapes) < 40:
        s = star(rng, rng.uniform(0, 20), rng.uniform(0, 20), rng.uniform(1, 5))
        if jts.polygon(s).isValid():
            shapes.append(s)
    table, whole = _compare(spark, shapes)
    assert union.union_area(table).first()["area"] == pytest.approx(whole.getArea())
    parts = union.union_parts(table).collect()
    assert len(parts) == whole.getNumGeometries()
    assert sum(r["polygons"] for r in parts) == 40 and sum(r["area"] for r in parts) == pytest.approx(whole.getArea())


def test_shuffled_plan(spark):
    _compare(spark, CASES["around a hole"], Limits(broadcast_bytes=0, part_rows=4))


def test_parts(spark):
    shapes = {i: square(i, 0, 1) for i in range(12)}  # a chain
    shapes |= {20: square(0, 5, 2), 21: square(1, 6, 2), 22: square(3, 8, 1)}  # an overlap, and a touching corner
    rows = {r["part"]: (r["polygons"], r["area"]) for r in union.union_parts(polygons(spark, shapes)).collect()}
    assert rows == {0: (12, pytest.approx(12)), 20: (2, pytest.approx(7)), 22: (1, pytest.approx(1))}


def test_components(spark):
    nodes = spark.range(200)
    chain = spark.range(99).selectExpr("id AS a", "id + 1 AS b")  # 0 .. 99 in a row
    hub = spark.range(101, 150).selectExpr("CAST(150 AS BIGINT) AS a", "id AS b")
    labels = {r["id"]: r["part"] for r in union.connected_components(nodes, chain.union(hub)).collect()}
    assert all(labels[i] == 0 for i in range(100)) and labels[100] == 100
    assert all(labels[i] == 101 for i in range(101, 151)) and all(labels[i] == i for i in range(151, 200))


def _rings_of(geometry):
    """(shell's area, areas of the holes) of each polygon of a JTS geometry."""
    out = []
    for i in range(geometry.getNumGeometries()):
        p = geometry.getGeometryN(i)
        if not p.isEmpty():
            holes = [p.getFactory().createPolygon(p.getInteriorRingN(k).getCoordinateSequence()).getArea() for k in range(p.getNumInteriorRing())]
            out.append((p.getFactory().createPolygon(p.getExteriorRing().getCoordinateSequence()).getArea(), sorted(holes)))
    return sorted(out)


def _area(ring):
    return sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(ring, ring[1:])) / 2


def _compare_rings(spark, shapes):
    found = []
    for row in union.union_polygons(polygons(spark, dict(enumerate(shapes)))).collect():
        areas = [_area(r) for r in row["rings"]]
        assert areas[0] > 0 and all(a < 0 for a in areas[1:])
        for ring in row["rings"]:
            places = [(round(p["x"], 7), round(p["y"], 7)) for p in ring]
            assert places[0] == places[-1] and len(set(places)) == len(places) - 1  # closed, and no point twice
        found.append((areas[0], sorted(-a for a in areas[1:])))
    want = _rings_of(Jts(spark).union(shapes))
    assert [(pytest.approx(a, abs=1e-7), [pytest.approx(h, abs=1e-7) for h in holes]) for a, holes in want] == sorted(found)


RINGS = {n: CASES[n] for n in ("disjoint", "nested, sharing an edge", "touching in a corner", "around a hole", "hole partly filled")} | {
    "island in a hole": [[*square(0, 0, 9), *square(2, 2, 5)], square(3, 3, 2)],
    "hole touching the shell": [[[(0, 0), (6, 0), (6, 6), (0, 6), (0, 0)], [(0, 3), (2, 2), (2, 4), (0, 3)]]],
    "two holes touching": [square(0, 0, 3), square(3, 0, 3), square(0, 3, 1), square(2, 3, 2), square(5, 3, 1), square(0, 4, 2), square(4, 4, 2), square(2, 5, 2),
                           square(0, 6, 3), square(3, 6, 3)],
    "corners in a ring": [square(0, 0, 1), square(1, 1, 1), square(2, 0, 1), square(1, -1, 1)],
}


@pytest.mark.parametrize("name", RINGS)
def test_rings(spark, name):
    _compare_rings(spark, RINGS[name])


def test_rings_of_random_polygons(spark):
    rng = random.Random(19)
    jts, shapes = Jts(spark), []
    while len(shapes) < 60:
        s = star(rng, rng.uniform(0, 30), rng.uniform(0, 30), rng.uniform(1, 5))
        if jts.polygon(s).isValid():
            shapes.append(s)
    _compare_rings(spark, shapes)


def _crowd(spark, n, seed):
    rng = random.Random(seed)
    jts, shapes = Jts(spark), []
    while len(shapes) < n:
        s = star(rng, rng.uniform(0, 20), rng.uniform(0, 20), rng.uniform(2, 5))
        if jts.polygon(s).isValid():
            shapes.append(s)
    return shapes


def test_a_crowd_is_not_paired(spark):
    """Four times the polygons on one place: sixteen times the pairs, but few of them lie at the outline."""
    from meshfold.operators.covered import covered_stretches

    shapes, rows = _crowd(spark, 480, 5), []
    for some in (shapes[:120], shapes):
        distinct = union._distinct_polygons(polygons(spark, dict(enumerate(some))), "id")
        rows.append(covered_stretches(distinct, Limits())[0].count())
    assert rows[1] < 6 * rows[0]
    table, whole = _compare(spark, shapes)
    parts = union.union_parts(table).collect()
    assert len(parts) == whole.getNumGeometries() and sum(r["polygons"] for r in parts) == 480


@pytest.mark.parametrize("offset", [0, 1e6])
def test_sizes_far_apart(spark, offset):
    """Small ones inside, across the border of and outside a huge one, and many edges along one line and on cells' borders."""
    shapes = [square(offset, offset, 4000)] + [square(offset - 8 + 16 * i, offset + 4000 - 2, 16 if i % 2 else 5) for i in range(40)]
    shapes += [square(offset + 5000, offset + k, 1 + k % 3) for k in range(40)] + [square(offset + 64, offset + 64, 1 + k) for k in range(30)]
    table, whole = _compare(spark, shapes)
    assert len(union.union_parts(table).collect()) == whole.getNumGeometries()


def test_cycles_of_any_length(spark):
    from meshfold.operators import rings

    sizes, links, first = [1, 2, 3, 4, 7, 64, 65, 1000], [], 0
    rng = random.Random(2)
    for size in sizes:
        order = rng.sample(range(first, first + size), size)
        links += list(zip(order, [*order[1:], order[0]]))
        first += size
    after = dict(links)
    for r in rings._cycles(spark.createDataFrame(links, "piece long, next long")).collect():
        at = r["piece"]
        for _ in range(r["steps"]):
            assert at != r["ring"]
            at = after[at]
        assert at == r["ring"] and r["steps"] < 1000
    with pytest.raises(ValueError):
        rings.strung(spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0)], "x1 double, y1 double, x2 double, y2 double"))
