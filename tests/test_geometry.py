"""Predicates and measures, polygons judged by JTS."""

import random

import pytest
from pyspark.sql import functions as F
from shapes import Jts, boxes, points, polygons, square, star

from meshfold.functions import geometry as g
from meshfold.operators import knn, range_query

HOLED = [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(3, 3), (7, 3), (7, 7), (3, 7), (3, 3)]]
ELL = [[(0, 0), (8, 0), (8, 4), (4, 4), (4, 8), (0, 8), (0, 0)]]


def _one(spark, column):
    return spark.range(1).select(column).first()[0]


def lit(*values):
    return [F.lit(float(v)) for v in values]


# Circles and boxes with known answers.
@pytest.mark.parametrize("circle, window, meets", [
    ((0.0, 0.0, 0.1), (-0.1, 0.1, -0.1, 0.1), True),
    ((-0.1, 0.0, 0.1), (-0.1, 0.1, -0.1, 0.1), True),
    ((-0.3, 0.0, 0.1), (-0.1, 0.1, -0.1, 0.1), False),
    ((-112.574945, 45.987772, 0.01), (-158.104182, -65.649956, 17.982169, 48.803593), True),
    ((2.0, 2.0, 1.0), (0.0, 1.0, 0.0, 1.0), False),  # near the corner only by its box
    ((4.0, 5.0, 5.0), (-1.0, 1.0, 0.0, 1.0), True),  # corner exactly on the circle
])
def test_circle_meets_box(spark, circle, window, meets):
    assert _one(spark, g.circle_intersects_box(*lit(*circle), g.window_box(window))) is meets


def test_circle_and_point(spark):
    on = lit(0, 0, 5, 3, 4)
    assert _one(spark, g.circle_contains_point(*on)) is False
    assert _one(spark, g.circle_intersects_point(*on)) is True
    assert _one(spark, g.circle_contains_point(*lit(0, 0, 0.1, 0, 0))) is True


def test_circle_of_box(spark):
    row = spark.range(1).select(*g.box_to_circle(g.window_box((-0.1, 0.1, -0.1, 0.3)))).first()
    assert row[0] == pytest.approx(0) and row[1] == pytest.approx(0) and row[2] == pytest.approx(0.1)
    assert list(spark.range(1).select(*g.circle_box(*lit(1, 2, 3))).first()) == [-2, 4, -1, 5]


def test_boxes_are_closed(spark):
    a, touching, apart, inner = (g.window_box(w) for w in ((0, 2, 0, 2), (2, 3, 2, 3), (2.1, 3, 0, 1), (0, 1, 1, 2)))
    assert _one(spark, g.boxes_intersect(a, touching)) and not _one(spark, g.boxes_intersect(a, apart))
    assert _one(spark, g.box_contains_box(a, inner)) and not _one(spark, g.box_contains_box(inner, a))
    assert _one(spark, g.box_contains_point(a, *lit(2, 0))) and not _one(spark, g.box_contains_point(a, *lit(2, -0.1)))
    assert _one(spark, g.box_distance(a, *lit(5, 6))) == 5 and _one(spark, g.box_distance(a, *lit(1, 1))) == 0


def test_window_corners_in_any_order(spark):
    assert list(spark.range(1).select(*g.window_box((3, 1, 4, 2))).first()) == [1, 3, 2, 4]


def _shapes():
    rng = random.Random(3)
    shapes = {0: HOLED, 1: ELL, 2: square(0, 0, 4)}
    shapes |= {i: star(rng, rng.uniform(-2, 8), rng.uniform(-2, 8), rng.uniform(2, 6)) for i in range(3, 15)}
    return shapes


def test_points_against_jts(spark):
    """On a lattice, so that many points fall on vertices and edges."""
    shapes, jts = _shapes(), Jts(spark)
    shapes = {i: s for i, s in shapes.items() if jts.polygon(s).isValid()}
    lattice = [(x / 2, y / 2) for x in range(-4, 24, 1) for y in range(-4, 24, 3)]
    of = {i: jts.polygon(s) for i, s in shapes.items()}
    expected = {}
    for i, s in of.items():
        for k, (x, y) in enumerate(lattice):
            p = jts.point(x, y)
            expected[i, k] = (s.contains(p), s.covers(p), s.distance(p))
    tested = points(spark, lattice).withColumnRenamed("id", "k").crossJoin(polygons(spark, shapes))
    rows = tested.select("id", "k", *(F.expr(g.over_edges("rings", e)).alias(n) for n, e in {
        "contains": g.polygon_contains_point("edges_", "x", "y"),
        "few": g.few_edges_contain_point("edges_", "x", "y", few=8),
        "covers": g.polygon_covers_point("edges_", "x", "y"),
        "distance": g.polygon_distance("edges_", "x", "y"),
    }.items())).collect()
    assert len(rows) == len(expected)
    for r in rows:
        contains, covers, distance = expected[r["id"], r["k"]]
        assert (r["contains"], r["few"], r["covers"]) == (contains, contains, covers), r
        assert r["distance"] == pytest.approx(distance, abs=1e-9)


def test_boxes_against_jts(spark):
    shapes, jts = _shapes(), Jts(spark)
    windows = [(3.5, 6.5, 3.5, 6.5), (3, 7, 3, 7), (10, 12, 0, 5), (-5, 20, -5, 20), (5, 9, 5, 9), (4, 6, 4, 6), (8, 9, 4, 5), (-3, -1, -3, -1)]
    table = polygons(spark, shapes)
    for w in windows:
        box = jts.box(w)
        for condition, expected in (
            ("intersects", {i for i, s in shapes.items() if box.intersects(jts.polygon(s))}),
            ("contains", {i for i, s in shapes.items() if box.contains(jts.polygon(s))}),
        ):
            assert {r["id"] for r in range_query.range_polygons(table, w, condition).collect()} == expected, (w, condition)


def test_containment_against_jts(spark):
    """Random, touching, identical and holed polygons, each against each."""
    jts, shapes = Jts(spark), _shapes()
    extra = [
        square(0, 0, 2), square(2, 2, 2), square(1, 1, 2), square(3, 3, 4), square(4, 4, 2), square(2, 2, 6), square(0, 0, 10),
        [[(0, 0), (4, 0), (4, 4), (0, 0)]], [[(1, 1), (9, 1), (9, 2), (1, 2), (1, 1)]], [[(0, 4), (4, 4), (4, 8), (0, 8), (0, 4)]],
        [[(4, 4), (8, 4), (8, 8), (4, 8), (4, 4)]], [[(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]], [[(3, 0), (7, 0), (7, 3), (3, 3), (3, 0)]],
    ]
    shapes |= {100 + i: s for i, s in enumerate(extra)}
    shapes = {i: s for i, s in shapes.items() if jts.polygon(s).isValid()}
    of = {i: jts.polygon(s) for i, s in shapes.items()}
    expected = {(a, b) for a in of for b in of if of[a].contains(of[b])}
    table = polygons(spark, shapes)
    side = lambda prefix: table.select(
        F.col("id").alias(prefix + "id"), F.expr(g.edges("rings")).alias(prefix + "edges"), *g.box_columns(g.rings_box("rings"), prefix))
    test = F.expr(g.polygon_contains_polygon("w_edges", "o_edges", "o_"))
    pairs = side("w_").crossJoin(side("o_")).where(g.box_contains_box(g.box("w_"), g.box("o_")) & test)
    assert {(r["w_id"], r["o_id"]) for r in pairs.select("w_id", "o_id").collect()} == expected


def test_nearest_neighbours(spark):
    rng = random.Random(5)
    table = points(spark, [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(200)])  # many ties
    rows = [(r["id"], ((r["x"] - 4) ** 2 + (r["y"] - 4) ** 2) ** 0.5) for r in table.collect()]
    expected = sorted(rows, key=lambda r: (r[1], r[0]))
    for k in (1, 17, 200, 500):
        found = [(r["id"], r["distance"]) for r in knn.knn_points(table, (4, 4), k).orderBy("distance", "id").collect()]
        assert found == expected[:k]
    with pytest.raises(ValueError):
        knn.knn_points(table, (4, 4), 0)


def test_nearest_shapes(spark):
    jts, shapes = Jts(spark), _shapes()
    p = jts.point(12.0, -3.0)
    expected = sorted((jts.polygon(s).distance(p), i) for i, s in shapes.items())
    for k in (1, 4, 50):
        found = knn.knn_polygons(polygons(spark, shapes), (12, -3), k).orderBy("distance", "id").collect()
        assert [r["distance"] for r in found] == pytest.approx([d for d, _ in expected[:k]])
    rects = boxes(spark, [(0, 1, 0, 1), (5, 6, 0, 1), (0, 9, 0, 9)])
    assert [(r["id"], r["distance"]) for r in knn.knn_rectangles(rects, (5.5, 0.5), 3).collect()] == [(1, 0.0), (2, 0.0), (0, 4.5)]


def test_unknown_condition(spark):
    with pytest.raises(ValueError):
        range_query.range_points(points(spark, [(0, 0)]), (0, 1, 0, 1), "near")


def test_most_pairs_of_polygons_need_no_exact_test(spark):
    """Small diamonds around a large L and a diamond: edges that don't come near settle most, and never against the exact test."""
    rng, rows = random.Random(4), []
    outers = [[[(0, 0), (8, 0), (8, 4), (4, 4), (4, 8), (0, 8), (0, 0)]], [[(8, 4), (4, 8), (0, 4), (4, 0), (8, 4)]]]
    for k in range(600):
        x, y, r = (rng.choice([rng.uniform(0, 8), rng.randrange(9)]), rng.choice([rng.uniform(0, 8), rng.randrange(9)]), rng.choice([0.25, 0.5]))
        inner = [[(x + r, y), (x, y + r), (x - r, y), (x, y - r), (x + r, y)]]
        rows.append((k, *([[{"x": float(a), "y": float(b)} for a, b in ring] for ring in shape] for shape in (outers[k % 2], inner))))
    ring = "array<array<struct<x:double,y:double>>>"
    df = spark.createDataFrame(rows, f"id int, a {ring}, b {ring}").select(
        "id", F.expr(g.edges("a")).alias("w_edges"), F.expr(g.edges("b")).alias("o_edges"), *g.box_columns(g.rings_box("b"), "o_"))
    exact = g.polygon_contains_polygon("w_edges", "o_edges", "o_")
    many = exact.replace(g._few_edges_clear("w_edges", "o_"), "false")
    assert many != exact
    found = df.select(F.expr(exact).alias("quick"), F.expr(many).alias("exact"), F.expr(g._few_edges_clear("w_edges", "o_")).alias("clear")).collect()
    assert [r["quick"] for r in found] == [r["exact"] for r in found] and {r["exact"] for r in found} == {True, False}
    assert sum(r["clear"] for r in found) > 300
