"""The cell join against brute force, on every plan it can choose."""

import random

import pytest
from pyspark.sql import functions as F
from shapes import boxes, points, polygons, square, star

from meshfold.operators import join
from meshfold.plans import cells, ranks
from meshfold.plans.cells import Limits
from meshfold.plans.queries import QUERIES

# Broadcast; shuffle; shuffle with cells split by their rows on both sides, by their pairs; the same, found from a sample.
PLANS = {
    "broadcast": Limits(), "shuffle": Limits(broadcast_bytes=0), "split": Limits(broadcast_bytes=0, part_rows=5),
    "pairs": Limits(broadcast_bytes=0, part_pairs=50), "sampled": Limits(broadcast_bytes=0, part_rows=100, sample_rows=300),
}


def _points(rng, n):
    """A third in one place, a third in a cluster, the rest spread, some on a lattice."""
    rows = [(1.5, 2.5)] * (n // 3) + [(rng.gauss(10, 0.5), rng.gauss(10, 0.5)) for _ in range(n // 3)]
    return rows + [(rng.randint(-20, 20), rng.uniform(-20, 20)) for _ in range(n - len(rows))]


def _boxes(rng, n):
    """From points and lines to larger than everything; corners on the lattice so that boxes touch."""
    rows = [(-1000, 1000, -1000, 1000), (1.5, 1.5, 2.5, 2.5), (0, 40, 3, 3), (-1e-9, 1e-9, 0, 0)]
    while len(rows) < n:
        x, y, s = rng.randint(-20, 20), rng.randint(-20, 20), 2.0 ** rng.randint(-6, 5)
        rows.append((x, x + s, y, y + s * rng.choice([0.01, 1, 3])))
    return rows


def _pairs(df):
    rows = [(r["window_id"], r["object_id"]) for r in df.collect()]
    assert len(rows) == len(set(rows)), "a pair came out twice"
    return set(rows)


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("seed", [1, 2])
def test_points_in_rectangles(spark, plan, seed):
    rng = random.Random(seed)
    pts, wins = _points(rng, 300), _boxes(rng, 80)
    expected = {(w, p) for w, (a, b, c, d) in enumerate(wins) for p, (x, y) in enumerate(pts) if a <= x <= b and c <= y <= d}
    assert _pairs(join.points_in_rectangles(points(spark, pts), boxes(spark, wins), limits=PLANS[plan])) == expected


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("mode", ["exact", "mbr"])
def test_rectangles_in_rectangles(spark, plan, mode):
    rng = random.Random(4)
    objs, wins = _boxes(rng, 120) + [(1, 2, 1, 2)] * 40, _boxes(random.Random(5), 90)

    def hit(w, o):
        if mode == "exact":
            return w[0] <= o[0] and o[1] <= w[1] and w[2] <= o[2] and o[3] <= w[3]
        return o[0] <= w[1] and w[0] <= o[1] and o[2] <= w[3] and w[2] <= o[3]

    expected = {(i, k) for i, w in enumerate(wins) for k, o in enumerate(objs) if hit(w, o)}
    found = join.rectangles_in_rectangles(boxes(spark, objs), boxes(spark, wins), mode=mode, limits=PLANS[plan])
    assert _pairs(found) == expected


@pytest.mark.parametrize("plan", PLANS)
def test_points_in_polygons(spark, plan):
    rng = random.Random(6)
    shapes = {i: star(rng, rng.uniform(-15, 15), rng.uniform(-15, 15), 2.0 ** rng.randint(0, 4), rng.randint(3, 12)) for i in range(40)}
    shapes[40] = [[(-18, -18), (18, -18), (18, 18), (-18, 18), (-18, -18)], [(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)]]
    pts = _points(rng, 400) + [(x, y) for x in range(-8, 9) for y in range(-8, 9)]
    table, wins = points(spark, pts), polygons(spark, shapes)
    # Brute force: every point against every edge of the whole polygon.
    test = F.expr(join.g.over_edges("rings", join.g.polygon_contains_point("edges_", "x", "y")))
    brute = table.withColumnRenamed("id", "object_id").crossJoin(wins.withColumnRenamed("id", "window_id")).where(test)
    expected = {(r["window_id"], r["object_id"]) for r in brute.collect()}
    exact = _pairs(join.points_in_polygons(table, wins, limits=PLANS[plan]))
    assert exact == expected
    assert exact <= _pairs(join.points_in_polygons(table, wins, mode="mbr", limits=PLANS[plan]))


@pytest.mark.parametrize("plan", ["broadcast", "split"])
def test_polygons_in_polygons(spark, plan):
    inner = polygons(spark, {i: square(i % 10, i // 10, 1) for i in range(100)})
    outer = polygons(spark, {0: square(2, 2, 3), 1: square(0.5, 0.5, 1), 2: square(-5, -5, 30), 3: square(9.5, 9.5, 4)})
    exact = _pairs(join.polygons_in_polygons(inner, outer, limits=PLANS[plan]))
    assert exact == {(0, 10 * y + x) for x in (2, 3, 4) for y in (2, 3, 4)} | {(2, i) for i in range(100)}
    meeting = _pairs(join.polygons_in_polygons(inner, outer, mode="mbr", limits=PLANS[plan]))
    assert {o for w, o in meeting if w == 1} == {0, 1, 10, 11} and {o for w, o in meeting if w == 0} == {
        10 * y + x for x in range(1, 6) for y in range(1, 6)}


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("mode", ["exact", "mbr"])
def test_distance_join(spark, plan, mode):
    rng = random.Random(7)
    pts = _points(rng, 200) + [(0, 0), (3, 4), (5, 0), (0.1, 0.2), (0.3, 0.2)]
    r = 5.0

    def near(a, b):
        dx, dy = a[0] - b[0], a[1] - b[1]
        return (dx * dx + dy * dy) ** 0.5 < r if mode == "exact" else (
            b[0] - r <= a[0] <= b[0] + r and b[1] - r <= a[1] <= b[1] + r)

    expected = {(k, i) for i, a in enumerate(pts) for k, b in enumerate(pts) if near(a, b)}
    table = points(spark, pts)
    assert _pairs(join.distance_join(table, table, r, mode=mode, limits=PLANS[plan])) == expected


def test_radius_per_center_and_extra_key(spark):
    pts = points(spark, [(0, 0), (1, 0), (2, 0), (3, 0)]).withColumn("t", (F.col("id") % 2).cast("int"))
    centers = points(spark, [(0, 0), (3, 0)]).withColumn("r", F.col("id") + 1.5).withColumn("t", F.lit(0))
    found = join.distance_join(pts, centers, "r", on=["t"]).select("t", "window_id", "object_id")
    assert sorted(map(tuple, found.collect())) == [(0, 0, 0), (0, 1, 2)]


def test_missing_geometry_matches_nothing(spark):
    pts = spark.createDataFrame([(0, None, 1.0), (1, 1.0, 1.0)], "id BIGINT, x DOUBLE, y DOUBLE")
    wins = spark.createDataFrame(
        [(0, 0.0, 2.0, 0.0, 2.0), (1, None, 2.0, 0.0, 2.0)], "id BIGINT, xmin DOUBLE, xmax DOUBLE, ymin DOUBLE, ymax DOUBLE")
    assert _pairs(join.points_in_rectangles(pts, wins)) == {(0, 1)}


@pytest.mark.parametrize("plan", PLANS)
def test_empty_sides(spark, plan):
    none = points(spark, [(0, 0)]).where("id < 0")
    wins = boxes(spark, [(0, 1, 0, 1)])
    assert _pairs(join.points_in_rectangles(none, wins, limits=PLANS[plan])) == set()
    assert _pairs(join.points_in_rectangles(points(spark, [(0, 0)]), wins.where("id < 0"), limits=PLANS[plan])) == set()
    assert _pairs(join.rectangles_in_rectangles(wins.where("id < 0"), wins, mode="mbr", limits=PLANS[plan])) == set()


def test_counts_keep_empty_windows(spark):
    pts, wins = points(spark, [(0.5, 0.5), (0.6, 0.6), (5, 5)]), boxes(spark, [(0, 1, 0, 1), (8, 9, 8, 9), (0, 9, 0, 9)])
    pairs = join.points_in_rectangles(pts, wins)
    assert {r["window_id"]: r["n"] for r in join.count_per_window(pairs, wins).collect()} == {0: 2, 1: 0, 2: 3}
    groups = {r["window_id"]: (r["part"], r["objects"], r["n"]) for r in join.group_per_window(pairs, wins).collect()}
    assert groups == {0: (0, [0, 1], 2), 1: (0, [], 0), 2: (0, [0, 1, 2], 3)}


@pytest.mark.parametrize("plan", PLANS)
def test_equal_points_are_counted_once_joined(spark, plan):
    rng = random.Random(3)
    pts, wins = points(spark, _points(rng, 600)), boxes(spark, _boxes(rng, 50))
    expected = {tuple(r) for r in join.count_per_window(join.points_in_rectangles(pts, wins), wins).collect()}
    assert {tuple(r) for r in join.count_points_in_rectangles(pts, wins, limits=PLANS[plan]).collect()} == expected


@pytest.mark.parametrize("fan", [64, 3])
def test_counts_without_pairs(spark, monkeypatch, fan):
    """Equal coordinates, endless windows, keys that repeat or are missing; no join of points with windows."""
    monkeypatch.setattr(ranks, "FAN", fan)
    rng, inf = random.Random(9), float("inf")
    pts = points(spark, [*_points(rng, 300), (inf, 0), (float("nan"), 1), (-0.0, 0.0)]).withColumn("t", F.expr("IF(id % 7 = 0, NULL, id % 3)"))
    pts = pts.union(pts.where("id < 20")).union(spark.createDataFrame([(900, None, 1.0, 1)], pts.schema))
    wins = boxes(spark, [*_boxes(rng, 80), (-1e300, inf, -5, 5), (3, 2, 0, 9), (-5, 5, 0, 0)]).withColumn("t", F.expr("IF(id % 11 = 0, NULL, id % 2)"))
    wins = wins.union(wins.where("id < 9")).union(spark.createDataFrame([(901, None, 1.0, 0.0, 1.0, 1), (None, -9.0, 9.0, -9.0, 9.0, 1)], wins.schema))
    for on in ([], ["t"]):
        plain = join.count_per_window(join.points_in_rectangles(pts, wins, on=on), wins, on=on)
        hits = join.points_in_rectangles(pts, wins, on=on, counted=True, limits=Limits(counted_pairs=0))
        assert hits.columns == [*on, "window_id", "hit"] and "object_id" not in _physical(hits)
        swept = join.count_per_window(hits, wins, on=on)
        assert swept.dtypes == plain.dtypes
        assert sorted(map(str, swept.collect())) == sorted(map(str, plain.collect()))


def test_large_groups_come_in_parts(spark):
    pts, wins = points(spark, [(i / 1000, 0) for i in range(1000)]), boxes(spark, [(0, 1, 0, 1), (0, 0.0095, 0, 1)])
    rows = join.group_per_window(join.points_in_rectangles(pts, wins), wins, chunk=100).collect()
    big = [r for r in rows if r["window_id"] == 0]
    assert len(big) >= 9 and sorted(i for r in big for i in r["objects"]) == list(range(1000))
    assert [(r["part"], r["objects"]) for r in rows if r["window_id"] == 1] == [(0, list(range(10)))]

@pytest.mark.parametrize("rows", [4096, 7])
def test_grouped_points_are_those_of_the_pairs(spark, rows):
    """Arrays instead of rows for pairs: no pair is written or shuffled by itself."""
    rng = random.Random(6)
    pts, wins = points(spark, [*_points(rng, 300), (float("inf"), 0), (float("nan"), 1)]), boxes(spark, [*_boxes(rng, 80), (-1e300, float("inf"), -5, 5)])
    objects = join._side(pts, "id", "object_id", "o_", join._point_box("x", "y"), ())
    hits = cells.grouped_cell_join(objects, join._side(wins, "id", "window_id", "w_", join.g.box(), ()), pack_rows=rows)
    assert "SortMergeJoin [cell_tier" in _physical(hits)
    assert _pairs(hits.selectExpr("window_id", "explode(objects) AS object_id")) == _pairs(join.points_in_rectangles(pts, wins))
    hits = join.points_in_rectangles(pts, wins, grouped=True)
    assert hits.columns == ["window_id", "most", "objects"]
    whole, pieces = (join.group_per_window(hits, wins, chunk=c).collect() for c in (1000, 3))
    assert [(r["part"], r["n"]) for r in whole if r["n"]] == [(0, len(r["objects"])) for r in whole if r["n"]]
    got = {}
    for r in sorted(pieces, key=lambda r: r["part"]):
        assert r["n"] <= 3
        got.setdefault(r["window_id"], []).extend(r["objects"])
    assert got == {r["window_id"]: r["objects"] for r in whole}


def test_very_large_groups_are_dealt_before_they_are_gathered(spark, monkeypatch):
    monkeypatch.setattr(join, "_HELD", 50)
    pts, wins = points(spark, [(i / 1000, 0) for i in range(1000)]), boxes(spark, [(0, 1, 0, 1), (0, 0.0095, 0, 1), (5, 6, 5, 6)])
    for few in (64, 2):
        monkeypatch.setattr(join, "_FEW_GROUPS", few)
        rows = join.group_per_window(join.points_in_rectangles(pts, wins, grouped=True), wins, chunk=20).collect()
        assert len({(r["window_id"], r["part"]) for r in rows}) == len(rows) and max(r["n"] for r in rows) <= 20
        assert sorted(i for r in rows if r["window_id"] == 0 for i in r["objects"]) == list(range(1000))
        assert [(r["part"], r["objects"]) for r in rows if r["window_id"] > 0] in ([(0, list(range(10))), (0, [])], [(0, []), (0, list(range(10)))])


def test_crowded_cells_are_dealt_out(spark):
    """A third of all points in one cell ends up in many parts, none much larger than asked for."""
    pts = points(spark, [(1.5, 2.5)] * 3000 + [(i % 100 / 3, i // 100) for i in range(6000)])
    wins = boxes(spark, [(1, 2, 2, 3)] * 50 + [(i, i + 1, 0, 1) for i in range(30)])
    left = cells._corner_keys(join._side(pts, "id", "object_id", "o_", join._point_box("x", "y"), ()), [0], 1)
    right = cells._cover(join._side(wins, "id", "window_id", "w_", join.g.box(), ()).withColumn("w_tier", F.lit(0)), "w_", "w_tier", 1)
    key = ["cell_tier", "cell_x", "cell_y"]
    for limits, rows, pairs in ((Limits(part_rows=200), 400, None), (Limits(part_pairs=5000), None, 10_000)):
        deals = cells._split_crowded(left, 9000 * 200, right, right.count() * 200, key, limits)
        held = [{tuple(r)[:-1]: r["count"] for r in d.groupBy(*key, "left_part", "right_part").count().collect()} for d in deals]
        assert sum(held[0].values()) >= 9000
        if rows:
            assert max(held[0].values()) < rows
        if pairs:
            assert max(n * held[1].get(k, 0) for k, n in held[0].items()) < pairs


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_plan_is_the_one_decided_on(spark):
    pts, wins = points(spark, [(i % 50, i % 70) for i in range(500)]), boxes(spark, [(i, i + 1, 0, 30) for i in range(40)])
    assert "BroadcastHashJoin" in _physical(join.points_in_rectangles(pts, wins))
    small = "Exchange hashpartitioning"
    assert small not in _physical(join.points_in_rectangles(pts, wins))
    for name in ("shuffle", "split", "pairs"):
        plan = _physical(join.points_in_rectangles(pts, wins, limits=PLANS[name]))
        assert "SortMergeJoin [cell" in plan, name
        if name == "shuffle":  # Catalyst would broadcast tables of this size by itself
            assert "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("name", ["join_polys_polys_mbr", "join_rects_rects_intersects"])
def test_tables_of_one_small_file_are_joined_by_all_cores(spark, tmp_path, name):
    spark.range(1, 40).selectExpr("id AS s_suppkey").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(1, 200).selectExpr("id AS p_partkey", "CAST(1 + id % 50 AS INT) AS p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    plan = _physical(QUERIES[name](spark, str(tmp_path)))
    assert f"RoundRobinPartitioning({spark.sparkContext.defaultParallelism})" in plan


def test_shuffled_joins_keep_their_tasks(spark):
    """Few bytes can be many pairs, so small partitions aren't put together before the join."""
    pts, wins = points(spark, [(i % 50, i % 70) for i in range(500)]), boxes(spark, [(i, i + 1, 0, 30) for i in range(40)])
    found = join.points_in_rectangles(pts, wins, limits=PLANS["shuffle"])
    assert found.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_shuffled_joins_meet_packs_of_objects(spark):
    """Not row by row: a cell's objects come as arrays, and windows that cover the cell take these as they are."""
    pts, wins = points(spark, [(i % 50, i % 70) for i in range(500)]), boxes(spark, [(i, i + 1, 0, 30) for i in range(40)])
    found = [join.points_in_rectangles(pts, wins, limits=PLANS["shuffle"]), join.rectangles_in_rectangles(wins, wins, mode="mbr", limits=PLANS["shuffle"])]
    for plan in map(_physical, found):
        assert plan.index("Generate inline(packed_") < plan.index("SortMergeJoin [cell") < plan.index("collect_list")


def test_points_among_polygons_of_few_and_of_many_edges(spark):
    """Few edges of a cell are columns of its windows, more stay an array; points on edges count the same."""
    rng = random.Random(12)
    pts = points(spark, [(x / 2, y / 2) for x in range(40) for y in range(40)])
    for corners in (4, 20):
        wins = polygons(spark, {i: star(rng, rng.uniform(0, 20), rng.uniform(0, 20), rng.uniform(2, 9), corners) for i in range(20)})
        found = join.points_in_polygons(pts, wins, limits=PLANS["shuffle"])
        assert "w_edge3_x1" in _physical(found)
        test = F.expr(join.g.over_edges("rings", join.g.polygon_contains_point("edges_", "x", "y")))
        brute = pts.withColumnRenamed("id", "object_id").crossJoin(wins.withColumnRenamed("id", "window_id")).where(test)
        assert _pairs(found) == _pairs(brute)


def test_cells_inside_a_polygon_settle_objects(spark):
    """All but the objects near its boundary: their windows have no edges left to test."""
    inner, outer = polygons(spark, {i: square(i % 40, i // 40, 0.5) for i in range(1600)}), polygons(spark, {0: square(0.25, 0.25, 39)})
    found = join.polygons_in_polygons(inner, outer, limits=PLANS["shuffle"])
    assert "w_whole" in _physical(found)
    assert _pairs(found) == {(0, 40 * y + x) for x in range(1, 39) for y in range(1, 39)}
    assert join._reach(spark.sql("SELECT 0D AS xmin, double('inf') AS xmax, 0D AS ymin, 1D AS ymax"), join.g.box()) is None


def test_endless_and_far_windows(spark):
    inf = float("inf")
    wins = [(-inf, inf, -inf, inf), (5, inf, 0, 9), (4.5e6, 4.5e6, 4.5e6, 4.5e6), (-inf, 3, 1, 1), (1e15, 1e15 + 2, 0, 9)]
    pts = [(0, 0), (7, 1), (4.5e6, 4.5e6), (2, 1), (1e15 + 1, 5), (-1e300, 1), (inf, 2)]
    expected = {(w, p) for w, (a, b, c, d) in enumerate(wins) for p, (x, y) in enumerate(pts) if a <= x <= b and c <= y <= d}
    for limits in PLANS.values():
        assert _pairs(join.points_in_rectangles(points(spark, pts), boxes(spark, wins), limits=limits)) == expected
    objs = [(0, 1, 0, 1), (-inf, 0, 0, 2), (4.5e6, 4.5e6, 4.5e6, 4.5e6), (7, 8, 7, inf)]
    meets = {(w, o) for w, a in enumerate(wins) for o, b in enumerate(objs) if b[0] <= a[1] and a[0] <= b[1] and b[2] <= a[3] and a[2] <= b[3]}
    assert _pairs(join.rectangles_in_rectangles(boxes(spark, objs), boxes(spark, wins), mode="mbr")) == meets


def test_points_far_from_the_origin_have_cells_of_their_own(spark):
    wins = boxes(spark, [(5e6 + i, 5e6 + i, 0, 0) for i in range(100)])
    cells_ = cells._cover(join._side(wins, "id", "window_id", "w_", join.g.box(), ()).withColumn("w_tier", cells._tier(cells.box("w_"))), "w_", "w_tier", 1)
    assert cells_.select("cell_x").distinct().count() == 100


def test_distinct_geometry_keeps_the_smallest_id(spark):
    rows = spark.createDataFrame([(3, 1.0, 2.0), (1, 1.0, 2.0), (2, 5.0, 2.0)], "id long, x double, y double")
    assert sorted(map(tuple, join.distinct_geometry(rows, ["x", "y"]).collect())) == [(1, 1.0, 2.0), (2, 5.0, 2.0)]


def test_few_large_windows_share_the_grid_of_small_ones():
    tiers = {-2: (1000.0, 4000.0), 0: (900.0, 2000.0), 3: (2.0, 8.0)}
    assert cells._merged_tiers(tiers, 0) == ({-2: -2, 0: 0, 3: 3}, 6008.0)
    assert cells._merged_tiers(tiers, 50_000) == ({-2: -2, 0: 0, 3: 0}, 6000.0 + 8 * 16**3)
    assert cells._merged_tiers(tiers, 1e9)[0] == {-2: -2, 0: 0, 3: 0}  # two grids further a window would make a million cells
    assert cells._merged_tiers({-2: (9.0, 9.0), 0: (9.0, 9.0)}, 1e9)[0] == {-2: -2, 0: -2}
    assert cells._merged_tiers({}, 5) == ({}, 0)


@pytest.mark.parametrize("plan", PLANS)
def test_large_windows_among_many_objects(spark, plan):
    """Enough points for the large windows to move to the finer grid, in each plan."""
    rng = random.Random(8)
    pts = [(rng.uniform(0, 30), rng.uniform(0, 30)) for _ in range(3000)]
    wins = [(x, x + 1, 5, 6) for x in range(30)] + [(2, 7, 2, 7), (0.5, 20, 3, 12)]
    expected = {(w, p) for w, (a, b, c, d) in enumerate(wins) for p, (x, y) in enumerate(pts) if a <= x <= b and c <= y <= d}
    assert _pairs(join.points_in_rectangles(points(spark, pts), boxes(spark, wins), limits=PLANS[plan])) == expected


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        join.rectangles_in_rectangles(boxes(spark, []), boxes(spark, []), mode="fuzzy")
