import os
import random

import pytest
from pyspark.sql import functions as F
from shapes import boxes, points, polygons, square

from meshfold.functions import geometry as g
from meshfold.operators import aggregate, knn, layout, partition, range_query

METHODS = partition.METHODS


# Sample sizes by partitions and rows.
@pytest.mark.parametrize("n, rows, size", [
    (2, 10, 0), (2, 100, 0), (2, 1010, 10), (2, 1110, 11), (5, 1000, 10), (5, 10000, 100), (5, 10001, 100),
    (5, 100011, 1000), (6, 100011, 1000), (10, 10, -1), (11, 10, -1),
])
def test_sample_size(n, rows, size):
    assert partition.sample_size(n, rows) == size


@pytest.fixture(scope="module")
def spread_points(spark):
    return spark.range(6000).selectExpr(
        "id", "((id * 7919) % 36000) / 1e2 - 180 AS x", "((id * 10473) % 18000) / 1e2 - 90 AS y").cache()


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("n", [2, 10, 11])
def test_every_row_gets_one_partition(spark, spread_points, method, n):
    plan = partition.plan_partitions(spread_points, method, n)
    placed = plan.assign(spread_points)
    counts = {r["pid"]: r["count"] for r in placed.groupBy("pid").count().collect()}
    assert sum(counts.values()) == 6000 and set(counts) <= set(range(len(plan.leaves) if method == "quadtree" else n))
    assert placed.select("id").distinct().count() == 6000
    if method in ("hilbert", "rtree"):
        assert len(counts) == n and max(counts.values()) < 1.3 * 6000 / n
    if method == "equalgrid":
        assert len(counts) == int(n**0.5) ** 2
    if method == "quadtree":  # squares are split in four until none has more than an n-th, so there may be more than n
        assert len(counts) >= n and max(counts.values()) <= 6000 / n


@pytest.mark.parametrize("method", METHODS)
def test_crowded_place(spark, method):
    """A third of the rows in one place: still every row once, and equal places together."""
    table = points(spark, [(5, 5)] * 1000 + [(i % 50, i // 50) for i in range(2000)])
    placed = partition.assign_partitions(table, method, 8)
    assert placed.count() == 3000
    assert placed.where("x = 5 AND y = 5").select("pid").distinct().count() == 1


def test_voronoi_takes_the_nearest_site(spark, spread_points):
    plan = partition.plan_partitions(spread_points, "voronoi", 20)
    for r in plan.assign(spread_points.where("id % 7 = 0")).collect():
        d = [(sx - r["x"]) ** 2 + (sy - r["y"]) ** 2 for sx, sy in plan.cuts]
        assert d[r["pid"]] == min(d)


def test_hilbert_curve_visits_neighbours(spark):
    """Along the curve each cell is next to the one before; positions are a permutation."""
    side, bounds = 1 << partition.HILBERT_BITS, (0.0, float(1 << 15), 0.0, float(1 << 15))
    corner = spark.range(64 * 64).selectExpr("id % 64 + 0.5 AS x", "id DIV 64 + 0.5 AS y")
    rows = sorted((r["h"], r["x"], r["y"]) for r in corner.select(
        "x", "y", partition.hilbert_key(F.col("x"), F.col("y"), bounds).alias("h")).collect())
    assert [r[0] for r in rows] == list(range(64 * 64)) and side == 32768
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(rows, rows[1:]))


def test_cuts_apply_to_another_table(spark, spread_points):
    plan = partition.plan_partitions(spread_points, "rtree", 10)
    outside = boxes(spark, [(-500, -400, 0, 1), (500, 501, 300, 301), (0, 1, 0, 1)])
    assert {r["pid"] for r in plan.assign(outside).collect()} <= set(range(10))


def test_refusals(spark, spread_points):
    with pytest.raises(ValueError):
        partition.assign_partitions(spread_points, "kdtree", 4)  # no such method
    with pytest.raises(ValueError):
        partition.assign_partitions(spread_points, "rtree", 1_000_000)
    assert partition.assign_partitions(spread_points, "rtree", 61).select("pid").distinct().count() == 61
    assert partition.assign_partitions(spread_points, "rtree", 61, collapse=True).select("pid").distinct().count() == 1  # 1 % is too few


@pytest.mark.parametrize("method", METHODS)
def test_missing_coordinates_have_no_partition(spark, method):
    rows = [(i, float(i % 20), float(i // 20)) for i in range(400)] + [(400, None, 1.0), (401, 2.0, None)]
    table = spark.createDataFrame(rows, "id long, x double, y double")
    placed = partition.assign_partitions(table, method, 4)
    assert {r["id"] for r in placed.where("pid IS NULL").collect()} == {400, 401}
    assert placed.where("pid IS NOT NULL").count() == 400


def test_searches_pass_over_missing_geometry(spark, tmp_path):
    rows = [(i, float(i % 20), float(i // 20)) for i in range(400)] + [(400, None, 1.0), (-1, None, None)]
    table = spark.createDataFrame(rows, "id long, x double, y double")
    assert [r["id"] for r in knn.knn_points(table, (0, 0), 1).collect()] == [0]
    stored = layout.write_clustered(table, str(tmp_path / "points"), "rtree", 4)
    for k in (1, 30, 400, 500):
        assert sorted(r["id"] for r in stored.knn_points((3, 3), k).collect()) == sorted(r["id"] for r in knn.knn_points(table, (3, 3), k).collect())
    shapes = polygons(spark, {i: square(i, 0, 0.5) for i in range(20)}).withColumn("rings", F.expr("CASE WHEN id > 4 THEN rings END"))
    assert [r["id"] for r in knn.knn_polygons(shapes, (0, 0), 3).orderBy("id").collect()] == [5, 6, 7]
    assert knn.knn_polygons(shapes, (0, 0), 30).count() == 15


def test_shares(spark):
    table = spark.range(10).withColumn("pid", (F.col("id") < 4).cast("int"))
    assert {r["pid"]: (r["n"], r["share"]) for r in aggregate.partition_shares(table).collect()} == {0: (6, 0.6), 1: (4, 0.4)}


def test_windows_on_partitions(spark, spread_points):
    placed = partition.assign_partitions(spread_points, "rtree", 10)
    bounds = partition.partition_bounds(placed)
    wins = boxes(spark, [(-10, 10, -10, 10), (-180, 180, -90, 90), (900, 901, 0, 1)])
    found = {(r["id"], r["pid"]) for r in partition.windows_on_partitions(wins, bounds).collect()}
    expected = {(w["id"], b["pid"]) for w in wins.collect() for b in bounds.collect()
                if w["xmin"] <= b["xmax"] and w["xmax"] >= b["xmin"] and w["ymin"] <= b["ymax"] and w["ymax"] >= b["ymin"]}
    assert found == expected and len({p for w, p in found if w == 1}) == 10


@pytest.mark.parametrize("method", METHODS)
def test_layout_changes_no_result(spark, spread_points, method, tmp_path):
    stored = layout.write_clustered(spread_points, str(tmp_path / "points"), method, 12)
    window, rng = (-90.01, -40.01, 10.01, 40.01), random.Random(1)
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert stored.data.count() == 6000
    assert ids(stored.range_points(window)) == ids(range_query.range_points(spread_points, window))
    assert stored.in_window(window).count() < 6000
    for k in (1, 30, 700, 7000):
        at = (rng.uniform(-200, 200), rng.uniform(-100, 100))
        assert ids(stored.knn_points(at, k)) == ids(knn.knn_points(spread_points, at, k))
    assert ids(stored.range_points((500, 501, 0, 1))) == []


def test_layout_prunes_folders(spark, spread_points, tmp_path):
    stored = layout.write_clustered(spread_points, str(tmp_path / "points"), "hilbert", 12)
    plan = stored.in_window((0, 1, 0, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pid" in plan
    near = boxes(spark, [(0, 1, 0, 1), (170, 171, 80, 81)])
    assert 0 < stored.meeting(near).count() < 3000


def test_layout_of_shapes(spark, tmp_path):
    table = polygons(spark, {i: square(i % 40, i // 40, 0.5) for i in range(800)})
    stored = layout.write_clustered(table, str(tmp_path / "polygons"), "rtree", 6)
    window = (3.25, 8.25, 3.25, 8.25)
    ids = lambda df: {r["id"] for r in df.collect()}
    for condition in ("contains", "intersects"):
        assert ids(stored.range_polygons(window, condition, "exact")) == ids(range_query.range_polygons(table, window, condition))
    assert ids(stored.range_polygons(window)) == ids(range_query.range_polygons(table, window, mode="mbr"))
    assert ids(stored.knn_polygons((4.1, 4.1), 9)) == ids(knn.knn_polygons(table, (4.1, 4.1), 9))
    rects = aggregate.bounding_boxes(table)
    stored = layout.write_clustered(rects, str(tmp_path / "boxes"), "voronoi", 6)
    assert ids(stored.range_rectangles(window)) == ids(range_query.range_rectangles(rects, window, "intersects"))
    assert ids(stored.knn_rectangles((4.1, 4.1), 9)) == ids(knn.knn_rectangles(rects, (4.1, 4.1), 9))


def test_boundaries(spark):
    assert list(aggregate.boundary(points(spark, [(1, 2), (3, -4)])).first()) == [1, 3, -4, 2]
    assert list(aggregate.boundary(boxes(spark, [(0, 5, 1, 2), (-1, 0, 0, 9)])).first()) == [-1, 5, 0, 9]
    assert list(aggregate.boundary(polygons(spark, {0: square(1, 1, 2), 1: square(5, 0, 1)})).first()) == [1, 6, 0, 3]
    circles = aggregate.circles_from_points(points(spark, [(0, 0), (10, 0)]), 2)
    assert list(aggregate.boundary(circles).first()) == [-2, 12, -2, 2]
    assert [(r["x"], r["y"]) for r in aggregate.circle_centers(circles).orderBy("id").collect()] == [(0, 0), (10, 0)]
    with pytest.raises(ValueError):
        aggregate.boundary(spark.range(3))
    assert set(g.BOX) <= set(aggregate.bounding_boxes(circles).columns)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("method", ["hilbert", "rtree", "voronoi"])
def test_the_registered_checks_can_fail(spark, monkeypatch, method):
    """A constant and a random assignment both change the checked row."""
    from meshfold.plans.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    good = QUERIES[f"partition_{method}_check"](spark, folder).first()
    for pid in (F.lit(0), F.pmod(F.xxhash64("id"), F.lit(16)).cast("int")):
        monkeypatch.setattr(partition.Partitioning, "assign", lambda self, df, pid=pid: df.withColumn("pid", pid))
        bad = QUERIES[f"partition_{method}_check"](spark, folder).first()
        assert bad["total"] == good["total"] and bad != good


def test_neighbours_in_a_layout_read_the_partitions_within_one_radius(spark, spread_points, tmp_path):
    stored = layout.write_clustered(spread_points, str(tmp_path / "points"), "rtree", 40)
    found = stored.knn_points((10.5, 10.5), 5)
    assert [r["id"] for r in found.collect()] == [r["id"] for r in knn.knn_points(spread_points, (10.5, 10.5), 5).collect()]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    with pytest.raises(ValueError):
        stored.knn_points((10.5, 10.5), 0)


@pytest.mark.parametrize("method", ["hilbert", "rtree", "quadtree"])
def test_cuts_in_a_table_give_the_same_partitions(spark, spread_points, method, monkeypatch):
    plan = partition.plan_partitions(spread_points, method, 60)
    expected = {r["id"]: r["pid"] for r in plan.assign(spread_points).collect()}
    for literals, broadcast in ((7, 1 << 20), (3, 0)):
        monkeypatch.setattr(partition, "_MAX_LITERALS", literals)
        monkeypatch.setattr(partition, "_MAX_BROADCAST", broadcast)
        assert {r["id"]: r["pid"] for r in plan.assign(spread_points).collect()} == expected


def test_even_cuts_are_exact(spark):
    rng = random.Random(9)
    keys = sorted(rng.choice([rng.randrange(1 << 30), 7, rng.randrange(100)]) for _ in range(3000))
    table = spark.createDataFrame([(k,) for k in keys], "key long").repartition(3)
    # A cut lies behind the key with which the rows so far reach the share.
    assert partition._even_cuts(table, 50) == tuple(keys[-(-3000 * i // 50) - 1] + 1 for i in range(1, 50))


@pytest.mark.parametrize("method", ["hilbert", "rtree"])
def test_a_hundred_thousand_partitions(spark, method):
    table = spark.range(400_000).selectExpr("id", "((id * 7919) % 400009) / 1e2 AS x", "((id * 10473) % 400009) / 1e2 AS y")
    counts = partition.assign_partitions(table, method, 100_000).groupBy("pid").count()
    n, most, rows = counts.agg(F.count("*"), F.max("count"), F.sum("count")).first()
    assert rows == 400_000 and n > 90_000 and most < 40


def test_null_checks_do_not_repeat_the_search(spark):
    """A filter or join on the id leaves the search for it as it is, a step for each halving."""
    points = spark.range(2000).selectExpr("id", "CAST(id * 7919 % 1000 AS DOUBLE) AS x", "CAST(id * 10473 % 997 AS DOUBLE) AS y")
    placed = partition.assign_partitions(points, "rtree", 64)
    plans = [len(df._jdf.queryExecution().optimizedPlan().toString()) for df in (placed, placed.where("pid IS NOT NULL"))]
    assert plans[1] < 1.5 * plans[0]
    assert placed.where("pid IS NOT NULL").count() == 2000
