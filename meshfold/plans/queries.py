"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.operators import aggregate, hotspot, join, knn, layout, paired, partition, polygon_range, range_query, union, voronoi
from meshfold.plans import oracle
from meshfold.session import new_folder, spread
from meshfold.sources import readers, tables, writers

Query = Callable[[SparkSession, str], DataFrame]

# Query parameters (fixed values), shared with the SQL side.
W1, W2 = oracle.W1, oracle.W2
CENTER, K_RECTS, RADIUS, N_PARTITIONS = oracle.CENTER, oracle.K_RECTS, oracle.RADIUS, oracle.N_PARTITIONS

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _new_folder(spark: SparkSession) -> str:
    return new_folder(spark, "query")


# ---------------------------------------------------------------- range

@query
def range_pts_contains(spark, sf):
    return range_query.range_points(tables.spread_points(spark, sf), W1)


@query
def range_rects_contains(spark, sf):
    return range_query.range_rectangles(tables.rectangles(spark, sf), W2)


@query
def range_rects_intersects(spark, sf):
    return range_query.range_rectangles(tables.rectangles(spark, sf), W2, "intersects")


@query
def range_polys_contains(spark, sf):
    return range_query.range_polygons(tables.polygons(spark, sf), W2).select("id")


@query
def range_polys_intersects(spark, sf):
    return range_query.range_polygons(tables.polygons(spark, sf), W2, "intersects").select("id")


@query
def range_polys_mbr(spark, sf):
    return range_query.range_polygons(tables.polygons(spark, sf), W2, mode="mbr").select("id")


@query
def range_small_polys_contains(spark, sf):
    return range_query.range_polygons(tables.small_polygons(spark, sf), W2).select("id")


@query
def range_small_polys_intersects(spark, sf):
    return range_query.range_polygons(tables.small_polygons(spark, sf), W2, "intersects").select("id")


@query
def range_pts_indexed(spark, sf):
    stored = layout.write_clustered(tables.spread_points(spark, sf), _new_folder(spark), "hilbert", N_PARTITIONS)
    return stored.range_points(W1)


@query
def range_rects_indexed(spark, sf):
    stored = layout.write_clustered(tables.rectangles(spark, sf), _new_folder(spark), "rtree", N_PARTITIONS)
    return stored.range_rectangles(W2)


@query
def range_polys_indexed(spark, sf):
    stored = layout.write_clustered(tables.small_polygons(spark, sf), _new_folder(spark), "voronoi", N_PARTITIONS)
    return stored.range_polygons(W2).select("id")


@query
def range_pts_in_polygon(spark, sf):
    return polygon_range.range_by_polygon(tables.spread_points(spark, sf), oracle.QUERY_RINGS)


@query
def range_pts_in_polygon_indexed(spark, sf):
    stored = layout.write_clustered(tables.spread_points(spark, sf), _new_folder(spark), "quadtree", N_PARTITIONS)
    return stored.range_by_polygon(oracle.QUERY_RINGS)


@query
def range_rects_in_polygon(spark, sf):
    return polygon_range.range_by_polygon(tables.rectangles(spark, sf), oracle.QUERY_RINGS)


@query
def range_rects_meet_polygon(spark, sf):
    return polygon_range.range_by_polygon(tables.rectangles(spark, sf), oracle.QUERY_RINGS, "intersects")


@query
def range_polys_in_polygon(spark, sf):
    return polygon_range.range_by_polygon(tables.small_polygons(spark, sf), oracle.QUERY_RINGS).select("id")


@query
def range_polys_meet_polygon(spark, sf):
    return polygon_range.range_by_polygon(tables.polygons(spark, sf), oracle.QUERY_RINGS, "intersects").select("id")


# ---------------------------------------------------------------- nearest neighbours

def _ranked(found: DataFrame) -> DataFrame:
    return knn.ranked(found).withColumn("distance", F.round("distance", 6))


@query
def knn_pts(spark, sf):
    return _ranked(knn.knn_points(tables.spread_points(spark, sf), CENTER, 5))


@query
def knn_rects(spark, sf):
    return _ranked(knn.knn_rectangles(tables.rectangles(spark, sf), CENTER, K_RECTS))


@query
def knn_polys(spark, sf):
    return _ranked(knn.knn_polygons(spread(tables.polygons(spark, sf)), CENTER, 5))


@query
def knn_pts_some_null(spark, sf):
    """Among points a third of which have no x."""
    return _ranked(knn.knn_points(tables.spread_points(spark, sf).withColumn("x", F.expr("CASE WHEN id % 3 <> 0 THEN x END")), CENTER, 5))


@query
def knn_polys_some_null(spark, sf):
    """Among polygons a third of which have no rings."""
    return _ranked(knn.knn_polygons(tables.polygons(spark, sf).withColumn("rings", F.expr("CASE WHEN id % 3 <> 0 THEN rings END")), CENTER, 5))


@query
def knn_pts_pruned(spark, sf):
    stored = layout.write_clustered(tables.spread_points(spark, sf), _new_folder(spark), "rtree", N_PARTITIONS)
    return _ranked(stored.knn_points(CENTER, 5))


@query
def knn_rects_pruned(spark, sf):
    stored = layout.write_clustered(tables.rectangles(spark, sf), _new_folder(spark), "hilbert", N_PARTITIONS)
    return _ranked(stored.knn_rectangles(CENTER, K_RECTS))


@query
def knn_polys_pruned(spark, sf):
    stored = layout.write_clustered(tables.small_polygons(spark, sf), _new_folder(spark), "rtree", N_PARTITIONS)
    return _ranked(stored.knn_polygons(CENTER, 5))


# ---------------------------------------------------------------- spatial join

@query
def join_pts_rects_pairs(spark, sf):
    return join.points_in_rectangles(tables.spread_points(spark, sf), tables.rectangles(spark, sf))


@query
def join_pts_rects_count(spark, sf):
    rects = tables.rectangles(spark, sf)
    return join.count_per_window(join.points_in_rectangles(tables.spread_points(spark, sf), rects, counted=True), rects)


@query
def join_equal_pts_rects_count(spark, sf):
    return join.count_points_in_rectangles(tables.clustered_points(spark, sf), tables.rectangles(spark, sf))


@query
def join_pts_rects_groups(spark, sf):
    rects = tables.rectangles(spark, sf)
    groups = join.group_per_window(join.points_in_rectangles(tables.spread_points(spark, sf), rects, grouped=True), rects)
    return groups.select("window_id", "part", "n", F.array_join("objects", ",").alias("objects"))


@query
def join_pts_rects_small_groups(spark, sf):
    """The groups in parts of about three ids, put together again."""
    rects = tables.rectangles(spark, sf)
    groups = join.group_per_window(join.points_in_rectangles(tables.spread_points(spark, sf), rects, grouped=True), rects, chunk=3)
    whole = groups.groupBy("window_id").agg(F.sum("n").alias("n"), F.array_sort(F.flatten(F.collect_list("objects"))).alias("objects"))
    return whole.select("window_id", "n", F.array_join("objects", ",").alias("objects"))


@query
def join_pts_rects_indexed(spark, sf):
    rects = tables.rectangles(spark, sf)
    stored = layout.write_clustered(tables.spread_points(spark, sf), _new_folder(spark), "rtree", N_PARTITIONS)
    return join.points_in_rectangles(stored.meeting(rects), rects)


@query
def join_rects_rects_contains(spark, sf):
    rects = tables.rectangles(spark, sf)
    return join.rectangles_in_rectangles(rects, rects)


@query
def join_rects_rects_intersects(spark, sf):
    rects = spread(tables.rectangles(spark, sf))
    return join.rectangles_in_rectangles(rects, rects, mode="mbr")


@query
def join_pts_polys(spark, sf):
    return join.points_in_polygons(spread(tables.spread_points(spark, sf)), spread(tables.polygons(spark, sf)))


@query
def join_pts_polys_mbr(spark, sf):
    return join.points_in_polygons(tables.spread_points(spark, sf), tables.polygons(spark, sf), mode="mbr")


@query
def join_polys_polys_contains(spark, sf):
    return join.polygons_in_polygons(spread(tables.small_polygons(spark, sf)), spread(tables.polygons(spark, sf)))


@query
def join_polys_polys_mbr(spark, sf):
    return join.polygons_in_polygons(spread(tables.small_polygons(spark, sf)), spread(tables.polygons(spark, sf)), mode="mbr")


def _paired(spark: SparkSession, objects: DataFrame, windows: DataFrame, mode: str) -> DataFrame:
    """The join of both tables, stored on a grid found on the objects."""
    grid = paired.plan_grid(objects, N_PARTITIONS)
    left, right = paired.write_objects(objects, grid, _new_folder(spark)), paired.write_windows(windows, grid, _new_folder(spark))
    return paired.join_stored(left, right, mode)


@query
def join_pts_rects_stored(spark, sf):
    return _paired(spark, tables.spread_points(spark, sf), tables.rectangles(spark, sf), "exact")


@query
def join_equal_pts_rects_stored(spark, sf):
    """Points many of which are equal."""
    return _paired(spark, tables.clustered_points(spark, sf), tables.rectangles(spark, sf), "exact")


@query
def join_rects_rects_stored_contains(spark, sf):
    rects = tables.rectangles(spark, sf)
    return _paired(spark, rects, rects, "exact")


@query
def join_rects_rects_stored_intersects(spark, sf):
    rects = tables.rectangles(spark, sf)
    return _paired(spark, rects, rects, "mbr")


@query
def join_pts_polys_stored(spark, sf):
    return _paired(spark, tables.spread_points(spark, sf), tables.polygons(spark, sf), "exact")


@query
def join_polys_polys_stored_contains(spark, sf):
    return _paired(spark, tables.small_polygons(spark, sf), tables.polygons(spark, sf), "exact")


@query
def join_polys_polys_stored_mbr(spark, sf):
    return _paired(spark, tables.small_polygons(spark, sf), tables.polygons(spark, sf), "mbr")


@query
def join_distinct_geometry_count(spark, sf):
    """Results keyed by value: equal points count once."""
    rects = tables.rectangles(spark, sf)
    points = join.distinct_geometry(tables.clustered_points(spark, sf), ["x", "y"])
    return join.count_per_window(join.points_in_rectangles(points, rects), rects)


@query
def distance_join_exact(spark, sf):
    points = tables.clustered_points(spark, sf)
    return join.distance_join(points, points, RADIUS)


@query
def distance_join_mbr(spark, sf):
    points = tables.clustered_points(spark, sf)
    return join.distance_join(points, points, RADIUS, mode="mbr")


@query
def distance_join_count(spark, sf):
    points = tables.spread_points(spark, sf)
    centers = tables.clustered_points(spark, sf)
    return join.count_per_window(join.distance_join(points, centers, 1.0), centers)


@query
def distance_join_mbr_count(spark, sf):
    points = tables.spread_points(spark, sf)
    centers = tables.clustered_points(spark, sf)
    return join.count_per_window(join.distance_join(points, centers, 1.0, mode="mbr"), centers)


@query
def distance_join_circles(spark, sf):
    """Each circle has its own radius."""
    circles = tables.circles(spark, sf).selectExpr("id", "cx AS x", "cy AS y", "radius")
    return join.distance_join(tables.spread_points(spark, sf), circles, "radius")


# ---------------------------------------------------------------- aggregates and projections

@query
def boundary_pts(spark, sf):
    return aggregate.boundary(tables.spread_points(spark, sf))


@query
def boundary_rects(spark, sf):
    return aggregate.boundary(tables.rectangles(spark, sf))


@query
def boundary_polys(spark, sf):
    return aggregate.boundary(tables.polygons(spark, sf))


@query
def boundary_circles(spark, sf):
    return aggregate.boundary(tables.circles(spark, sf))


@query
def circles_from_pts(spark, sf):
    return aggregate.circles_from_points(tables.spread_points(spark, sf), RADIUS)


@query
def circles_mbr(spark, sf):
    return aggregate.bounding_boxes(tables.circles(spark, sf))


@query
def circle_centers(spark, sf):
    return aggregate.circle_centers(tables.circles(spark, sf))


@query
def mbr_to_circle(spark, sf):
    return aggregate.circles_from_boxes(tables.rectangles(spark, sf))


@query
def polys_mbr(spark, sf):
    return aggregate.bounding_boxes(tables.polygons(spark, sf))


@query
def circle_rect_intersects(spark, sf):
    circles = tables.circles(spark, sf)
    meets = g.circle_intersects_box(F.col("cx"), F.col("cy"), F.col("radius"), g.window_box(oracle.W3))
    return circles.where(meets).select("id")


@query
def circle_point_predicates(spark, sf):
    """Circles that contain, and that meet, the query point; the two differ only on the circle itself."""
    x, y = (F.lit(v) for v in oracle.P3)
    of = (F.col("cx"), F.col("cy"), F.col("radius"), x, y)
    return tables.circles(spark, sf).select(
        "id", g.circle_contains_point(*of).alias("contains"), g.circle_intersects_point(*of).alias("intersects")
    )


@query
def record_counts(spark, sf):
    return aggregate.record_count(tables.spread_points(spark, sf))


@query
def distinct_geometries(spark, sf):
    return aggregate.distinct_geometries(tables.clustered_points(spark, sf), ["x", "y"])


# ---------------------------------------------------------------- partitioning

@query
def partition_equalgrid(spark, sf):
    shares = aggregate.partition_shares(partition.assign_partitions(tables.spread_points(spark, sf), "equalgrid", 9))
    return shares.withColumn("share", F.round("share", 6))


def _shares(placed: DataFrame) -> DataFrame:
    """One row: (lost, uneven, total): rows without a partition of 0 .. N_PARTITIONS - 1, partitions whose share is over 10 % off, all rows."""
    counts = placed.groupBy("pid").agg(F.count("*").alias("n"))
    known = F.col("pid").between(0, N_PARTITIONS - 1)
    even = F.abs(F.col("n") / F.sum("n").over(Window.partitionBy()) * N_PARTITIONS - 1) <= 0.1  # at most N_PARTITIONS + 1 rows
    marked = counts.select("n", F.coalesce(known, F.lit(False)).alias("known"), even.alias("even"))
    return marked.agg(
        F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).cast("bigint").alias("lost"),
        (F.lit(N_PARTITIONS).cast("bigint") - F.count(F.when(F.col("known") & F.col("even"), 1))).alias("uneven"),
        F.sum("n").alias("total"),
    )


@query
def partition_hilbert_check(spark, sf):
    """(lost, uneven, total, disorder, key_sum): also partitions whose curve keys overlap the next one's, and the sum of all keys."""
    points = tables.spread_points(spark, sf)
    plan = partition.plan_partitions(points, "hilbert", N_PARTITIONS)
    placed = plan.assign(points).withColumn("key", partition.hilbert_key(F.col("x"), F.col("y"), plan.bounds))
    ranges = placed.groupBy("pid").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("key").alias("keys"))
    after = F.lead("low").over(Window.orderBy("pid"))  # at most N_PARTITIONS + 1 rows
    order = ranges.select("keys", (F.col("high") >= after).alias("bad")).agg(
        F.count(F.when(F.col("bad"), 1)).alias("disorder"), F.sum("keys").alias("key_sum"))
    return _shares(placed).crossJoin(order)  # one row each


@query
def partition_rtree_check(spark, sf):
    """(lost, uneven, total, overlaps): also pairs of partitions whose members' bounds overlap by more than a line."""
    points = tables.spread_points(spark, sf)
    placed = partition.assign_partitions(points, "rtree", N_PARTITIONS)
    a, b = (partition.partition_bounds(placed).select("pid", *g.BOX).alias(n) for n in "ab")
    meet = F.expr("a.pid < b.pid AND a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax")
    return _shares(placed).crossJoin(a.join(b, meet).agg(F.count("*").alias("overlaps")))  # N_PARTITIONS rows with themselves


@query
def partition_voronoi_check(spark, sf):
    """(wrong, empty, total): rows for which another site is nearer, sites without rows, all rows."""
    points = tables.spread_points(spark, sf)
    plan = partition.plan_partitions(points, "voronoi", N_PARTITIONS)
    squares = [(F.col("x") - x) * (F.col("x") - x) + (F.col("y") - y) * (F.col("y") - y) for x, y in plan.cuts]
    own = F.get(F.array(*squares), F.col("pid"))
    counts = plan.assign(points).groupBy("pid").agg(F.count("*").alias("n"), F.count(F.when(own <= F.least(*squares), 1)).alias("right"))
    return counts.agg(
        F.sum(F.col("n") - F.col("right")).alias("wrong"),
        (F.lit(len(plan.cuts)).cast("bigint") - F.count(F.when(F.col("right") > 0, 1))).alias("empty"), F.sum("n").alias("total"))


@query
def voronoi_bounds(spark, sf):
    """(id, xmin, xmax, ymin, ymax): the box of each site's cell, cut off at the bounds of all sites, which are the polygons' centres."""
    sites = tables.table(spark, sf, "supplier").selectExpr("s_suppkey AS id", f"{tables.POLY_X} AS x", f"{tables.POLY_Y} AS y")
    bounds = sites.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    cells = voronoi.voronoi_cells(sites, tuple(bounds))
    return cells.select(F.col("site").alias("id"), *((F.round(c, 5) + F.lit(0.0)).alias(c) for c in g.BOX))


@query
def partition_quadtree_check(spark, sf):
    """(lost, oversized, overlaps, total) of clustered points: squares with more than their share though they could be split, pairs of squares whose members'
    bounds overlap by more than a line."""
    points = tables.clustered_points(spark, sf)
    plan = partition.plan_partitions(points, "quadtree", N_PARTITIONS)
    placed = plan.assign(points)
    counts = placed.groupBy("pid").agg(F.count("*").alias("n"))
    known = F.coalesce(F.col("pid").between(0, plan.n - 1), F.lit(False))
    crowds = [i for i, leaf in enumerate(plan.leaves) if leaf.crowd]
    large = known & (F.col("n") > -(-plan.rows // N_PARTITIONS)) & ~F.col("pid").isin(crowds)
    checked = counts.agg(
        F.sum(F.when(known, 0).otherwise(F.col("n"))).cast("bigint").alias("lost"), F.count(F.when(large, 1)).alias("oversized"), F.sum("n").alias("total"))
    a, b = (partition.partition_bounds(placed).select("pid", *g.BOX).alias(n) for n in "ab")
    meet = F.expr("a.pid < b.pid AND a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax")
    return checked.crossJoin(a.join(b, meet).agg(F.count("*").alias("overlaps")))  # some rows for each of N_PARTITIONS with themselves


@query
def partition_by_other_table(spark, sf):
    """(pid, n): rectangles on the grid found on the points."""
    plan = partition.plan_partitions(tables.spread_points(spark, sf), "equalgrid", 9)
    return plan.assign(tables.rectangles(spark, sf)).groupBy("pid").agg(F.count("*").alias("n"))


@query
def partition_windows_check(spark, sf):
    """(window_id, n): points per rectangle, found only among the partitions the rectangle was assigned to."""
    rects = tables.rectangles(spark, sf)
    placed = partition.assign_partitions(tables.spread_points(spark, sf), "rtree", N_PARTITIONS)
    windows = partition.windows_on_partitions(rects, partition.partition_bounds(placed)).join(rects, "id")
    return join.count_per_window(join.points_in_rectangles(placed, windows, on=["pid"], counted=True).drop("pid"), rects)


# ---------------------------------------------------------------- hot spots

@query
def hotspot_counts(spark, sf):
    return hotspot.cell_counts(tables.step_cells(spark, sf))


def _scores(spark: SparkSession, sf: str, **options) -> DataFrame:
    return hotspot.gi_star(hotspot.cell_counts(tables.step_cells(spark, sf)), **options).withColumn("z", F.round("z", 6))


@query
def hotspot_gistar_top50(spark, sf):
    return hotspot.hottest(_scores(spark, sf))


@query
def hotspot_gistar_all(spark, sf):
    return _scores(spark, sf, dense=True)


@query
def hotspot_gistar_local(spark, sf):
    return hotspot.hottest(_scores(spark, sf, stats="local"))


@query
def hotspot_gistar_int_division(spark, sf):
    return hotspot.hottest(_scores(spark, sf, int_division=True), None)


@query
def hotspot_join_counts(spark, sf):
    """Counting by spatial join: events in the closed unit squares of their day, all days in one job."""
    events = tables.step_cells(spark, sf).selectExpr("id", "t", "CAST(cx AS DOUBLE) AS x", "CAST(cy AS DOUBLE) AS y")
    squares = hotspot.unit_squares(spark)
    pairs = join.points_in_rectangles(events, squares, on=["t"])
    counts = join.count_per_window(pairs, squares, on=["t"])
    return counts.select("t", F.col("window_id").alias("square"), "n")


def _trip_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The events as trip records: id, pickup time, filler, longitude, latitude."""
    return tables.table(spark, sf, "events").selectExpr(
        "concat_ws(',', event_id, date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '1', '1', '0.5', "
        f"{oracle.TRIP_LON}, {oracle.TRIP_LAT}) AS line"
    )


def _trip_counts(spark: SparkSession, sf: str, binning: str) -> DataFrame:
    folder = _new_folder(spark)
    _trip_lines(spark, sf).write.text(folder)
    trips = hotspot.trips_in_box(readers.load_trips(spark, folder))
    return hotspot.cell_counts(hotspot.trip_cells(trips, binning=binning))


@query
def hotspot_trips_floor(spark, sf):
    return _trip_counts(spark, sf, "floor")


@query
def hotspot_trips_truncate(spark, sf):
    return _trip_counts(spark, sf, "truncate")


@query
def hotspot_trips_round(spark, sf):
    return _trip_counts(spark, sf, "round")


# ---------------------------------------------------------------- sources and sinks

def _reload(lines: DataFrame, load, fmt: str, **options) -> DataFrame:
    """Writes the single text column of ``lines`` and loads it again."""
    folder = _new_folder(lines.sparkSession)
    lines.write.text(folder)
    return load(lines.sparkSession, folder, fmt, **options)


@query
def load_points_roundtrip(spark, sf):
    lines = tables.spread_points(spark, sf).select(F.concat_ws(",", F.lit("p"), "id", "x", "y", F.lit("rest")))
    return _reload(lines, readers.load_points, "csv", offset=2, id_column=1).select("id", "x", "y", "user_data")


@query
def load_points_tsv_roundtrip(spark, sf):
    lines = tables.clustered_points(spark, sf).select(F.concat_ws("\t", "x", "y", "id"))
    return _reload(lines, readers.load_points, "tsv", id_column=2).select("id", "x", "y")


@query
def load_points_wkt_roundtrip(spark, sf):
    """Polygons read as points: the lower left corner of their bounds."""
    polys = tables.polygons(spark, sf)
    lines = polys.select(F.concat_ws("\t", "id", writers.wkt(polys)))
    return _reload(lines, readers.load_points, "wkt", offset=1, id_column=0).select("id", "x", "y")


@query
def load_rects_roundtrip(spark, sf):
    """Corners written upper right first."""
    lines = tables.rectangles(spark, sf).select(F.concat_ws(",", "id", "xmax", "ymin", "xmin", "ymax"))
    return _reload(lines, readers.load_rectangles, "csv", offset=1, id_column=0).select("id", *g.BOX)


@query
def load_rects_wkt_roundtrip(spark, sf):
    polys = tables.polygons(spark, sf)
    lines = polys.select(F.concat_ws("\t", writers.wkt(polys), "id"))
    return _reload(lines, readers.load_rectangles, "wkt", id_column=1).select("id", *g.BOX)


@query
def load_rects_wkt_z_roundtrip(spark, sf):
    """With a height in every position, which the bounds pass over."""
    polys = tables.polygons(spark, sf)
    raised = F.regexp_replace(writers.wkt(polys), "(-?[0-9.E-]+) (-?[0-9.E-]+)", "$1 $2 250.5")
    lines = polys.select(F.concat_ws("\t", F.regexp_replace(raised, "^POLYGON", "POLYGON Z"), "id"))
    return _reload(lines, readers.load_rectangles, "wkt", id_column=1).select("id", *g.BOX)


@query
def load_rects_collection_roundtrip(spark, sf):
    """Each polygon as the only member of a GeometryCollection, with heights."""
    json = writers.as_geojson(tables.polygons(spark, sf))
    column = json.columns[0]
    raised = F.regexp_replace(column, r"\[(-?[0-9.E-]+),\s*(-?[0-9.E-]+)\]", "[$1,$2,-77]")
    lines = json.select(F.concat(F.lit('{"type":"GeometryCollection","geometries":['), raised, F.lit("]}")))
    return _reload(lines, readers.load_rectangles, "geojson").select(*g.BOX)


@query
def load_rects_geojson_roundtrip(spark, sf):
    lines = writers.as_geojson(tables.polygons(spark, sf))
    return _reload(lines, readers.load_rectangles, "geojson").select(*g.BOX)


def _vertices(polys: DataFrame, *keys: str) -> DataFrame:
    """(keys, k, vx, vy): the shell's vertices, without the closing one."""
    ring = F.get("rings", F.lit(0))
    return polys.select(*keys, F.posexplode(F.slice(ring, F.lit(1), F.size(ring) - 1)).alias("k", "v")).select(
        *keys, "k", F.col("v.x").alias("vx"), F.col("v.y").alias("vy"))


@query
def load_polygons_csv_roundtrip(spark, sf):
    ring = F.get("rings", F.lit(0))
    numbers = F.array_join(F.transform(ring, lambda p: F.concat_ws(",", p["x"], p["y"])), ",")
    lines = tables.polygons(spark, sf).select(F.concat_ws(",", "id", numbers))
    return _vertices(_reload(lines, readers.load_polygons, "csv", offset=1, id_column=0), "id")


@query
def load_polygons_wkt_roundtrip(spark, sf):
    polys = tables.polygons(spark, sf)
    lines = polys.select(F.concat_ws("\t", "id", writers.wkt(polys)))
    return _vertices(_reload(lines, readers.load_polygons, "wkt", offset=1, id_column=0), "id")


@query
def load_polygons_geojson_roundtrip(spark, sf):
    return _vertices(_reload(writers.as_geojson(tables.small_polygons(spark, sf)), readers.load_polygons, "geojson"))


@query
def geojson_points(spark, sf):
    """Written as GeoJSON, read back as points."""
    folder = _new_folder(spark)
    writers.save_geojson(tables.clustered_points(spark, sf), folder)
    return readers.load_points(spark, folder, "geojson").select("x", "y")


@query
def load_step_points_roundtrip(spark, sf):
    folder = _new_folder(spark)
    writers.save_lines(tables.step_cells(spark, sf).select("t", "cx", "cy"), folder)
    return readers.load_step_points(spark, folder)


@query
def load_step_rects_roundtrip(spark, sf):
    """Squares written with swapped corners."""
    folder = _new_folder(spark)
    writers.save_lines(tables.step_cells(spark, sf).selectExpr("t", "cx + 1", "cy + 1", "cx", "cy"), folder)
    return readers.load_step_rectangles(spark, folder)


# ---------------------------------------------------------------- union

@query
def union_area(spark, sf):
    return union.union_area(tables.polygons(spark, sf)).withColumn("area", F.round("area", 6))


@query
def union_boundary(spark, sf):
    pieces = union.union_boundary(tables.polygons(spark, sf))
    return pieces.select("id", *(F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")))


@query
def union_parts(spark, sf):
    return union.union_parts(tables.polygons(spark, sf)).withColumn("area", F.round("area", 6))


@query
def union_rings(spark, sf):
    """(part, ring, vertices, area, holes): the rings of each polygon of the union, shell first, holes by falling area."""
    whole = union.union_polygons(tables.polygons(spark, sf))
    rings = whole.select("part", (F.size("rings") - 1).cast("bigint").alias("holes"), F.posexplode("rings").alias("ring", "points"))
    return rings.select("part", "ring", (F.size("points") - 1).cast("bigint").alias("vertices"), F.expr(f"round({g.signed_area2('points')} / 2, 5)").alias("area"), "holes")
