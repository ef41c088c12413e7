"""Headline queries, timed whole (planning jobs included). Prints one JSON line.

``BENCH_SF_DIR``  folder with the tables    ``BENCH_CPUS``  cores    ``BENCH_RUNS``  timed runs (the median counts)
``--plain`` also times the plain plans (cross join and filter) that the cell join replaces.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from meshfold.operators import knn, layout, paired
from meshfold.plans.queries import CENTER, K_RECTS, N_PARTITIONS, QUERIES, W2
from meshfold.session import local_session, new_folder
from meshfold.sources import tables

HEADLINE = [
    "range_rects_contains", "range_rects_intersects", "knn_rects", "knn_polys",
    "join_pts_rects_count", "join_pts_rects_pairs", "join_rects_rects_contains", "join_rects_rects_intersects",
    "join_pts_polys", "join_polys_polys_contains", "distance_join_exact", "distance_join_count",
    "union_area", "hotspot_gistar_all", "hotspot_gistar_top50", "partition_rtree_check", "boundary_rects",
]


def plain(spark, sf):
    """The same joins as cross join and filter."""
    points, rects, clustered = (f(spark, sf) for f in (tables.spread_points, tables.rectangles, tables.clustered_points))
    a, b = rects.alias("a"), rects.alias("b")
    near = "sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) < 0.1D"
    return {
        "plain_join_pts_rects_pairs": points.join(rects).where("x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax"),
        "plain_join_rects_rects_intersects": a.join(b).where(
            "a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin"),
        "plain_distance_join_exact": clustered.alias("a").join(clustered.alias("b")).where(near),
    }


def indexed(spark, sf):
    """Range, kNN and join over layouts that are written beforehand, next to the same over plain tables in HEADLINE."""
    rects, points = tables.rectangles(spark, sf), tables.spread_points(spark, sf)
    by_rects = layout.write_clustered(rects, new_folder(spark, "bench"), "hilbert", N_PARTITIONS)
    grid = paired.plan_grid(points, 64)
    objects, windows = paired.write_objects(points, grid, new_folder(spark, "bench")), paired.write_windows(rects, grid, new_folder(spark, "bench"))
    return {
        "indexed_range_rects_intersects": lambda: by_rects.range_rectangles(W2),
        "indexed_knn_rects": lambda: knn.ranked(by_rects.knn_rectangles(CENTER, K_RECTS)),
        "indexed_join_pts_rects_pairs": lambda: paired.join_stored(objects, windows),
    }


def timed(run, runs: int) -> float:
    run()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    spark.conf.set("spark.sql.crossJoin.enabled", "true")
    results = {}
    for name in HEADLINE:
        results[name] = timed(lambda q=QUERIES[name]: q(spark, sf).write.format("noop").mode("overwrite").save(), runs)
    for name, query in indexed(spark, sf).items():
        results[name] = timed(lambda q=query: q().write.format("noop").mode("overwrite").save(), runs)
    total = round(sum(results.values()), 3)
    if "--plain" in sys.argv:
        for name, df in plain(spark, sf).items():
            results[name] = timed(lambda d=df: d.write.format("noop").mode("overwrite").save(), 1)
    scale = os.path.basename(sf.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": total, "unit": "sec",
        "queries": results, "sf": float(scale) if scale.replace(".", "").isdigit() else scale, "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
