import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshfold.operators import partition, voronoi


def brute_nearest(sites, x, y):
    """Smallest number among the nearest sites."""
    a = np.array(sites)
    return int(np.argmin((a[:, 0] - x) ** 2 + (a[:, 1] - y) ** 2))


@pytest.fixture(scope="module")
def clustered(spark):
    """A third of the places within a millionth of the extent, one on a line, the rest spread."""
    rng = random.Random(5)
    rows = [(rng.uniform(0, 1e-4), rng.uniform(0, 1e-4)) for _ in range(400)]
    rows += [(50.0, rng.uniform(0, 100)) for _ in range(200)] + [(rng.uniform(0, 100), rng.uniform(0, 100)) for _ in range(600)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, x double, y double").cache()


def test_many_sites(spark, clustered):
    plan = partition.plan_partitions(clustered, "voronoi", 1150)
    assert len(plan.cuts) == 1150 > partition._MAX_LITERALS
    placed = plan.assign(clustered).collect()
    assert len(placed) == 1200
    assert all(r["pid"] == brute_nearest(plan.cuts, r["x"], r["y"]) for r in placed)


def test_squares_cover_the_bounds_once(spark, clustered):
    sites = clustered.selectExpr("id AS site", "x AS sx", "y AS sy")
    found = voronoi.squares(sites, (0.0, 100.0, 0.0, 100.0))
    share = sum(rows / 4.0**level for level, (_, rows) in found.levels.items())
    assert share == 1 and len(found.levels) > 3
    listed = sum(t.agg(F.sum(F.size("sites"))).first()[0] for t, _ in found.levels.values())
    assert listed < 60 * 1200  # from afar only a cluster's outermost sites count
    assert all(t.agg(F.max(F.size("sites"))).first()[0] <= voronoi.FEW for level, (t, _) in found.levels.items() if level < voronoi.LEVELS)


def test_wide_squares_are_shuffled(spark, clustered, monkeypatch):
    monkeypatch.setattr(voronoi, "BROADCAST_BYTES", 0)
    sites = clustered.where("id % 10 = 0").selectExpr("id AS site", "x AS sx", "y AS sy")
    rows = [(r["site"], r["sx"], r["sy"]) for r in sites.orderBy("site").collect()]
    found = voronoi.squares(sites, (0.0, 100.0, 0.0, 100.0)).nearest(clustered, F.col("x"), F.col("y"))
    got = {r["id"]: r["site"] for r in found.collect()}
    assert all(rows[brute_nearest([p[1:] for p in rows], r["x"], r["y"])][0] == got[r["id"]] for r in clustered.collect())


def corners_by_force(sites, i, bounds):
    """Crossings of all lines that bound the cell, kept where no line is overstepped."""
    x0, x1, y0, y1 = bounds
    planes = [(-1, 0, -x0), (1, 0, x1), (0, -1, -y0), (0, 1, y1)]
    sx, sy = sites[i]
    planes += [(x - sx, y - sy, ((x - sx) * (x + sx) + (y - sy) * (y + sy)) / 2) for j, (x, y) in enumerate(sites) if j != i]
    p = np.array(planes, float)
    out = []
    for j in range(len(p)):
        for k in range(j):
            det = p[j, 0] * p[k, 1] - p[k, 0] * p[j, 1]
            if abs(det) > 1e-12:
                v = ((p[j, 2] * p[k, 1] - p[k, 2] * p[j, 1]) / det, (p[j, 0] * p[k, 2] - p[k, 0] * p[j, 2]) / det)
                if (p[:, 0] * v[0] + p[:, 1] * v[1] - p[:, 2] <= 1e-9).all():
                    out.append(v)
    return np.array(out)


@pytest.mark.parametrize("kind", ["spread", "lattice", "line", "one"])
def test_cells(spark, kind):
    rng = random.Random(3)
    sites = {"spread": [(rng.uniform(1, 9), rng.uniform(1, 9)) for _ in range(25)], "lattice": [(1.0 + x, 1.0 + y) for x in range(4) for y in range(4)],
             "line": [(5.0, 1.0 + i) for i in range(8)], "one": [(3.0, 4.0)]}[kind]
    rows = [(i, *s) for i, s in enumerate(sites)] + [(100 + i, *s) for i, s in enumerate(sites[:2])] + [(200, None, 1.0), (201, 50.0, 1.0)]
    table = spark.createDataFrame(rows, "id long, x double, y double")
    cells = {r["site"]: r for r in voronoi.voronoi_cells(table, (0, 10, 0, 10)).collect()}
    assert set(cells) == set(range(len(sites)))
    area = 0.0
    for i, r in cells.items():
        expected = corners_by_force(sites, i, (0, 10, 0, 10))
        assert np.allclose([r["xmin"], r["xmax"], r["ymin"], r["ymax"]], [*(f(expected[:, a]) for a in (0, 1) for f in (min, max))])
        ring = [(p["x"], p["y"]) for p in r["corners"]]
        area += sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])) / 2
    assert abs(area - 100) < 1e-6  # the cells fill the bounds


def test_no_sites(spark):
    assert voronoi.voronoi_cells(spark.createDataFrame([], "id long, x double, y double"), (0, 1, 0, 1)).collect() == []
