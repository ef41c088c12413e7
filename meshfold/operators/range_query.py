"""Range query: the rows whose geometry lies in, or meets, a rectangular window.

Plain filters on bound columns: on Parquet they prune row groups by min/max, and over
the clustered layout (`meshfold.operators.layout`) whole partitions as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.functions import geometry as g

Window = tuple[float, float, float, float]  # xmin, xmax, ymin, ymax

CONTAINS, INTERSECTS = "contains", "intersects"


def _check_condition(condition: str) -> None:
    if condition not in (CONTAINS, INTERSECTS):
        raise ValueError(f"condition must be '{CONTAINS}' or '{INTERSECTS}', not {condition!r}")


def range_points(points: DataFrame, window: Window, condition: str = CONTAINS) -> DataFrame:
    """Points inside or on the window; for points both conditions mean the same."""
    _check_condition(condition)
    return points.where(g.box_contains_point(g.window_box(window), F.col("x"), F.col("y")))


def range_rectangles(rectangles: DataFrame, window: Window, condition: str = CONTAINS) -> DataFrame:
    _check_condition(condition)
    w = g.window_box(window)
    return rectangles.where(g.box_contains_box(w, g.box()) if condition == CONTAINS else g.boxes_intersect(g.box(), w))


def range_polygons(polygons: DataFrame, window: Window, condition: str = CONTAINS, mode: str = "exact") -> DataFrame:
    """Polygons in or meeting the window; ``mode='mbr'`` returns those whose bounding box meets it.

    Uses the columns ``xmin .. ymax`` if the table has them, so that stored bounds prune the scan.
    """
    _check_condition(condition)
    w = g.window_box(window)
    bounds = g.box() if set(g.BOX) <= set(polygons.columns) else g.rings_box("rings")
    if mode == "mbr":
        return polygons.where(g.boxes_intersect(bounds, w))
    if mode != "exact":
        raise ValueError(f"mode must be 'exact' or 'mbr', not {mode!r}")
    if condition == CONTAINS:  # a rectangle contains a polygon exactly when it contains its bounds
        return polygons.where(g.box_contains_box(w, bounds))
    x1, x2, y1, y2 = map(g.number, (*sorted(window[:2]), *sorted(window[2:])))
    meets = g.over_edges("rings", g.polygon_intersects_box("edges_", x1, x2, y1, y2))
    return polygons.where(g.boxes_intersect(bounds, w) & F.expr(meets))
