"""Boundary, record counts and skew report. Each is one aggregation with map-side partial results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.functions import geometry as g


def geometry_box(df: DataFrame) -> g.Box:
    """Bounds of each row, found by the geometry columns the table has."""
    names = set(df.columns)
    if set(g.BOX) <= names:
        return g.box()
    if "rings" in names:
        return g.rings_box("rings")
    if {"cx", "cy", "radius"} <= names:
        return g.circle_box(F.col("cx"), F.col("cy"), F.col("radius"))
    if {"x", "y"} <= names:
        return g.Box(F.col("x"), F.col("x"), F.col("y"), F.col("y"))
    raise ValueError(f"no geometry columns among {df.columns}")


def boundary(df: DataFrame) -> DataFrame:
    """One row ``(xmin, xmax, ymin, ymax)`` around points, rectangles, polygons or circles."""
    b = geometry_box(df)
    return df.agg(
        F.min(b.xmin).alias("xmin"), F.max(b.xmax).alias("xmax"), F.min(b.ymin).alias("ymin"), F.max(b.ymax).alias("ymax")
    )


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def distinct_geometries(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct geometries, ``(n)``."""
    return df.select(*columns).distinct().agg(F.count("*").alias("n"))


def partition_shares(df: DataFrame, pid: str = "pid") -> DataFrame:
    """Rows per partition and their share of all rows: the skew report."""
    counts = df.groupBy(pid).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row, joined as a broadcast scalar
    return counts.join(F.broadcast(total)).select(pid, "n", (F.col("n") / F.col("total")).alias("share"))


def circles_from_points(points: DataFrame, radius: float) -> DataFrame:
    rest = [c for c in points.columns if c not in ("x", "y")]
    return points.select(*rest, F.col("x").alias("cx"), F.col("y").alias("cy"), F.lit(float(radius)).alias("radius"))


def circle_centers(circles: DataFrame) -> DataFrame:
    rest = [c for c in circles.columns if c not in ("cx", "cy", "radius")]
    return circles.select(*rest, F.col("cx").alias("x"), F.col("cy").alias("y"))


def bounding_boxes(df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """Minimum bounding rectangle of each row."""
    return df.select(*keep, *g.box_columns(geometry_box(df)))


def circles_from_boxes(rectangles: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    cx, cy, radius = g.box_to_circle(g.box())
    return rectangles.select(*keep, cx.alias("cx"), cy.alias("cy"), radius.alias("radius"))
