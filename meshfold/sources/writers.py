"""Writing geometry as text: GeoJSON, WKT and CSV, one object per line, one file per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.functions import geometry as g


def _box_ring(b: g.Box) -> Column:
    corners = [(b.xmin, b.ymin), (b.xmax, b.ymin), (b.xmax, b.ymax), (b.xmin, b.ymax), (b.xmin, b.ymin)]
    return F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in corners))


def _rings(df: DataFrame) -> Column:
    """Rings of a polygon table, or the outline of a rectangle table."""
    return F.col("rings") if "rings" in df.columns else F.array(_box_ring(g.box()))


def as_geojson(df: DataFrame) -> DataFrame:
    """(json): a Point or Polygon geometry object per row."""
    if {"x", "y"} <= set(df.columns):
        kind, coordinates = "Point", F.array("x", "y")
    else:
        kind = "Polygon"
        coordinates = F.transform(_rings(df), lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    shape = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
    return df.select(F.to_json(shape).alias("json"))


def save_geojson(df: DataFrame, path: str) -> None:
    as_geojson(df).write.text(path)


def wkt(df: DataFrame) -> Column:
    """The row's geometry as WKT text."""
    if {"x", "y"} <= set(df.columns):
        return F.concat(F.lit("POINT ("), F.col("x"), F.lit(" "), F.col("y"), F.lit(")"))
    rings = F.transform(_rings(df), lambda ring: F.concat(
        F.lit("("), F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", p["x"], p["y"])), ", "), F.lit(")")))
    return F.concat(F.lit("POLYGON ("), F.array_join(rings, ", "), F.lit(")"))


def save_lines(df: DataFrame, path: str, separator: str = ",") -> None:
    """Result rows as delimited text, without a header."""
    df.write.option("sep", separator).option("header", "false").csv(path)
