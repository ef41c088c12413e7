"""Geometry tables derived from the business tables, one row in, one row out, no shuffle.

The tables hold no coordinates, so keys are spread over the plane by fixed arithmetic. Divisors are
written 1e2 (a DOUBLE), so that other SQL engines compute the very same bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.functions import geometry as g

# Formulas of the derived tables (fixed values).
POINT_X = "((o_orderkey*7919)%36000)/1e2-1.8e2"
POINT_Y = "((o_orderkey*10473)%18000)/1e2-9e1"
CLUSTER_X = "(c_nationkey*13-160)+((c_custkey*31)%400)/1e2"
CLUSTER_Y = "(c_nationkey*5-60)+((c_custkey*17)%300)/1e2"
RECT_X = "((p_partkey*6151)%36000)/1e2-1.8e2"
RECT_Y = "((p_partkey*7411)%18000)/1e2-9e1"
POLY_X = "((s_suppkey*3571)%36000)/1e2-1.8e2+5e-3"
POLY_Y = "((s_suppkey*2903)%18000)/1e2-9e1+2e-3"
DIAMOND = [(1, 0), (0, 1), (-1, 0), (0, -1)]
ELL = [(-1, -1), (1, -1), (1, 0), (0, 0), (0, 1), (-1, 1)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread_points(spark: SparkSession, folder: str) -> DataFrame:
    """(id, x, y): spread points."""
    return table(spark, folder, "orders").selectExpr("o_orderkey AS id", f"{POINT_X} AS x", f"{POINT_Y} AS y")


def clustered_points(spark: SparkSession, folder: str) -> DataFrame:
    """(id, x, y): points in clusters, some equal."""
    return table(spark, folder, "customer").selectExpr("c_custkey AS id", f"{CLUSTER_X} AS x", f"{CLUSTER_Y} AS y")


def circles(spark: SparkSession, folder: str) -> DataFrame:
    """(id, cx, cy, radius)."""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", f"{CLUSTER_X} AS cx", f"{CLUSTER_Y} AS cy", "(1+c_custkey%10)/1e1 AS radius"
    )


def rectangles(spark: SparkSession, folder: str) -> DataFrame:
    """(id, xmin, xmax, ymin, ymax)."""
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS id",
        f"{RECT_X}-p_size/1e1 AS xmin", f"{RECT_X}+p_size/1e1 AS xmax",
        f"{RECT_Y}-p_size/2e1 AS ymin", f"{RECT_Y}+p_size/2e1 AS ymax",
    )


def _ring(shape: list[tuple[int, int]], x: str, y: str, r: str):
    vertex = [
        F.struct((F.col(x) + F.col(r) * F.lit(i)).alias("x"), (F.col(y) + F.col(r) * F.lit(j)).alias("y"))
        for i, j in [*shape, shape[0]]
    ]
    return F.array(*vertex)


def polygons(spark: SparkSession, folder: str) -> DataFrame:
    """(id, rings): a diamond for odd keys, a concave L for even ones."""
    centers = table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS id", f"{POLY_X} AS px", f"{POLY_Y} AS py", "3+s_suppkey%7 AS r"
    )
    ring = F.when(F.col("id") % 2 == 1, _ring(DIAMOND, "px", "py", "r")).otherwise(_ring(ELL, "px", "py", "r"))
    return centers.select("id", F.array(ring).alias("rings"))


def small_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """(id, rings): small diamonds."""
    centers = table(spark, folder, "part").selectExpr(
        "p_partkey AS id", f"{RECT_X} AS px", f"{RECT_Y} AS py", "p_size/1e2 AS r"
    )
    return centers.select("id", F.array(_ring(DIAMOND, "px", "py", "r")).alias("rings"))


def step_cells(spark: SparkSession, folder: str) -> DataFrame:
    """(id, t, cx, cy): events placed into the hot-spot cube."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS id", "CAST(extract(DAY FROM ts) AS INT) AS t",
        "CAST(4050+(event_id*event_id)%40 AS INT) AS cx", "CAST(-7425+(event_id*user_id)%57 AS INT) AS cy",
    )
