"""Small fixtures: rows to DataFrames, and JTS (on Spark's own classpath, driver side) as an independent judge."""

from __future__ import annotations

import random

RINGS = "rings ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>"


def polygons(spark, shapes: dict[int, list[list[tuple[float, float]]]]):
    rows = [(i, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for i, rings in shapes.items()]
    return spark.createDataFrame(rows, f"id BIGINT, {RINGS}")


def points(spark, rows):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rows)], "id BIGINT, x DOUBLE, y DOUBLE")


def boxes(spark, rows):
    """Rows (xmin, xmax, ymin, ymax)."""
    return spark.createDataFrame(
        [(i, *map(float, r)) for i, r in enumerate(rows)], "id BIGINT, xmin DOUBLE, xmax DOUBLE, ymin DOUBLE, ymax DOUBLE")


def square(x, y, size):
    return [[(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]]


def star(rng: random.Random, cx, cy, r, corners=7):
    """A star-shaped polygon with random radii, concave in general, on a lattice of quarters."""
    import math

    ring = []
    for k in range(corners):
        a, d = 2 * math.pi * k / corners, r * rng.uniform(0.4, 1.0)
        ring.append((round((cx + d * math.cos(a)) * 4) / 4, round((cy + d * math.sin(a)) * 4) / 4))
    return [ring + ring[:1]]


def wkt(rings) -> str:
    return "POLYGON (" + ", ".join("(" + ", ".join(f"{x} {y}" for x, y in ring) + ")" for ring in rings) + ")"


class Jts:
    def __init__(self, spark):
        jts = spark._jvm.org.locationtech.jts
        self.reader, self.jvm = jts.io.WKTReader(), spark._jvm
        self.union_all = jts.operation.union.UnaryUnionOp.union

    def polygon(self, rings):
        return self.reader.read(wkt(rings))

    def point(self, x, y):
        return self.reader.read(f"POINT ({x} {y})")

    def box(self, b):
        x1, x2, y1, y2 = b
        return self.reader.read(f"POLYGON (({x1} {y1}, {x2} {y1}, {x2} {y2}, {x1} {y2}, {x1} {y1}))")

    def union(self, all_rings):
        geometries = self.jvm.java.util.ArrayList()
        for rings in all_rings:
            geometries.add(self.polygon(rings))
        return self.union_all(geometries)
