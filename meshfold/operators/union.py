"""Polygon union (dissolve): the outline, area and connected parts of all polygons together.

An edge of polygon P belongs to the outline where no other polygon covers it. Edges are rows: what covers them is found in cells (`covered`), and what is
left of an edge after merging its covered stretches is outline. The pieces keep the polygon's
orientation (interior on the left), so the area is a plain sum over them, holes included.

Stretches along a shared edge: if both polygons lie on the same side, the one with the smaller id keeps it;
if they lie on opposite sides, the edge is inside the union and both drop it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.operators.covered import covered_stretches
from meshfold.operators.rings import assembled, strung
from meshfold.plans.cells import Limits
from meshfold.session import stored

# Stretches of one edge that are merged at once; an edge with more is merged in parts first.
_MERGED_ROWS = 10_000


def _oriented(rings: g.Sql) -> g.Sql:
    """Shell counter-clockwise, holes clockwise: the interior is always on the left."""
    return f"transform({rings}, (r_, k_) -> CASE WHEN ({g.signed_area2('r_')} > 0) = (k_ = 0) THEN r_ ELSE reverse(r_) END)"


def _distinct_polygons(polygons: DataFrame, id_column: str) -> DataFrame:
    """(id, edges, xmin .. ymax), identical polygons once, under their smallest id."""
    return (
        polygons.select(F.col(id_column).alias("id"), F.expr(_oriented("rings")).alias("rings"))
        .groupBy("rings").agg(F.min("id").alias("id"))
        .select("id", "rings", F.expr(g.edges("rings")).alias("edges"), *g.box_columns(g.rings_box("rings")))
    )


def _merged(stretches: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping or touching stretches of a key joined into one."""
    order = Window.partitionBy(*keys).orderBy("t0", "t1")
    before = F.max("t1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = stretches.withColumn("starts", F.when(before >= F.col("t0"), 0).otherwise(1))
    return (
        starts.withColumn("run", F.sum("starts").over(order))
        .groupBy(*keys, "run").agg(F.min("t0").alias("t0"), F.max("t1").alias("t1")).drop("run")
    )


def _outline(shapes: DataFrame, stretches: DataFrame) -> DataFrame:
    """(id, x1, y1, x2, y2): what no other polygon covers.

    An edge under very many polygons is merged in parts first: merging is associative, and few stretches are left of each part.
    """
    covered = stretches.where(~F.col("kept"))
    crowded = covered.groupBy("id", "edge").agg(F.ceil(F.count("*") / _MERGED_ROWS).alias("parts")).where("parts > 1")
    covered = covered.join(crowded, ["id", "edge"], "left")
    covered = covered.withColumn("part", F.pmod(F.xxhash64("other"), F.coalesce("parts", F.lit(1).cast("bigint"))))
    covered = _merged(covered.select("id", "edge", "part", "t0", "t1"), ["id", "edge", "part"])
    edges = shapes.select("id", F.posexplode("edges").alias("edge", "e"))
    ends = edges.select("id", "edge", "e", F.lit(1.0).alias("t0"), F.lit(1.0).alias("t1"))
    rows = covered.select("id", "edge", F.lit(None).cast(edges.schema["e"].dataType).alias("e"), "t0", "t1").unionByName(ends)
    order = Window.partitionBy("id", "edge").orderBy("t0", "t1")
    free_from = F.coalesce(F.max("t1").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    whole = Window.partitionBy("id", "edge").orderBy(F.desc("t0"), F.desc("t1"))
    gaps = (
        rows.withColumn("u0", free_from).withColumn("shape", F.first("e", ignorenulls=True).over(whole))
        .where(F.col("t0") > F.col("u0"))
    )
    e = F.col("shape")

    def at(t: str, axis: str) -> Column:
        return e[f"{axis}1"] + F.col(t) * (e[f"{axis}2"] - e[f"{axis}1"])

    x1, y1, x2, y2 = at("u0", "x"), at("u0", "y"), at("t0", "x"), at("t0", "y")
    return gaps.select(
        "id",
        F.when(F.col("u0") == 0, e["x1"]).otherwise(x1).alias("x1"), F.when(F.col("u0") == 0, e["y1"]).otherwise(y1).alias("y1"),
        F.when(F.col("t0") == 1, e["x2"]).otherwise(x2).alias("x2"), F.when(F.col("t0") == 1, e["y2"]).otherwise(y2).alias("y2"),
    )


def union_boundary(polygons: DataFrame, id_column: str = "id", limits: Limits = Limits()) -> DataFrame:
    """(id, x1, y1, x2, y2): directed pieces of the union's outline, with the id of the polygon each comes from."""
    shapes = stored(_distinct_polygons(polygons, id_column), "union-shapes")
    return _outline(shapes, covered_stretches(shapes, limits)[0])


def _area(pieces: DataFrame) -> Column:
    return F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2


def union_area(polygons: DataFrame, id_column: str = "id", limits: Limits = Limits()) -> DataFrame:
    """One row ``(area)``."""
    pieces = union_boundary(polygons, id_column, limits)
    return pieces.agg(F.coalesce(_area(pieces), F.lit(0.0)).alias("area"))


def _part_labels(shapes: DataFrame, stretches: DataFrame, links: DataFrame) -> DataFrame:
    met = stretches.select("id", "other").union(links.select("id", "other")).distinct()
    return connected_components(shapes.select("id"), met.select(F.col("id").alias("a"), F.col("other").alias("b")))


def union_parts(polygons: DataFrame, id_column: str = "id", limits: Limits = Limits()) -> DataFrame:
    """(part, polygons, area): the connected parts of the union, named by their smallest polygon id.

    Polygons connect when they overlap or share a stretch of an edge; touching in a point does not connect.
    """
    shapes = stored(_distinct_polygons(polygons, id_column), "union-shapes")
    stretches, links = covered_stretches(shapes, limits)
    labels = _part_labels(shapes, stretches, links)
    members = labels.groupBy("part").agg(F.count("*").alias("polygons"))
    pieces = _outline(shapes, stretches).join(labels, "id")
    areas = pieces.groupBy("part").agg(_area(pieces).alias("area"))
    return members.join(areas, "part", "left")


def union_polygons(polygons: DataFrame, id_column: str = "id", limits: Limits = Limits()) -> DataFrame:
    """(part, rings): the union as polygons, one for each connected part, named by its smallest polygon id: the shell first, counter-clockwise, then the holes.

    Parts and rings may touch in points: touching parts stay apart, and no ring passes a point twice.
    """
    shapes = stored(_distinct_polygons(polygons, id_column), "union-shapes")
    stretches, links = covered_stretches(shapes, limits)
    labels = _part_labels(shapes, stretches, links)
    placed = strung(_outline(shapes, stretches).join(labels, "id"))
    return assembled(placed)


def connected_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, part): the smallest id reachable from each node over ``links (a, b)``, taken both ways.

    Each round takes the smallest label among the neighbours (a minimum, so partial results merge before the
    shuffle) and then the label of that label, which doubles the reach. The labels are stored each round.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "union-links")
    labels = stored(nodes.select("id", F.col("id").alias("part")), "union-labels")
    while True:
        offers = both.join(labels, both["b"] == labels["id"]).select(F.col("a").alias("id"), "part")
        nearest = offers.unionByName(labels).groupBy("id").agg(F.min("part").alias("part"))
        jump = labels.select(F.col("id").alias("part"), F.col("part").alias("further"))
        moved = stored(
            nearest.join(jump, "part", "left")
            .select("id", F.least("part", F.coalesce("further", "part")).alias("part")), "union-labels",
        )
        old = labels.select("id", F.col("part").alias("was"))
        changed = moved.join(old, "id").where(F.col("part") != F.col("was")).limit(1).count()
        labels = moved
        if not changed:
            return labels
