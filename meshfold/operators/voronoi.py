"""Nearest sites and Voronoi cells, for many sites.

A square keeps the sites that can be nearest to some point of it. Its leaders are the nearest sites to its corners and its centre; a site
that one leader beats at all four corners is beaten in the whole square, which is convex, and goes. Squares with more than a few sites are cut into smaller
ones, which look only at the sites of their square. So a level costs a small multiple of the number of sites, clusters are
cut further than the rest, and from afar only a cluster's outermost sites count.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.session import stored

#: A square with this many sites or fewer isn't cut; bits of column and row added by a cut, and in all.
FEW, STEP, LEVELS = 8, 2, 24
#: Bytes of squares that are broadcast; beyond, objects and squares are shuffled by square.
BROADCAST_BYTES = 64 << 20
_SQUARE_BYTES = 64 + 32 * FEW


def grid_index(x: Column, y: Column, bounds: tuple[float, float, float, float], per_axis: int) -> tuple[Column, Column]:
    """Column and row in an equal grid over ``bounds``; whatever lies outside goes to the outermost cell."""
    xmin, xmax, ymin, ymax = bounds

    def index(value: Column, low: float, high: float) -> Column:
        if high <= low:
            return F.lit(0)
        cell = F.floor((value - low) / ((high - low) / per_axis))
        return F.least(F.greatest(cell, F.lit(0)), F.lit(per_axis - 1)).cast("int")

    return index(x, xmin, xmax), index(y, ymin, ymax)


@dataclass(frozen=True)
class Squares:
    """By level (bits of column and row): a stored table (column, row, sites) and its number of rows. They cover the bounds without overlap."""

    bounds: tuple[float, float, float, float]
    levels: dict[int, tuple[DataFrame, int]]

    def nearest(self, df: DataFrame, x: Column, y: Column, name: str = "site") -> DataFrame:
        """``df`` with the nearest site in column ``name``, of equally near ones the smallest; null for missing coordinates.

        Points outside the bounds take the nearest of the sites listed for the outermost square beside them.
        """
        df = df.withColumn("near_", F.lit(None).cast(next(iter(self.levels.values()))[0].schema["sites"].dataType))
        for level, (table, rows) in self.levels.items():
            column, row = grid_index(x, y, self.bounds, 1 << level)
            side = table.select(F.col("column").alias("column_"), F.col("row").alias("row_"), F.col("sites").alias("sites_"))
            if rows * _SQUARE_BYTES <= BROADCAST_BYTES and level < LEVELS:
                side = F.broadcast(side)
            df = df.withColumns({"column_": column, "row_": row}).join(side, ["column_", "row_"], "left")
            df = df.withColumn("near_", F.coalesce("near_", "sites_")).drop("column_", "row_", "sites_")

        def ranked(s: Column) -> Column:
            dx, dy = s["sx"] - x, s["sy"] - y
            return F.struct((dx * dx + dy * dy).alias("d2"), s["site"].alias("site"))

        best = F.when(F.size("near_") == 1, F.get("near_", F.lit(0))["site"]).otherwise(F.array_min(F.transform("near_", ranked))["site"])
        return df.withColumn(name, F.when(x.isNotNull() & y.isNotNull(), best)).drop("near_")


def squares(sites: DataFrame, bounds: tuple[float, float, float, float]) -> Squares:
    """The squares over ``bounds`` for ``sites`` (site, sx, sy), which have to be distinct places.

    One stored table a level; only counts reach the driver. Squares of the last level keep their sites, however many.
    """
    xmin, xmax, ymin, ymax = bounds
    levels: dict[int, tuple[DataFrame, int]] = {}
    left, level = sites.select(F.lit(0).alias("column"), F.lit(0).alias("row"), "site", "sx", "sy"), 0
    while left is not None:
        level += STEP
        w, h = (xmax - xmin) / (1 << level), (ymax - ymin) / (1 << level)
        inner = [F.explode(F.sequence(F.lit(0), F.lit((1 << STEP) - 1 if size > 0 else 0))).alias(n) for n, size in (("c_", w), ("r_", h))]
        cut = left.select("*", inner[0]).select("*", inner[1]).select(
            (F.shiftleft("column", STEP) + F.col("c_")).alias("column"), (F.shiftleft("row", STEP) + F.col("r_")).alias("row"), "site", "sx", "sy")
        left_, low = F.lit(xmin) + F.col("column") * w, F.lit(ymin) + F.col("row") * h
        corners = [(left_ + i * w, low + j * h) for i in (0, 1) for j in (0, 1)]
        ahead = [F.min(F.struct(_square_distance(c, F.col("sx"), F.col("sy")).alias("d"), "sx", "sy")) for c in (*corners, (left_ + w / 2, low + h / 2))]
        leaders = cut.groupBy("column", "row").agg(F.array_distinct(F.transform(F.array(*ahead), lambda p: F.struct(p["sx"].alias("x"), p["sy"].alias("y")))).alias("leaders_"))
        beaten = F.exists("leaders_", lambda p: reduce(and_, (
            _square_distance(c, p["x"], p["y"]) < _square_distance(c, F.col("sx"), F.col("sy")) * (1 - 1e-12) for c in corners)))
        kept = stored(cut.join(leaders, ["column", "row"]).where(~beaten).drop("leaders_"), "voronoi-sites")
        sizes = kept.groupBy("column", "row").agg(F.count("*").alias("n_"))
        settled = F.col("n_") <= (FEW if level < LEVELS else 2**62)
        place = F.struct("site", "sx", "sy")
        done = kept.join(sizes.where(settled), ["column", "row"]).groupBy("column", "row").agg(F.array_sort(F.collect_list(place)).alias("sites"))
        done = stored(done, "voronoi-squares")
        rows = done.count()
        if rows:
            levels[level] = done, rows
        more = sizes.where(~settled)
        left = kept.join(more.drop("n_"), ["column", "row"]) if more.limit(1).count() else None
    return Squares(bounds, levels)


def _square_distance(c: tuple[Column, Column], x: Column, y: Column) -> Column:
    return (c[0] - x) * (c[0] - x) + (c[1] - y) * (c[1] - y)


def _clipped() -> str:
    """The polygon corners_ without what is nearer to o_ than to the row's site."""
    def beyond(p: str) -> str:
        return f"(({p}.x - (sx + o_.sx) / 2) * (o_.sx - sx) + ({p}.y - (sy + o_.sy) / 2) * (o_.sy - sy))"

    none = "slice(corners_, 1, 0)"
    x, y = (f"p_.{c} + a_ / (a_ - b_) * (q_.{c} - p_.{c})" for c in "xy")
    both = (f"concat(CASE WHEN a_ <= 0 THEN array(p_) ELSE {none} END,"
            f" CASE WHEN a_ < 0 AND b_ > 0 OR a_ > 0 AND b_ < 0 THEN array(named_struct('x', {x}, 'y', {y})) ELSE {none} END)")
    side = g.bind_sql(beyond("p_"), "a_", g.bind_sql(beyond("q_"), "b_", both))
    return f"flatten(transform(corners_, (p_, i_) -> {g.bind_sql('get(corners_, (i_ + 1) % size(corners_))', 'q_', side)}))"


def voronoi_cells(sites: DataFrame, bounds: tuple[float, float, float, float], site: str = "id", x: str = "x", y: str = "y") -> DataFrame:
    """(site, sx, sy, corners, xmin, xmax, ymin, ymax): each site's cell within ``bounds`` as an open ring of corners, and its box.

    Of sites in one place the smallest has the cell and the others have none, nor have sites without coordinates or outside the bounds.
    A cell is the rectangle of the bounds, cut by the line halfway to each site that shares a square with its own.
    """
    xmin, xmax, ymin, ymax = (float(b) for b in bounds)
    places = sites.select(F.col(site).alias("site"), F.col(x).alias("sx"), F.col(y).alias("sy"))
    places = places.where(F.col("sx").between(xmin, xmax) & F.col("sy").between(ymin, ymax))
    places = stored(places.groupBy("sx", "sy").agg(F.min("site").alias("site")).select("site", "sx", "sy"), "voronoi-places")
    shared = None
    for table, _ in squares(places, (xmin, xmax, ymin, ymax)).levels.values():
        shared = table.select("sites") if shared is None else shared.union(table.select("sites"))
    if shared is None:
        shared = places.select(F.array(F.struct("site", "sx", "sy")).alias("sites"))
    pairs = shared.select(F.explode("sites").alias("a"), "sites").select("a", F.explode("sites").alias("o")).where("a.site <> o.site").distinct()
    others = pairs.groupBy("a.site").agg(F.array_sort(F.collect_list("o")).alias("others"))
    ring = ", ".join(f"named_struct('x', {a!r}D, 'y', {b!r}D)" for a, b in ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax)))
    none = "slice(array(named_struct('site', site, 'sx', sx, 'sy', sy)), 1, 0)"
    cells = places.join(others, "site", "left").withColumn(
        "corners", F.expr(f"aggregate(coalesce(others, {none}), array({ring}), (corners_, o_) -> {_clipped()})"))
    box = [F.expr(f"array_{f}(transform(corners, p_ -> p_.{a}))").alias(f"{a}{f}") for a in "xy" for f in ("min", "max")]
    return cells.select("site", "sx", "sy", "corners", *box)
