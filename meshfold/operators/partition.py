"""Spatial partitioning: a partition id per object, by one of five methods.

``equalgrid``  equal cells over the boundary
``hilbert``    equal shares along a Hilbert curve
``rtree``      sort-tile: strips of equal shares by x, each cut into equal shares by y
``voronoi``    the nearest of n sites taken from the data
``quadtree``   squares halved on both axes until none has more than one n-th of the rows; there may be more than n of them

Every object gets exactly one id, by its centre, so nothing is copied. Cuts come from distributed
approximate percentiles; only the cuts themselves (at most n numbers) reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.operators.aggregate import geometry_box
from meshfold.operators.join import rectangles_in_rectangles
from meshfold.operators.voronoi import grid_index, squares
from meshfold.session import stored

METHODS = ("equalgrid", "hilbert", "rtree", "voronoi", "quadtree")
HILBERT_BITS = QUAD_LEVELS = 15
_STEP_BITS = 3
_SAMPLE_PER_PARTITION = 1000
_ACCURACY = 10_000
_CELLS_PER_SITE, _MAX_CELLS = 64, 1 << 20
#: Cuts or sites that a plan holds as literals; more of them become a table, broadcast up to so many numbers.
_MAX_LITERALS, _MAX_BROADCAST = 1024, 8 << 20


def sample_size(n: int, rows: int) -> int:  # the shares and results are fixed values
    """Rows to sample for n partitions: 1 %, or 0 if that is fewer than n (too small to cut).

    -1 when there are not more rows than partitions, which callers refuse.
    """
    if rows <= n:
        return -1
    sample = min(rows // 100, 2**31 - 1)
    return sample if sample >= n else 0


@dataclass(frozen=True)
class Leaf:
    """A square of a quadtree: its first place on the Morton curve, its level (0: the whole), and its rows if these are too many even on the last level."""

    start: int
    level: int
    crowd: int = 0

    def cells(self) -> tuple[int, int, int, int]:
        """The cells of the finest grid it covers: first and last column, first and last row."""
        column, row = (sum((self.start >> (2 * b + odd) & 1) << b for b in range(QUAD_LEVELS)) for odd in (1, 0))
        size = 1 << (QUAD_LEVELS - self.level)
        return column, column + size - 1, row, row + size - 1


@dataclass(frozen=True)
class Partitioning:
    """Cuts found on one table; `assign` applies them to that or any other table."""

    method: str
    n: int
    bounds: tuple[float, float, float, float]  # xmin, xmax, ymin, ymax
    cuts: tuple = field(default=())
    rows: int = 0  # of the table the cuts were found on
    leaves: tuple[Leaf, ...] = field(default=())  # of a quadtree, by partition id

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with an INT column ``pid`` in 0 .. n-1 (a quadtree's: one for each of its leaves); null for rows with a missing coordinate."""
        x, y = g.box_center(geometry_box(df))
        known = df.withColumn("known_", x.isNotNull() & y.isNotNull())
        # A generator, so that no null check on the id is moved below the searches, where it would write out each step three times the one before.
        return self._assigned(known).withColumn("pid", F.explode(F.array(F.when(F.col("known_"), F.col("pid"))))).drop("known_")

    def _assigned(self, df: DataFrame) -> DataFrame:
        if self.n == 1:
            return df.withColumn("pid", F.lit(0))
        x, y = g.box_center(geometry_box(df))
        if self.method == "equalgrid":
            per_axis = math.isqrt(self.n)
            column, row = grid_index(x, y, self.bounds, per_axis)
            return df.withColumn("pid", column * per_axis + row)
        if self.method == "hilbert":
            keyed = df.withColumn("curve_", hilbert_key(x, y, self.bounds))
            return _ranked(keyed, "pid", "curve_", [self.cuts]).drop("curve_")
        if self.method == "quadtree":
            keyed = df.withColumn("curve_", morton_key(x, y, self.bounds))
            return _ranked(keyed, "pid", "curve_", [self.cuts]).drop("curve_")
        if self.method == "rtree":
            x_cuts, first, y_cuts = self.cuts
            striped = _ranked(df.withColumn("x_", x).withColumn("y_", y), "strip_", "x_", [x_cuts])
            tiled = _ranked(striped, "tile_", "y_", y_cuts, "strip_")
            pid = F.get(_literal_array(first), F.col("strip_")) + F.col("tile_")
            return tiled.withColumn("pid", pid).drop("x_", "y_", "strip_", "tile_")
        return self._nearest_site(df, x, y)

    def _nearest_site(self, df: DataFrame, x: Column, y: Column) -> DataFrame:
        """A grid lists, for each cell, the sites that can be nearest to a point in it: one for most cells. Many sites take squares of several sizes."""
        if len(self.cuts) > _MAX_LITERALS:
            sites = df.sparkSession.createDataFrame([(i, *c) for i, c in enumerate(self.cuts)], "site int, sx double, sy double")
            return squares(sites, self.bounds).nearest(df, x, y, "pid")
        sites = F.array(*(_site(i, sx, sy) for i, (sx, sy) in enumerate(self.cuts)))
        per_axis = math.isqrt(min(_CELLS_PER_SITE * self.n, _MAX_CELLS)) + 1
        xmin, xmax, ymin, ymax = self.bounds
        w, h = (xmax - xmin) / per_axis, (ymax - ymin) / per_axis
        cells = df.sparkSession.range(per_axis * per_axis).select(
            (F.col("id").cast("int") / per_axis).cast("int").alias("grid_x"),
            (F.col("id") % per_axis).cast("int").alias("grid_y"),
        )
        left, low = F.lit(xmin) + F.col("grid_x") * F.lit(w), F.lit(ymin) + F.col("grid_y") * F.lit(h)
        cell = g.Box(left, left + w, low, low + h)
        reach = F.array_min(F.transform(sites, lambda s: g.box_far_distance(cell, s["sx"], s["sy"])))

        def within(limit: Column) -> Column:
            return F.filter(sites, lambda s: g.box_distance(cell, s["sx"], s["sy"]) <= limit)

        near = cells.select("grid_x", "grid_y", g.bind(reach * (1 + 1e-9), within).alias("sites"))
        column, row = grid_index(x, y, self.bounds, per_axis)

        def ranked(s: Column) -> Column:
            dx, dy = s["sx"] - x, s["sy"] - y
            return F.struct((dx * dx + dy * dy).alias("d2"), s["site"].alias("site"))

        placed = df.withColumn("grid_x", column).withColumn("grid_y", row)
        # Bounded: _MAX_CELLS rows, however many rows df has.
        found = placed.join(F.broadcast(near), ["grid_x", "grid_y"], "left")
        only = F.get("sites", F.lit(0))["site"]
        pid = F.when(F.size("sites") == 1, only).otherwise(F.array_min(F.transform("sites", ranked))["site"])
        return found.withColumn("pid", pid).drop("grid_x", "grid_y", "sites")


def _site(i: int, x: float, y: float) -> Column:
    return F.struct(F.lit(i).alias("site"), F.lit(float(x)).alias("sx"), F.lit(float(y)).alias("sy"))


def _literal_array(values) -> Column:
    """A literal array of whole numbers or of doubles, parsed in one call."""
    texts = [f"{v!r}D" if isinstance(v, float) else f"{v}L" if abs(v) >= 2**31 else str(v) for v in values]
    return F.expr(f"array({','.join(texts)})")


def _ranked(df: DataFrame, name: str, value: str, cuts: list, group: str | None = None) -> DataFrame:
    """Adds ``name``: the number of cuts (ascending) that are <= ``value``, by binary search.

    ``cuts`` is one list, or one per number in column ``group``. More than `_MAX_LITERALS` cuts are a table: of one list, every
    so many a cut is searched first and names the stretch, about as many cuts again, that the row is joined with.
    """
    if sum(map(len, cuts)) <= _MAX_LITERALS:
        return _searched(df, name, value, cuts, group)
    if group:
        return _in_stretch(df, name, value, cuts, group)
    step = math.isqrt(len(cuts[0])) + 1
    stretches = [cuts[0][i:i + step] for i in range(0, len(cuts[0]), step)]
    of = f"{name}_of"
    found = _in_stretch(_ranked(df, of, value, [tuple(s[0] for s in stretches[1:])]), name, value, stretches, of)
    return found.withColumn(name, F.col(of) * step + F.col(name)).drop(of)


def _in_stretch(df: DataFrame, name: str, value: str, cuts: list, group: str) -> DataFrame:
    """`_searched` among the cuts of the row's group, which come from a table of as many rows as there are groups."""
    size = 1 << max(map(len, cuts)).bit_length()
    kind = "double" if isinstance(next(c[0] for c in cuts if c), float) else "bigint"
    table = df.sparkSession.createDataFrame(
        [(i, [*c, *[_never(kind == "double")] * (size - len(c))]) for i, c in enumerate(cuts)], f"`{group}` int, cuts_ array<{kind}>")
    if size * len(cuts) <= _MAX_BROADCAST:
        table = F.broadcast(table)
    return _halvings(df.join(table, group, "left"), name, value, F.col("cuts_"), F.lit(0), size).drop("cuts_")


def _searched(df: DataFrame, name: str, value: str, cuts: list, group: str | None) -> DataFrame:
    """The search in one literal array, padded so that every search takes the same steps."""
    size = 1 << max(map(len, cuts)).bit_length()
    if size == 1:
        return df.withColumn(name, F.lit(0))
    never = _never(isinstance(max((c[-1] for c in cuts if c), default=0), float))
    table = _literal_array([v for c in cuts for v in [*c, *[never] * (size - len(c))]])
    return _halvings(df, name, value, table, F.col(group) * size if group else F.lit(0), size)


def _never(fraction: bool) -> float | int:
    return 1.7976931348623157e308 if fraction else 2**63 - 1


def _halvings(df: DataFrame, name: str, value: str, table: Column, start: Column, size: int) -> DataFrame:
    """The binary search; every halving is a projection of its own, which keeps it in generated code."""
    df = df.withColumn(name, F.lit(0))
    for step in (size >> i for i in range(1, size.bit_length())):
        ahead = F.get(table, start + F.col(name) + (step - 1))
        df = df.withColumn(name, F.when(ahead <= F.col(value), F.col(name) + step).otherwise(F.col(name)))
    return df


def _curve_table() -> list[int]:
    """Hilbert curve over `_STEP_BITS` bits of x and y at a time, as a table for lookups.

    Entry [state, x bits, y bits] holds (position << 2 | next state). A state says how the square was entered:
    bit 0 with x and y swapped, bit 1 with both mirrored.
    """
    size = 1 << _STEP_BITS
    table = []
    for state in range(4):
        for x in range(size):
            for y in range(size):
                swapped, mirrored, position = state & 1, state >> 1, 0
                for bit in range(_STEP_BITS - 1, -1, -1):
                    right, upper = (x >> bit & 1) ^ mirrored, (y >> bit & 1) ^ mirrored
                    if swapped:
                        right, upper = upper, right
                    # Quadrants in curve order: lower left, upper left, upper right, lower right.
                    position = position << 2 | ((0, 3), (1, 2))[upper][right]
                    if not upper:  # the first quadrant is entered swapped, the last swapped and mirrored
                        swapped, mirrored = swapped ^ 1, mirrored ^ right
                table.append(position << 2 | mirrored << 1 | swapped)
    return table


def hilbert_key(x: Column, y: Column, bounds: tuple[float, float, float, float]) -> Column:
    """Position along the Hilbert curve of order 15 over ``bounds``, as BIGINT: five table lookups, all generated code."""
    column, row = grid_index(x, y, bounds, 1 << HILBERT_BITS)
    table = _literal_array(_curve_table())
    mask = (1 << _STEP_BITS) - 1
    key, entry = F.lit(0).cast("bigint"), F.lit(0)
    for shift in range(HILBERT_BITS - _STEP_BITS, -1, -_STEP_BITS):
        bits = [F.shiftright(v, shift).bitwiseAND(mask) for v in (column, row)]
        entry = F.get(table, ((entry.bitwiseAND(3) * (mask + 1)) + bits[0]) * (mask + 1) + bits[1])
        key = F.shiftleft(key, 2 * _STEP_BITS) + F.shiftright(entry, 2)
    return key


def morton_key(x: Column, y: Column, bounds: tuple[float, float, float, float]) -> Column:
    """Position along the Morton curve over ``bounds``, as BIGINT: the bits of the grid cell's column and row in turn, column first."""
    def apart(v: Column) -> Column:
        v = v.cast("bigint")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return v

    column, row = grid_cell(x, y, bounds)
    return F.shiftleft(apart(column), 1).bitwiseOR(apart(row))


def grid_cell(x: Column, y: Column, bounds: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """Column and row in the finest grid of a quadtree; whatever lies outside goes to the outermost cell."""
    return grid_index(x, y, bounds, 1 << QUAD_LEVELS)


def _quad_leaves(centers: DataFrame, bounds, rows: int, n: int) -> tuple[Leaf, ...]:
    """The squares with at most ceil(rows / n) rows that come from splitting all larger ones, in Morton order.

    All levels are counted at once, from the counts of the finest cells; only the squares that have to be split reach the driver, some 16 n at most.
    """
    most = -(-rows // n)
    cells = centers.groupBy(morton_key(F.col("x"), F.col("y"), bounds).alias("key")).agg(F.count("*").alias("n"))
    level = F.explode(F.sequence(F.lit(0), F.lit(QUAD_LEVELS))).alias("level")
    squares = cells.select("key", "n", level).selectExpr("level", f"shiftright(key, 2 * ({QUAD_LEVELS} - level)) AS square", "n")
    split = {(r["level"], r["square"]): r["n"] for r in squares.groupBy("level", "square").agg(F.sum("n").alias("n")).where(F.col("n") > most).collect()}
    leaves = [] if (0, 0) in split else [Leaf(0, 0)]
    for (level, square), count in split.items():
        if level == QUAD_LEVELS:
            leaves.append(Leaf(square, level, count))
        else:
            leaves += [Leaf(child << 2 * (QUAD_LEVELS - level - 1), level + 1) for child in range(4 * square, 4 * square + 4) if (level + 1, child) not in split]
    return tuple(sorted(leaves, key=lambda leaf: leaf.start))


def _percentiles(df: DataFrame, value: str, shares: list[float], by: str | None = None) -> DataFrame:
    grouped = df.groupBy(by) if by else df.groupBy()
    accuracy = max(_ACCURACY, 20 * len(shares))  # an error of a twentieth of a partition at most
    return grouped.agg(F.percentile_approx(value, shares, accuracy).alias("cuts"))


def _even_cuts(keys: DataFrame, n: int) -> tuple[int, ...]:
    """The n - 1 keys of the curve that cut the rows into n equal shares, exactly, by a pyramid of counts.

    Keys are counted; sums by their upper half give the rows before each of at most 2^15 stretches of the curve, and a running
    sum within a stretch, of at most 2^15 keys, the rest. Only the cuts reach the driver.
    """
    counts = stored(keys.groupBy("key").agg(F.count("*").alias("n")).withColumn("upper", F.shiftright("key", HILBERT_BITS)), "curve-counts")
    earlier = Window.orderBy("upper").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy("upper").agg(F.sum("n").alias("n"))
    before = sums.select("upper", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    until = F.sum("n").over(Window.partitionBy("upper").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    total = counts.agg(F.sum("n")).first()[0]
    ends = counts.join(F.broadcast(before), "upper").withColumn("until", F.col("before") + until)  # at most 2^15 rows
    first, last = F.expr(f"(until - n) * {n} DIV {total} + 1"), F.expr(f"least(until * {n} DIV {total}, {n - 1})")
    cuts = ends.withColumns({"first": first, "last": last}).where("first <= last").select("key", F.explode(F.sequence("first", "last")).alias("i"))
    return tuple(r["key"] + 1 for r in cuts.orderBy("i").collect())


def plan_partitions(df: DataFrame, method: str, n: int, collapse: bool = False) -> Partitioning:
    """Finds the cuts. With ``collapse``, one partition is made when 1 % of the rows would be fewer than n."""
    if method not in METHODS:
        raise ValueError(f"partitioning method must be one of {METHODS}, not {method!r}")
    if n < 1:
        raise ValueError("n must be at least 1")
    around = geometry_box(df)
    b = df.agg(
        F.min(around.xmin).alias("xmin"), F.max(around.xmax).alias("xmax"),
        F.min(around.ymin).alias("ymin"), F.max(around.ymax).alias("ymax"), F.count("*").alias("n"),
    ).first()
    rows = b["n"]
    if rows and b["xmin"] is None:
        raise ValueError("no row has a geometry")
    sample = sample_size(n, rows)
    if sample == -1:
        raise ValueError(f"{rows} rows cannot fill {n} partitions; ask for fewer")
    bounds = (b["xmin"], b["xmax"], b["ymin"], b["ymax"])
    if n == 1 or collapse and sample == 0:
        return Partitioning(method, 1, bounds, rows=rows)
    if method == "equalgrid":
        return Partitioning(method, n, bounds, rows=rows)

    x, y = g.box_center(geometry_box(df))
    centers = df.select(x.alias("x"), y.alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    if method == "quadtree":
        leaves = _quad_leaves(centers, bounds, rows, n)
        return Partitioning(method, len(leaves), bounds, tuple(leaf.start for leaf in leaves[1:]), rows, leaves)
    wanted = max(sample, n * _SAMPLE_PER_PARTITION)
    if wanted < rows / 2:
        centers = centers.sample(wanted / rows, seed=11)
    if method == "hilbert":
        keys = centers.select(hilbert_key(F.col("x"), F.col("y"), bounds).alias("key"))
        if n > _MAX_LITERALS:
            return Partitioning(method, n, bounds, _even_cuts(keys, n), rows)
        cuts = _percentiles(keys, "key", [i / n for i in range(1, n)]).first()["cuts"]
        return Partitioning(method, n, bounds, tuple(cuts), rows)
    if method == "rtree":
        return Partitioning(method, n, bounds, _tile_cuts(centers, n), rows)
    # Distinct places in order of a hash: a random choice that a second run repeats. n rows.
    places = centers.distinct().orderBy(F.xxhash64("x", "y"), "x", "y").limit(n).collect()
    return Partitioning(method, len(places), bounds, tuple((r["x"], r["y"]) for r in places), rows)


def _tile_cuts(centers: DataFrame, n: int) -> tuple:
    """(x cuts, first pid of each strip, y cuts of each strip) with n tiles in total."""
    strips = max(1, math.isqrt(n))
    tiles = [n // strips + (1 if i < n % strips else 0) for i in range(strips)]
    first = [sum(tiles[:i]) for i in range(strips)]
    x_cuts = []
    if strips > 1:
        x_cuts = _percentiles(centers, "x", [f / n for f in first[1:]]).first()["cuts"]
    in_strips = _ranked(centers, "strip", "x", [x_cuts])
    by_count: dict[int, dict[int, list[float]]] = {}
    for count in {t for t in tiles if t > 1}:  # at most two values
        shares = [i / count for i in range(1, count)]
        by_count[count] = {r["strip"]: r["cuts"] for r in _percentiles(in_strips, "y", shares, "strip").collect()}
    y_cuts = [by_count.get(t, {}).get(i, []) for i, t in enumerate(tiles)]
    return tuple(x_cuts), tuple(first), tuple(map(tuple, y_cuts))


def assign_partitions(df: DataFrame, method: str, n: int, collapse: bool = False) -> DataFrame:
    """``df`` with its partition id ``pid``."""
    return plan_partitions(df, method, n, collapse).assign(df)


def partition_bounds(df: DataFrame) -> DataFrame:
    """(pid, xmin, xmax, ymin, ymax, n): what the members of each partition really cover."""
    b = geometry_box(df)
    return df.groupBy("pid").agg(
        F.min(b.xmin).alias("xmin"), F.max(b.xmax).alias("xmax"),
        F.min(b.ymin).alias("ymin"), F.max(b.ymax).alias("ymax"), F.count("*").alias("n"),
    )


def windows_on_partitions(windows: DataFrame, bounds: DataFrame, window_id: str = "id") -> DataFrame:
    """(<window_id>, pid): every partition whose member bounds a window meets."""
    boxes = windows.select(F.col(window_id), *g.box_columns(geometry_box(windows)))
    pairs = rectangles_in_rectangles(bounds, boxes, object_id="pid", window_id=window_id, mode="mbr")
    return pairs.select(F.col("window_id").alias(window_id), F.col("object_id").alias("pid"))
