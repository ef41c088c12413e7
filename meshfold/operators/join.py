"""Spatial join and distance join.

Results are flat pair tables ``(window_id, object_id)``: a window may match any number of objects,
and a flat table never gathers them in one place. `count_per_window` and `group_per_window` give the
per-window forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.plans.cells import LISTED_CELLS, OBJECT, OBJECT_ID, WINDOW, WINDOW_ID, Limits, cell_join, grouped_cell_join
from meshfold.plans.ranks import counted_points
from meshfold.session import stored

EXACT, MBR = "exact", "mbr"


def _check_mode(mode: str) -> None:
    if mode not in (EXACT, MBR):
        raise ValueError(f"mode must be '{EXACT}' or '{MBR}', not {mode!r}")


def _side(df: DataFrame, id_column: str, id_as: str, prefix: str, b: g.Box, on: Sequence[str], *extra: Column) -> DataFrame:
    return df.select(F.col(id_column).alias(id_as), *g.box_columns(b, prefix), *on, *extra)


def _point_box(x: str, y: str) -> g.Box:
    return g.Box(F.col(x), F.col(x), F.col(y), F.col(y))


def _point_side(df: DataFrame, id_column: str, on: Sequence[str], *extra: Column) -> DataFrame:
    """Objects that are points: the lower left corner is all there is of their bounds."""
    return _side(df, id_column, OBJECT_ID, OBJECT, _point_box("x", "y"), on, *extra).drop("o_xmax", "o_ymax")


def _polygon_side(df: DataFrame, id_column: str, id_as: str, prefix: str, on: Sequence[str], exact: bool) -> DataFrame:
    extra = [F.expr(g.edges("rings")).alias(prefix + "edges")] if exact else []
    return _side(df, id_column, id_as, prefix, g.rings_box("rings"), on, *extra)


def _pairs(joined: DataFrame, on: Sequence[str]) -> DataFrame:
    return joined.select(*on, WINDOW_ID, OBJECT_ID)


def points_in_rectangles(
    points: DataFrame, rectangles: DataFrame, object_id: str = "id", window_id: str = "id",
    on: Sequence[str] = (), limits: Limits = Limits(), grouped: bool = False, counted: bool = False,
) -> DataFrame:
    """Points inside or on each rectangle. ``on``: further columns that must agree, such as a time step.

    With ``grouped``, ``(window_id, most, objects)``: the ids in arrays, several for a window, for `group_per_window`. With ``counted``,
    ``(window_id, hit)``, numbers to be added up by `count_per_window`: of large tables without making the pairs.
    """
    if counted and points.count() * rectangles.count() > limits.counted_pairs:
        return counted_points(points.select(*on, "x", "y"), rectangles.select(*on, F.col(window_id).alias(WINDOW_ID), *g.BOX), on)
    if grouped:
        objects = _point_side(points, object_id, on)
        return grouped_cell_join(objects, _side(rectangles, window_id, WINDOW_ID, WINDOW, g.box(), on), on, limits, _HELD)
    return _pairs(_points_and_rectangles(points, rectangles, object_id, window_id, on, limits), on)


def _points_and_rectangles(points, rectangles, object_id, window_id, on, limits, *extra: Column) -> DataFrame:
    objects = _point_side(points, object_id, on, *extra)
    windows = _side(rectangles, window_id, WINDOW_ID, WINDOW, g.box(), on)
    test = g.box_contains_point(g.box(WINDOW), F.col("o_xmin"), F.col("o_ymin"))
    return cell_join(objects, windows, test, on, limits=limits, settled=F.lit(True))


def count_points_in_rectangles(
    points: DataFrame, rectangles: DataFrame, window_id: str = "id", on: Sequence[str] = (), limits: Limits = Limits(),
) -> DataFrame:
    """``(window_id, n)`` like `count_per_window`, for tables with many equal points.

    Equal points are counted first, with map-side partial counts, and joined once with their number: a place that holds a
    third of all rows becomes a single row. For tables of mostly different points, `count_per_window` saves that shuffle.
    """
    places = points.groupBy(*on, "x", "y").agg(F.count("*").alias("rows"))
    places = places.withColumn("place", F.xxhash64("x", "y"))  # deals crowded cells out; need not be unique
    joined = _points_and_rectangles(places, rectangles, "place", window_id, on, limits, F.col("rows").alias("hit"))
    return _sum_per_window(joined, rectangles, window_id, on)


def rectangles_in_rectangles(
    rectangles: DataFrame, windows: DataFrame, object_id: str = "id", window_id: str = "id",
    mode: str = EXACT, on: Sequence[str] = (), limits: Limits = Limits(),
) -> DataFrame:
    """``exact``: rectangles lying inside each window; ``mbr``: rectangles meeting each window."""
    _check_mode(mode)
    objects = _side(rectangles, object_id, OBJECT_ID, OBJECT, g.box(), on)
    sides = _side(windows, window_id, WINDOW_ID, WINDOW, g.box(), on)
    a, b = g.box(OBJECT), g.box(WINDOW)
    if mode == EXACT:
        joined = cell_join(objects, sides, g.box_contains_box(b, a), on, limits=limits)
    else:
        joined = cell_join(objects, sides, g.boxes_intersect(a, b), on, inside=False, limits=limits)
    return _pairs(joined, on)


def points_in_polygons(
    points: DataFrame, polygons: DataFrame, object_id: str = "id", window_id: str = "id",
    mode: str = EXACT, on: Sequence[str] = (), limits: Limits = Limits(),
) -> DataFrame:
    """``exact``: points strictly inside each polygon; ``mbr``: points inside or on its bounding box."""
    _check_mode(mode)
    objects = _point_side(points, object_id, on)
    windows = _polygon_side(polygons, window_id, WINDOW_ID, WINDOW, on, mode == EXACT)
    x, y = F.col("o_xmin"), F.col("o_ymin")
    test = g.box_contains_point(g.box(WINDOW), x, y)
    if mode == MBR:
        return _pairs(cell_join(objects, windows, test, on, limits=limits), on)
    test = test & (F.col("w_whole") | F.expr(g.flat_edges_contain_point("w_edge", "o_xmin", "o_ymin")))
    joined = cell_join(objects, windows, test, on, limits=limits, halvings=_POLYGON_HALVINGS, per_cell=_flat_polygon_in_cell(), settled=F.col("w_whole"))
    return _pairs(joined, on)


# Polygons are cut into cells of a half to an eighth of their extent, of which many are clear of edges.
_POLYGON_HALVINGS = 3


def _polygon_in_cell(reach: tuple[float, float] = (0.0, 0.0)) -> tuple[list[str], g.Sql]:
    """Settles what a cell can settle for all its points, or for objects with their lower left corner in it that reach no further than ``reach``.

    A cell that no edge meets lies wholly inside the polygon (``w_whole``: no further test), or wholly outside (no row). The
    others keep only the edges that meet an object, or a ray to the right, cast from within the cell. The cell is widened
    a little for the first test, so that rounding cannot overlook an edge.
    """
    return ["w_edges"], g.bind_sql(_reached("cell_", reach), "cell_", _settled_by_cell())


def _flat_polygon_in_cell() -> tuple[list[str], g.Sql]:
    """The same with the first edges in columns of their own, for tests of points."""
    replaced, rows = _polygon_in_cell()
    columns = {"w_whole": "r_.w_whole"} | g.flat_edges("r_.w_edges", "w_edge")
    return replaced, f"transform({rows}, r_ -> named_struct({', '.join(f'{name!r}, {value}' for name, value in columns.items())}))"


def _reached(cell: g.Sql, reach: tuple[float, float]) -> g.Sql:
    """The bounds ``cell`` with room for objects that begin in it."""
    return (f"named_struct('xmin', {cell}.xmin, 'xmax', {cell}.xmax + {g.number(reach[0])},"
            f" 'ymin', {cell}.ymin, 'ymax', {cell}.ymax + {g.number(reach[1])})")


def _settled_by_cell() -> g.Sql:
    pad = "(cell_.xmax - cell_.xmin) * 1e-6D"
    wide = (f"named_struct('xmin', cell_.xmin - {pad}, 'xmax', cell_.xmax + {pad},"
            f" 'ymin', cell_.ymin - {pad}, 'ymax', cell_.ymax + {pad})")
    met = f"exists(w_edges, o_ -> {g.edge_meets_box('o_', 'wide_.xmin', 'wide_.xmax', 'wide_.ymin', 'wide_.ymax')})"
    center = ("((cell_.xmin + cell_.xmax) / 2)", "((cell_.ymin + cell_.ymax) / 2)")
    facing = ("filter(w_edges, e_ -> greatest(e_.y1, e_.y2) >= cell_.ymin AND least(e_.y1, e_.y2) <= cell_.ymax"
              " AND greatest(e_.x1, e_.x2) >= cell_.xmin)")
    none = "slice(w_edges, 1, 0)"
    rows = (
        f"CASE WHEN {g.bind_sql(wide, 'wide_', met)} THEN array(named_struct('w_whole', false, 'w_edges', {facing}))"
        f" WHEN {g.polygon_contains_point('w_edges', *center)} THEN array(named_struct('w_whole', true, 'w_edges', {none}))"
        f" ELSE slice(array(named_struct('w_whole', true, 'w_edges', {none})), 1, 0) END"
    )
    return rows


_FAR = 1e100  # objects that reach further aren't told apart by cells


def _reach(objects: DataFrame, low: g.Box) -> tuple[float, float] | None:
    """The greatest extents of the objects with bounds ``low``, and a little more, or None if these know no end."""
    sides = ((low.xmax, low.xmin), (low.ymax, low.ymin))
    found = objects.agg(*(F.max((b - a) * (1 + 1e-9) + (F.abs(a) + F.abs(b)) * 1e-12) for b, a in sides)).first()
    found = tuple(v or 0.0 for v in found)
    return found if all(v < _FAR for v in found) else None  # nor NaN


def polygons_in_polygons(
    polygons: DataFrame, windows: DataFrame, object_id: str = "id", window_id: str = "id",
    mode: str = EXACT, on: Sequence[str] = (), limits: Limits = Limits(),
) -> DataFrame:
    """``exact``: polygons lying inside each window polygon; ``mbr``: bounding boxes that meet."""
    _check_mode(mode)
    exact = mode == EXACT
    objects = _polygon_side(polygons, object_id, OBJECT_ID, OBJECT, on, exact)
    sides = _polygon_side(windows, window_id, WINDOW_ID, WINDOW, on, exact)
    a, b = g.box(OBJECT), g.box(WINDOW)
    if not exact:
        return _pairs(cell_join(objects, sides, g.boxes_intersect(a, b), on, inside=False, limits=limits), on)
    test = g.box_contains_box(b, a) & F.expr(g.polygon_contains_polygon("w_edges", "o_edges", OBJECT))
    reach = _reach(objects, a)
    if reach is None:
        return _pairs(cell_join(objects, sides, test, on, limits=limits), on)
    joined = cell_join(objects, sides, F.col("w_whole") | test, on, limits=limits, halvings=_POLYGON_HALVINGS, per_cell=_polygon_in_cell(reach), settled=F.col("w_whole"))
    return _pairs(joined, on)


# Widens the box a circle is indexed by, so that rounding of ``x - r`` cannot lose a pair.
_PAD = 1e-9


def distance_join(
    points: DataFrame, centers: DataFrame, radius: float | str, object_id: str = "id", window_id: str = "id",
    mode: str = EXACT, on: Sequence[str] = (), limits: Limits = Limits(),
) -> DataFrame:
    """Points near each centre: ``exact`` strictly within the radius, ``mbr`` within the circle's closed box.

    ``radius`` is a number, or the name of a column of ``centers``. A self-join reports each point with itself.
    """
    _check_mode(mode)
    r = F.col(radius) if isinstance(radius, str) else F.lit(float(radius))
    x, y = F.col("x"), F.col("y")
    pad = (F.abs(x) + F.abs(y) + r) * _PAD
    objects = _point_side(points, object_id, on)
    windows = _side(
        centers, window_id, WINDOW_ID, WINDOW, g.circle_box(x, y, r + pad), on,
        x.alias("w_x"), y.alias("w_y"), r.alias("w_r"),
    )
    px, py, cx, cy, cr = (F.col(c) for c in ("o_xmin", "o_ymin", "w_x", "w_y", "w_r"))
    if mode == EXACT:
        test = g.box_contains_point(g.box(WINDOW), px, py) & g.circle_contains_point(cx, cy, cr, px, py)
    else:
        test = g.box_contains_point(g.circle_box(cx, cy, cr), px, py)
    return _pairs(cell_join(objects, windows, test, on, limits=limits), on)


# ---------------------------------------------------------------- per-window results

def count_per_window(pairs: DataFrame, windows: DataFrame, window_id: str = "id", on: Sequence[str] = ()) -> DataFrame:
    """``(window_id, n)``; windows without matches are kept with n = 0. ``pairs`` are rows (window_id, object_id), or the counted join's (window_id, hit).

    One shuffle, of partial counts only: each window adds a zero to its own group instead of being joined.
    """
    hits = pairs if "hit" in pairs.columns else pairs.withColumn("hit", F.lit(1).cast("bigint"))
    return _sum_per_window(hits, windows, window_id, on)


def _sum_per_window(hits: DataFrame, windows: DataFrame, window_id: str, on: Sequence[str]) -> DataFrame:
    hits = hits.select(*on, WINDOW_ID, "hit")
    zeros = windows.select(*on, F.col(window_id).alias(WINDOW_ID), F.lit(0).cast("bigint").alias("hit"))
    return hits.unionByName(zeros).groupBy(*on, WINDOW_ID).agg(F.sum("hit").alias("n"))


# Ids of a window that are put into one value; a window with more is dealt into groups first.
_HELD = 100_000
_FEW_GROUPS = 64


def group_per_window(
    pairs: DataFrame, windows: DataFrame, window_id: str = "id", chunk: int = 100_000,
) -> DataFrame:
    """``(window_id, part, objects, n)``: the set of object ids of each window, in parts of about ``chunk`` ids.

    ``pairs`` are rows (window_id, object_id), or the grouped join's (window_id, most, objects) with arrays of ids; these aren't stored but
    joined once more for windows that may have very many. A window's ids are gathered and cut into parts; one with very many is first dealt into groups by a hash
    of the object id, so that no task has to hold its whole set. A window without matches has one empty part.
    """
    if "objects" not in pairs.columns:
        pairs = stored(pairs.where(F.col(OBJECT_ID).isNotNull()), "pairs")  # read twice, joined once
        pairs = pairs.select(WINDOW_ID, F.lit(None).cast("bigint").alias("most"), F.array(OBJECT_ID).alias("objects"))
    may = F.col("most").isNull() | (F.col("most") > max(chunk, _HELD))
    sizes = pairs.where(may).groupBy(WINDOW_ID).agg(F.sum(F.size("objects")).alias("total"))
    crowded = stored(sizes.where(F.col("total") > max(chunk, _HELD)), "crowded-windows")
    n = crowded.count()
    one = F.lit(1).cast("bigint")
    if n:
        crowded = F.broadcast(crowded) if n <= LISTED_CELLS else crowded  # the ids of a crowded window then stay where they are
        dealt = pairs.join(crowded, WINDOW_ID, "left").withColumn("groups", F.coalesce(F.ceil(F.col("total") / max(chunk, _HELD)), one))
        few = F.expr("transform(sequence(0L, groups - 1), k -> named_struct('group', k, 'objects', filter(objects, o -> pmod(xxhash64(o), groups) = k)))")
        each = F.expr("transform(objects, o -> named_struct('group', pmod(xxhash64(o), groups), 'objects', array(o)))")
        alone = F.expr("array(named_struct('group', 0L, 'objects', objects))")
        dealt = dealt.select(
            WINDOW_ID, F.coalesce("total", F.lit(0).cast("bigint")).alias("total"),
            F.inline(F.when(F.col("groups") == 1, alone).when(F.col("groups") <= _FEW_GROUPS, few).otherwise(each)),
        ).where("group = 0 OR size(objects) > 0")
    else:
        dealt = pairs.select(WINDOW_ID, F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("group"), "objects")
    empty = windows.select(
        F.col(window_id).alias(WINDOW_ID), F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("group"),
        F.array().cast(pairs.schema["objects"].dataType).alias("objects"),
    )
    # One shuffle, by the window alone if its ids fit a task: what is grouped by window afterwards stays where it is.
    rows = dealt.unionByName(empty).repartition(WINDOW_ID, *(["group"] if n else []))
    ids = F.array_distinct(F.flatten(F.collect_list("objects")))
    whole = rows.groupBy(WINDOW_ID, "group").agg(F.sort_array(ids).alias("all"), F.max("total").alias("total"))
    # A dealt group may be a little over the size asked for, and is no reason for another part.
    most = F.when(F.col("total") > 0, F.lit(int(chunk * 1.1) if chunk >= _HELD else chunk)).otherwise(F.lit(chunk))
    parts = F.greatest(F.ceil(F.size("all") / most), one)
    cut = whole.withColumn("parts", parts).withColumn("size", F.ceil(F.size("all") / F.col("parts")).cast("int"))
    piece = F.posexplode(F.expr("transform(sequence(1, cast(parts AS int)), i -> slice(all, (i - 1) * size + 1, size))")).alias("i", "objects")
    numbered = cut.select(WINDOW_ID, (F.col("group") * (F.ceil(F.col("total") / chunk) + 1)).alias("first"), piece)
    return numbered.select(
        WINDOW_ID, (F.col("first") + F.col("i")).cast("bigint").alias("part"), "objects", F.size("objects").cast("bigint").alias("n"))


def distinct_geometry(df: DataFrame, columns: Sequence[str], id_column: str = "id") -> DataFrame:
    """One row per distinct geometry, that of the smallest id, for results keyed by value instead of by id."""
    others = [c for c in df.columns if c not in columns and c != id_column]
    least = df.groupBy(*columns).agg(F.min(F.struct(id_column, *others)).alias("least_"))
    return least.select(*(F.col(c) if c in columns else F.col("least_")[c].alias(c) for c in df.columns))
