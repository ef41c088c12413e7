"""What polygons cover of each other's edges, found in cells that get finer only where the outline of their union may be.

All polygons enter a grid of about their size. A cell that lies wholly inside a polygon is settled: every edge in it is covered there, and whatever
is in it hangs together. Other crowded cells are cut into sixteen, as long as that leaves fewer pairs to test, so the crowd inside the
union is never paired. In the cells that remain, each edge's stretch is cut by the others' edges there, and its pieces are judged
by a point halfway along them. A row holds the edges that a ray to the right from within its cell can meet, no others.

Cells overlap by a little, so stretches of one edge in neighbouring cells do too, and rounding leaves no gap between them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.plans import cells
from meshfold.plans.cells import LISTED_CELLS, OBJECT_ID, WINDOW, WINDOW_ID, Limits
from meshfold.session import stored

_PAD = 1e-6  # of a cell's side: how far cells overlap
_FINEST = 2.0**-26  # the smallest side, as a share of the largest coordinate: its overlap is far above rounding
_CROWD = 16  # polygons in a cell that isn't cut further
_PAYS = 0.75  # cutting a cell has to leave this share of its pairs at most
_MOST_CELLS = 9  # on average, that a polygon covers on the first grid
_MOST_MOVES = 3
_WIDE = ("xmin", "xmax", "ymin", "ymax")


def _wide(tier: int) -> g.Sql:
    side, pad = g.number(4.0**tier), g.number(4.0**tier * _PAD)
    return (f"named_struct('xmin', cell_x * {side} - {pad}, 'xmax', (cell_x + 1) * {side} + {pad},"
            f" 'ymin', cell_y * {side} - {pad}, 'ymax', (cell_y + 1) * {side} + {pad})")


def _here(e: g.Sql) -> g.Sql:
    return g.edge_meets_box(e, *(f"wide_.{b}" for b in _WIDE))


def _in_cells(polygons: DataFrame, tier: int, within: int | None = None) -> DataFrame:
    """One row per polygon and cell that it has an edge in, or covers (``covers``). ``within``: the tier of the cell the rows are in now."""
    side = g.number(4.0**tier)

    def covered(axis: str) -> g.Sql:
        low, high = f"floor({axis}min / {side})", f"floor({axis}max / {side})"
        if within is not None:
            low, high = f"greatest({low}, cell_{axis} * 4)", f"least({high}, cell_{axis} * 4 + 3)"
        return f"sequence({low}, {high})"

    pairs = f"flatten(transform({covered('x')}, i_ -> transform({covered('y')}, j_ -> named_struct('cell_x', i_, 'cell_y', j_))))"
    facing = ("filter(w_edges, e_ -> greatest(e_.y1, e_.y2) >= wide_.ymin AND least(e_.y1, e_.y2) <= wide_.ymax"
              " AND greatest(e_.x1, e_.x2) >= wide_.xmin)")
    center = ("((wide_.xmin + wide_.xmax) / 2)", "((wide_.ymin + wide_.ymax) / 2)")
    none = "slice(near_, 1, 0)"
    rows = (
        f"CASE WHEN exists(near_, o_ -> {_here('o_')}) THEN array(named_struct('covers', false, 'w_edges', near_))"
        f" WHEN {g.polygon_contains_point('near_', *center)} THEN array(named_struct('covers', true, 'w_edges', {none}))"
        f" ELSE slice(array(named_struct('covers', true, 'w_edges', {none})), 1, 0) END"
    )
    own = ["id", *_WIDE, "size", "crowd"]
    placed = polygons.select(*own, "w_edges", F.inline(F.expr(pairs)))
    return placed.select(*own, "cell_x", "cell_y", F.inline(F.expr(g.bind_sql(_wide(tier), "wide_", g.bind_sql(facing, "near_", rows)))))


def _first_tier(polygons: DataFrame) -> tuple[int, int]:
    """Tier of the first grid, and of the finest one."""
    b = g.box()
    size = F.greatest(*(F.abs(c) for c in b))
    found = polygons.groupBy(cells._tier(b).alias("tier")).agg(F.count("*").alias("n"), F.max(size).alias("far")).collect()
    tiers = {r["tier"]: r["n"] for r in found if r["tier"] is not None}
    if not tiers:
        return 0, 0
    far = min(max(r["far"] for r in found), cells._LARGEST)
    finest = max(math.ceil(math.log2(far * _FINEST) / 2), cells._MIN_TIER) if far > 0 else cells._MIN_TIER
    first = largest = max(*tiers, finest)
    while first > finest and largest - first < _MOST_MOVES:
        if sum(n * (4.0 ** (t - first + 1) + 1) ** 2 for t, n in tiers.items()) > _MOST_CELLS * sum(tiers.values()):
            break
        first -= 1
    return first, finest


def _fates(found: DataFrame, tier: int, finest: int) -> DataFrame:
    """(cell_x, cell_y, low, high, n, fate) of each cell: covered, cut, leaf, or back if its parent wasn't worth cutting."""
    low, high = (f(F.when(F.col("covers"), F.col("id"))) for f in (F.min, F.max))
    n = F.count(F.when(~F.col("covers"), 1))
    each = found.groupBy("cell_x", "cell_y").agg(
        low.alias("low"), high.alias("high"), n.alias("n"), F.avg(F.when(~F.col("covers"), F.col("size"))).alias("typical"), F.max("crowd").alias("crowd"))
    each = stored(each.withColumns({"up_x": F.shiftright("cell_x", 2), "up_y": F.shiftright("cell_y", 2)}), "union-cell-sums")
    left = F.sum(F.when(F.col("low").isNull(), F.col("n").cast("double") * F.col("n")).otherwise(0.0))
    paid = F.col("crowd").isNull() | (F.col("left") <= _PAYS * F.col("crowd") * F.col("crowd"))
    parents = each.groupBy("up_x", "up_y").agg(left.alias("left"), F.max("crowd").alias("crowd")).select("up_x", "up_y", paid.alias("paid"))
    fate = (F.when(~F.col("paid"), "back").when(F.col("low").isNotNull(), "covered")
            .when((F.col("n") > _CROWD) & F.lit(tier > finest), "cut").otherwise("leaf"))
    # Cells larger than half the polygons in them are cut in any case.
    crowd = F.when(F.col("typical") / 2 >= 4.0**tier, F.col("n").cast("double"))
    judged = each.drop("crowd").join(parents, ["up_x", "up_y"])
    return stored(judged.select("cell_x", "cell_y", "up_x", "up_y", "low", "high", crowd.alias("crowd"), fate.alias("fate")), "union-cell-fates")


def _settled(shapes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leaves (cell, polygon, its edges), stretches in covered cells, and links between polygons that cover one cell."""
    polygons = shapes.where(" AND ".join(f"{c} IS NOT NULL" for c in ("id", *_WIDE))).select(
        "id", *_WIDE, F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")).alias("size"), F.lit(None).cast("double").alias("crowd"),
        F.expr("transform(edges, (e_, i_) -> named_struct('edge', i_, 'x1', e_.x1, 'y1', e_.y1, 'x2', e_.x2, 'y2', e_.y2))").alias("w_edges"))
    tier, finest = _first_tier(polygons)
    leaves, stretches, links = [], [], []
    rows, found = None, stored(_in_cells(polygons, tier), "union-cells")
    other = F.expr("CASE WHEN low <> id THEN low WHEN high <> id THEN high END").alias("other")

    def leaf(df: DataFrame, at: int) -> DataFrame:
        return df.select(F.lit(at).alias("cell_tier"), "cell_x", "cell_y", "id", *_WIDE, "w_edges", F.expr(_wide(at)).alias("wide_"))

    while True:
        fates = _fates(found, tier, finest)
        counts = {r["fate"]: r["count"] for r in fates.groupBy("fate").count().collect()}
        listed = F.broadcast if sum(counts.values()) <= LISTED_CELLS else (lambda df: df)

        def having(fate: str) -> DataFrame:
            cells_ = fates.where(F.col("fate") == fate).select("cell_x", "cell_y", "low", "high", F.col("crowd").alias("next"))
            return found.join(listed(cells_), ["cell_x", "cell_y"])

        leaves.append(leaf(having("leaf"), tier))
        if rows is not None and counts.get("back"):
            back = fates.where("fate = 'back'").select(F.col("up_x").alias("cell_x"), F.col("up_y").alias("cell_y")).distinct()
            leaves.append(leaf(rows.join(listed(back), ["cell_x", "cell_y"]), tier + 1))
        if counts.get("covered"):
            inside = having("covered").select("id", other, "covers", "w_edges", F.expr(_wide(tier)).alias("wide_")).where("other IS NOT NULL")
            edges = inside.where("NOT covers").select("id", "other", F.inline(F.expr(_clipped())))
            stretches.append(edges.where("low < high").select("id", "e.edge", "other", F.col("low").alias("t0"), F.col("high").alias("t1"), F.lit(False).alias("kept")))
            links.append(inside.where("covers").select("id", "other"))
        if not counts.get("cut"):
            break
        rows = having("cut").select("id", *_WIDE, "size", F.col("next").alias("crowd"), "cell_x", "cell_y", "w_edges")
        tier -= 1
        found = stored(_in_cells(rows, tier, tier + 1), "union-cells")
    if not links:
        links.append(polygons.select("id", F.col("id").alias("other")).limit(0))
    return reduce(DataFrame.unionByName, leaves), reduce(DataFrame.unionByName, stretches) if stretches else None, reduce(DataFrame.unionByName, links)


def _clipped() -> g.Sql:
    """Array of (e, low, high): the edges of ``w_edges`` that meet the cell ``wide_``, and the positions between which they lie in it."""
    at = {a: [f"(wide_.{a}{m} - e_.{a}1) / nullif(e_.{a}2 - e_.{a}1, 0D)" for m in ("min", "max")] for a in "xy"}
    low = f"greatest(0D, {', '.join(f'least({p}, {q})' for p, q in at.values())})"
    high = f"least(1D, {', '.join(f'greatest({p}, {q})' for p, q in at.values())})"
    return f"transform(filter(w_edges, o_ -> {_here('o_')}), e_ -> named_struct('e', e_, 'low', {low}, 'high', {high}))"


def _pieces() -> g.Sql:
    """Array of (t0, t1, kept): the pieces of ``e`` between ``low`` and ``high`` that the polygon of ``w_edges`` covers or runs along."""
    x, y = g.middle("e", "s_")
    cuts = f"flatten(transform(w_edges, o_ -> {g.cut_positions('e', 'o_')}))"
    runs = f"filter(transform(w_edges, o_ -> {g.shared_run('e', 'o_')}), r_ -> r_ IS NOT NULL)"
    ends = "concat(array(low, high), cuts_, transform(runs_, r_ -> r_.t0), transform(runs_, r_ -> r_.t1))"
    ts = f"array_sort(array_distinct(filter({ends}, t_ -> t_ >= low AND t_ <= high)))"
    along = "filter(runs_, r_ -> (s_.t0 + s_.t1) / 2 BETWEEN r_.t0 AND r_.t1)"
    kept = (f"CASE WHEN size(along_) > 0 THEN exists(along_, r_ -> r_.heading > 0) AND object_id.id < window_id"
            f" WHEN {g.polygon_contains_point('w_edges', x, y)} THEN false END")
    judged = g.bind_sql(along, "along_", f"named_struct('t0', s_.t0, 't1', s_.t1, 'kept', {kept})")
    cut = "transform(slice(ts_, 1, size(ts_) - 1), (t_, i_) -> named_struct('t0', t_, 't1', get(ts_, i_ + 1)))"
    pieces = g.bind_sql(ts, "ts_", f"filter(transform({cut}, s_ -> {judged}), s_ -> s_.kept IS NOT NULL)")
    return g.bind_sql(runs, "runs_", g.bind_sql(cuts, "cuts_", pieces))


def covered_stretches(shapes: DataFrame, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """(id, edge, other, t0, t1, kept): stretches of each edge that other polygons cover, one of them named; and (id, other): further links.

    ``shapes`` holds id, edges and bounds. ``kept`` marks stretches along a shared edge that stay with this polygon; they still connect the two. Polygons
    that overlap or share a stretch are connected by the two tables' ids, directly or by way of others.
    """
    leaves, settled, links = _settled(shapes)
    leaves = stored(leaves, "union-leaves")
    key = ["cell_tier", "cell_x", "cell_y"]
    left = leaves.select(*key, "id", F.inline(F.expr(_clipped()))).where("low < high")
    left = left.select(*key, F.struct("id", F.col("e.edge").alias("edge")).alias(OBJECT_ID), "e", "low", "high")
    right = leaves.select(*key, F.col("id").alias(WINDOW_ID), *g.box_columns(g.box(), WINDOW), "w_edges")
    e = F.col("e")
    edge_box = g.Box(*(f(e[f"{a}1"], e[f"{a}2"]) for a in "xy" for f in (F.least, F.greatest)))
    meets = (F.col(OBJECT_ID)["id"] != F.col(WINDOW_ID)) & g.boxes_intersect(edge_box, g.box(WINDOW))
    weight = cells._total_weight(right, WINDOW)
    joined = cells.dealt_join(left, weight, right, weight, key, (), meets, limits)
    found = joined.select(OBJECT_ID, WINDOW_ID, F.inline(F.expr(_pieces())))
    found = found.select(F.col(OBJECT_ID)["id"].alias("id"), F.col(OBJECT_ID)["edge"].alias("edge"), F.col(WINDOW_ID).alias("other"), "t0", "t1", "kept")
    return stored(found if settled is None else found.unionByName(settled), "union-stretches"), links
