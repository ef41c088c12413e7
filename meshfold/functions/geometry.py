"""Geometry as Column expressions: predicates, measures and projections, no UDF.

Conventions
-----------
point      two DOUBLE columns ``x, y``
rectangle  four DOUBLE columns ``xmin, xmax, ymin, ymax`` (closed on all sides)
circle     ``cx, cy, radius``
polygon    ``rings ARRAY<ARRAY<STRUCT<x, y>>>``, ring 0 the shell, the others holes, each ring closed;
           exact tests read an array of edges ``STRUCT<x1, y1, x2, y2>``, made once per polygon by `edges`
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    """The four bounds of a rectangle, as Columns."""

    xmin: Column
    xmax: Column
    ymin: Column
    ymax: Column


BOX = ("xmin", "xmax", "ymin", "ymax")


def box(prefix: str = "") -> Box:
    """The bounds held in the columns ``<prefix>xmin`` .. ``<prefix>ymax``."""
    return Box(*(F.col(prefix + name) for name in BOX))


def window_box(window: tuple[float, float, float, float]) -> Box:
    """A literal query window ``(xmin, xmax, ymin, ymax)``; corners may come in any order."""
    x1, x2, y1, y2 = (float(v) for v in window)
    return Box(*(F.lit(v) for v in (min(x1, x2), max(x1, x2), min(y1, y2), max(y1, y2))))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# ---------------------------------------------------------------- distances

def point_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def box_distance(b: Box, x: Column, y: Column) -> Column:
    """0 inside or on the rectangle, else the distance to its nearest point."""
    dx = F.greatest(b.xmin - x, F.lit(0.0), x - b.xmax)
    dy = F.greatest(b.ymin - y, F.lit(0.0), y - b.ymax)
    return F.sqrt(dx * dx + dy * dy)


def box_far_distance(b: Box, x: Column, y: Column) -> Column:
    """Distance to the farthest corner: an upper bound for anything inside the rectangle."""
    dx = F.greatest(F.abs(b.xmin - x), F.abs(b.xmax - x))
    dy = F.greatest(F.abs(b.ymin - y), F.abs(b.ymax - y))
    return F.sqrt(dx * dx + dy * dy)


# ---------------------------------------------------------------- circle and rectangle predicates

def circle_contains_point(cx: Column, cy: Column, radius: Column, x: Column, y: Column) -> Column:
    """Strictly inside."""
    return point_distance(cx, cy, x, y) < radius


def circle_intersects_point(cx: Column, cy: Column, radius: Column, x: Column, y: Column) -> Column:
    """Inside or on the circle."""
    return point_distance(cx, cy, x, y) <= radius


def circle_intersects_box(cx: Column, cy: Column, radius: Column, b: Box) -> Column:
    """The nearest point of the rectangle is at most one radius away."""
    dx = F.greatest(b.xmin - cx, F.lit(0.0), cx - b.xmax)
    dy = F.greatest(b.ymin - cy, F.lit(0.0), cy - b.ymax)
    return dx * dx + dy * dy <= radius * radius


def box_contains_point(b: Box, x: Column, y: Column) -> Column:
    return (x >= b.xmin) & (x <= b.xmax) & (y >= b.ymin) & (y <= b.ymax)


def box_contains_box(outer: Box, inner: Box) -> Column:
    return (
        (inner.xmin >= outer.xmin) & (inner.xmax <= outer.xmax)
        & (inner.ymin >= outer.ymin) & (inner.ymax <= outer.ymax)
    )


def boxes_intersect(a: Box, b: Box) -> Column:
    """Closed: rectangles that only touch do intersect."""
    return (a.xmin <= b.xmax) & (a.xmax >= b.xmin) & (a.ymin <= b.ymax) & (a.ymax >= b.ymin)


# ---------------------------------------------------------------- polygons
#
# These need lambdas within lambdas. They take and pass on SQL text, so that an expression is parsed in one go instead
# of being put together by thousands of calls. An operand is the SQL text of an array of edges, an edge or a number.

Sql = str


def number(value: float) -> Sql:
    return f"({float(value)!r}D)"


def bind_sql(value: Sql, name: str, body: Sql) -> Sql:
    """``body`` with ``name`` standing for ``value``, which is evaluated once per row."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def edges(rings: Sql) -> Sql:
    """All edges of all rings, in ring order."""
    return (
        f"flatten(transform({rings}, ring_ -> transform(slice(ring_, 1, size(ring_) - 1), (p_, i_) -> named_struct("
        "'x1', p_.x, 'y1', p_.y, 'x2', get(ring_, i_ + 1).x, 'y2', get(ring_, i_ + 1).y))))"
    )


def over_edges(rings: Sql, body: Sql) -> Sql:
    """``body``, in which ``edges_`` stands for the edges of ``rings``."""
    return bind_sql(edges(rings), "edges_", body)


def closed_ring(ring: Sql) -> Sql:
    """The ring with its first vertex repeated at the end, unless it is there already."""
    first, last = f"get({ring}, 0)", f"get({ring}, size({ring}) - 1)"
    return (f"CASE WHEN {first}.x <> {last}.x OR {first}.y <> {last}.y THEN concat({ring}, array({first})) ELSE {ring} END")


def signed_area2(ring: Sql) -> Sql:
    """Twice the area of a ring; positive when it runs counter-clockwise."""
    terms = (f"transform(slice({ring}, 1, size({ring}) - 1), (p_, i_) -> "
             f"p_.x * get({ring}, i_ + 1).y - get({ring}, i_ + 1).x * p_.y)")
    return f"aggregate({terms}, 0D, (total_, v_) -> total_ + v_)"


def rings_box(rings: Sql) -> Box:
    """Bounds of the shell."""
    return Box(*(F.expr(f"array_{pick}(transform(get({rings}, 0), p_ -> p_.{axis}))")
                 for axis, pick in (("x", "min"), ("x", "max"), ("y", "min"), ("y", "max"))))


def _cross(e: Sql, x: Sql, y: Sql) -> Sql:
    """Positive when (x, y) lies left of the directed edge, 0 when on its line."""
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({x} - {e}.x1) * ({e}.y2 - {e}.y1))"


def _in_edge_box(e: Sql, x: Sql, y: Sql) -> Sql:
    return (f"({x} >= least({e}.x1, {e}.x2) AND {x} <= greatest({e}.x1, {e}.x2)"
            f" AND {y} >= least({e}.y1, {e}.y2) AND {y} <= greatest({e}.y1, {e}.y2))")


def _edge_meets_bounds(e: Sql, xmin: Sql, xmax: Sql, ymin: Sql, ymax: Sql) -> Sql:
    return (f"(least({e}.x1, {e}.x2) <= {xmax} AND greatest({e}.x1, {e}.x2) >= {xmin}"
            f" AND least({e}.y1, {e}.y2) <= {ymax} AND greatest({e}.y1, {e}.y2) >= {ymin})")


def _ray_step(e: Sql, x: Sql, y: Sql, crossed: Sql, kept: Sql, on_edge: Sql) -> Sql:
    """The ray from (x, y) to the right meets an edge: ``crossed``; it does not: ``kept``; the edge holds the point: ``on_edge``.

    The side test uses the sign of the cross product, so nothing is divided.
    """
    return (
        f"CASE WHEN least({e}.y1, {e}.y2) > {y} OR greatest({e}.y1, {e}.y2) < {y} THEN {kept}"
        f" WHEN {_cross(e, x, y)} = 0 AND {_in_edge_box(e, x, y)} THEN {on_edge}"
        f" WHEN ({e}.y1 > {y}) <> ({e}.y2 > {y}) AND ({_cross(e, x, y)} > 0) = ({e}.y2 > {e}.y1) THEN {crossed}"
        f" ELSE {kept} END"
    )


def polygon_contains_point(polygon_edges: Sql, x: Sql, y: Sql) -> Sql:
    """Strictly inside: an odd number of crossings. A point on an edge makes the count null, and is not contained."""
    step = _ray_step("e_", x, y, "n_ + 1", "n_", "CAST(NULL AS INT)")
    return f"coalesce(aggregate({polygon_edges}, 0, (n_, e_) -> {step}) % 2 = 1, false)"


def few_edges_contain_point(polygon_edges: Sql, x: Sql, y: Sql, few: int = 4) -> Sql:
    """`polygon_contains_point`, written out for up to ``few`` edges: compiled code instead of a lambda per edge."""
    terms = []
    for i in range(few):
        e = f"get({polygon_edges}, {i})"
        terms.append(f"CASE WHEN size({polygon_edges}) <= {i} THEN 0 ELSE {_ray_step(e, x, y, '1', '0', 'CAST(NULL AS INT)')} END")
    return (f"CASE WHEN size({polygon_edges}) <= {few} THEN coalesce(({' + '.join(terms)}) % 2 = 1, false)"
            f" ELSE {polygon_contains_point(polygon_edges, x, y)} END")


FLAT_EDGES = 4  # of more, the test is too long to be compiled


def flat_edges(polygon_edges: Sql, prefix: str) -> dict[str, Sql]:
    """Columns for `flat_edges_contain_point`: the number of edges, the numbers of the first few, and the edges as they are if there are more."""
    columns = {f"{prefix}n": f"coalesce(size({polygon_edges}), 0)"}
    columns |= {f"{prefix}{i}_{c}": f"coalesce(get({polygon_edges}, {i}).{c}, 0D)" for i in range(FLAT_EDGES) for c in ("x1", "y1", "x2", "y2")}
    return columns | {f"{prefix}s": f"CASE WHEN size({polygon_edges}) <= {FLAT_EDGES} THEN slice({polygon_edges}, 1, 0) ELSE {polygon_edges} END"}


def flat_edges_contain_point(prefix: str, x: Sql, y: Sql) -> Sql:
    """`polygon_contains_point` by the columns of `flat_edges`: for a few edges plain arithmetic."""
    terms = []
    for e in (f"{prefix}{i}" for i in range(FLAT_EDGES)):
        step = _ray_step(e, x, y, "1", "0", "CAST(NULL AS INT)").replace(f"{e}.", f"{e}_")
        terms.append(f"CASE WHEN {prefix}n <= {len(terms)} THEN 0 ELSE {step} END")
    return (f"CASE WHEN {prefix}n <= {FLAT_EDGES} THEN coalesce(({' + '.join(terms)}) % 2 = 1, false)"
            f" ELSE {polygon_contains_point(f'{prefix}s', x, y)} END")


def polygon_covers_point(polygon_edges: Sql, x: Sql, y: Sql) -> Sql:
    """Inside or on the boundary: here a point on an edge has a null count too, but counts as covered. Null without edges."""
    step = _ray_step("e_", x, y, "n_ + 1", "n_", "CAST(NULL AS INT)")
    return f"CASE WHEN {polygon_edges} IS NOT NULL THEN coalesce(aggregate({polygon_edges}, 0, (n_, e_) -> {step}) % 2 = 1, true) END"


def polygon_distance(polygon_edges: Sql, x: Sql, y: Sql) -> Sql:
    """0 when the polygon covers the point, else the distance to its nearest edge."""
    length2 = "((e_.x2 - e_.x1) * (e_.x2 - e_.x1) + (e_.y2 - e_.y1) * (e_.y2 - e_.y1))"
    along = (f"CASE WHEN {length2} > 0 THEN (({x} - e_.x1) * (e_.x2 - e_.x1) + ({y} - e_.y1) * (e_.y2 - e_.y1))"
             f" / nullif({length2}, 0D) ELSE 0D END")
    dx, dy = (f"(e_.{a}1 + t_ * (e_.{a}2 - e_.{a}1) - {v})" for a, v in (("x", x), ("y", y)))
    to_edge = bind_sql(f"least(greatest({along}, 0D), 1D)", "t_", f"sqrt({dx} * {dx} + {dy} * {dy})")
    nearest = f"array_min(transform({polygon_edges}, e_ -> {to_edge}))"
    return f"CASE WHEN {polygon_covers_point(polygon_edges, x, y)} THEN 0D ELSE {nearest} END"


def edge_meets_box(e: Sql, xmin: Sql, xmax: Sql, ymin: Sql, ymax: Sql) -> Sql:
    """Closed: the bounding boxes meet, and the line does not pass the rectangle by on one side."""
    corners = ", ".join(_cross(e, x, y) for x in (xmin, xmax) for y in (ymin, ymax))
    return (f"({_edge_meets_bounds(e, xmin, xmax, ymin, ymax)}"
            f" AND NOT (least({corners}) > 0 OR greatest({corners}) < 0))")


def polygon_intersects_box(polygon_edges: Sql, xmin: Sql, xmax: Sql, ymin: Sql, ymax: Sql) -> Sql:
    """Closed: an edge meets the rectangle, or the whole rectangle lies inside the polygon."""
    meets = edge_meets_box("o_", xmin, xmax, ymin, ymax)
    return f"exists({polygon_edges}, o_ -> {meets}) OR {polygon_contains_point(polygon_edges, xmin, ymin)}"


def _cuts(e: Sql, o: Sql) -> Sql:
    """Positions in [0, 1] on edge ``e`` where edge ``o`` crosses, touches or ends on it."""
    length2 = f"nullif(({e}.x2 - {e}.x1) * ({e}.x2 - {e}.x1) + ({e}.y2 - {e}.y1) * ({e}.y2 - {e}.y1), 0D)"

    def along(x: Sql, y: Sql) -> Sql:
        return f"(({x} - {e}.x1) * ({e}.x2 - {e}.x1) + ({y} - {e}.y1) * ({e}.y2 - {e}.y1)) / {length2}"

    s1, s2 = _cross(e, f"{o}.x1", f"{o}.y1"), _cross(e, f"{o}.x2", f"{o}.y2")
    r1, r2 = _cross(o, f"{e}.x1", f"{e}.y1"), _cross(o, f"{e}.x2", f"{e}.y2")
    at = (
        f"CASE WHEN {s1} = 0 AND {s2} = 0 THEN array({along(f'{o}.x1', f'{o}.y1')}, {along(f'{o}.x2', f'{o}.y2')})"
        f" WHEN signum({s1}) * signum({s2}) <= 0 AND signum({r1}) * signum({r2}) <= 0 AND {r1} <> {r2}"
        f" THEN array({r1} / nullif({r1} - {r2}, 0D)) ELSE CAST(array() AS ARRAY<DOUBLE>) END"
    )
    return f"filter({at}, t_ -> t_ >= 0 AND t_ <= 1)"


def cut_positions(e: Sql, o: Sql) -> Sql:
    """Sorted positions in [0, 1] on ``e`` where ``o`` crosses, touches or ends on it."""
    return f"array_sort({_cuts(e, o)})"


def shared_run(e: Sql, o: Sql) -> Sql:
    """STRUCT<t0, t1, heading> of the stretch that the two edges have in common, null without one; a heading over 0 is the same way."""
    length2 = f"nullif(({e}.x2 - {e}.x1) * ({e}.x2 - {e}.x1) + ({e}.y2 - {e}.y1) * ({e}.y2 - {e}.y1), 0D)"
    t1, t2 = (f"((({o}.x{k} - {e}.x1) * ({e}.x2 - {e}.x1) + ({o}.y{k} - {e}.y1) * ({e}.y2 - {e}.y1)) / {length2})" for k in (1, 2))
    on_line = f"{_cross(e, f'{o}.x1', f'{o}.y1')} = 0 AND {_cross(e, f'{o}.x2', f'{o}.y2')} = 0"
    heading = f"(({e}.x2 - {e}.x1) * ({o}.x2 - {o}.x1) + ({e}.y2 - {e}.y1) * ({o}.y2 - {o}.y1))"
    low, high = f"greatest(least({t1}, {t2}), 0D)", f"least(greatest({t1}, {t2}), 1D)"
    return f"CASE WHEN {on_line} AND {low} < {high} THEN named_struct('t0', {low}, 't1', {high}, 'heading', {heading}) END"


def pieces(e: Sql, others: Sql) -> Sql:
    """``e`` cut by all edges in ``others``: ARRAY<STRUCT<t0, t1>> of non-empty pieces along it."""
    near = (f"filter({others}, c_ -> "
            f"{_edge_meets_bounds('c_', *(f'{f}({e}.{a}1, {e}.{a}2)' for a in 'xy' for f in ('least', 'greatest')))})")
    inner = f"flatten(transform({near}, c_ -> {_cuts(e, 'c_')}))"
    return bind_sql(
        f"array_sort(array_distinct(concat(array(0D, 1D), {inner})))", "ts_",
        "transform(slice(ts_, 1, size(ts_) - 1), (t_, i_) -> named_struct('t0', t_, 't1', get(ts_, i_ + 1)))",
    )


def middle(e: Sql, piece: Sql) -> tuple[Sql, Sql]:
    """The point halfway along a piece of ``e``."""
    x, y = (f"({e}.{a}1 + ({piece}.t0 + {piece}.t1) / 2 * ({e}.{a}2 - {e}.{a}1))" for a in "xy")
    return x, y


def runs_along(e: Sql, o: Sql, x: Sql, y: Sql) -> Sql:
    """Edge ``e`` lies on the line of ``o``, and its point (x, y) within the reach of ``o``."""
    return (f"({_cross(o, f'{e}.x1', f'{e}.y1')} = 0 AND {_cross(o, f'{e}.x2', f'{e}.y2')} = 0"
            f" AND {_in_edge_box(o, x, y)})")


# Contact of two edges, in rising order of consequence (for `_contact`).
_APART, _TOUCHING, _CROSSING = 0, 1, 2


def _contact(e: Sql, o: Sql) -> Sql:
    """Whether two edges are apart, cross at inner points of both, or touch in any other way."""
    s = f"signum({_cross(e, f'{o}.x1', f'{o}.y1')}) * signum({_cross(e, f'{o}.x2', f'{o}.y2')})"
    r = f"signum({_cross(o, f'{e}.x1', f'{e}.y1')}) * signum({_cross(o, f'{e}.x2', f'{e}.y2')})"
    bounds = (f"{f}({o}.{a}1, {o}.{a}2)" for a in "xy" for f in ("least", "greatest"))
    return (f"CASE WHEN NOT {_edge_meets_bounds(e, *bounds)} OR {s} > 0 OR {r} > 0 THEN {_APART}"
            f" WHEN {s} < 0 AND {r} < 0 THEN {_CROSSING} ELSE {_TOUCHING} END")


def _pieces_contained(outer: Sql, inner: Sql) -> Sql:
    """No piece of the inner boundary is outside, no piece of the outer boundary strictly inside (a hole within the
    inner polygon), and an inner point lies inside: the inner polygon could fill a hole exactly.
    """
    px, py = middle("i_e", "piece_")
    outside = f"NOT (exists({outer}, a_ -> {runs_along('i_e', 'a_', px, py)}) OR {polygon_covers_point(outer, px, py)})"
    leaves = f"exists({inner}, i_e -> exists({pieces('i_e', outer)}, piece_ -> {outside}))"
    qx, qy = middle("o_e", "piece_")
    within = f"{polygon_contains_point(inner, qx, qy)} AND NOT exists({inner}, a_ -> {runs_along('o_e', 'a_', qx, qy)})"
    enters = f"exists({outer}, o_e -> exists({pieces('o_e', inner)}, piece_ -> {within}))"
    return f"NOT ({leaves} OR {enters}) AND {_inner_point(inner, polygon_contains_point(outer, 'x_', 'y_'))}"


def _inner_point(polygon_edges: Sql, body: Sql) -> Sql:
    """``body`` with a point (x_, y_) strictly inside the polygon: on a line between its two lowest vertices'
    heights, halfway between the first two edges met."""
    heights = f"array_sort(array_distinct(transform({polygon_edges}, e_ -> e_.y1)))"
    spanning = f"filter({polygon_edges}, e_ -> (e_.y1 > y_) <> (e_.y2 > y_))"
    met = f"array_sort(transform({spanning}, e_ -> e_.x1 + (y_ - e_.y1) / nullif(e_.y2 - e_.y1, 0D) * (e_.x2 - e_.x1)))"
    at_x = bind_sql(met, "xs_", bind_sql("(get(xs_, 0) + get(xs_, 1)) / 2", "x_", body))
    return bind_sql(heights, "ys_", bind_sql("(get(ys_, 0) + get(ys_, 1)) / 2", "y_", at_x))


def polygon_contains_polygon(outer: Sql, inner: Sql, inner_prefix: str) -> Sql:
    """Whether the inner polygon lies in the outer one; shared boundary is allowed.

    Where no edge of the outer one comes near the inner bounds, which most pairs settle, one vertex decides.

    ``inner_prefix`` names the columns with the inner bounds. Only outer edges within those can be in contact.
    Without contact one inner vertex decides, together with holes of the outer polygon that may lie within the
    inner one. Crossing edges mean no. Only boundaries that touch need to be cut into pieces.
    """
    near = f"filter({outer}, o_e -> {_edge_meets_bounds('o_e', *(inner_prefix + n for n in BOX))})"
    worst = (f"aggregate(near_, {_APART}, (w_, o_e) -> greatest(w_, aggregate({inner}, {_APART}, (v_, i_e) -> "
             f"greatest(v_, {_contact('i_e', 'o_e')}))))")
    hole_inside = f"exists(near_, o_e -> {polygon_contains_point(inner, 'o_e.x1', 'o_e.y1')})"
    by_contact = bind_sql(worst, "contact_", (
        f"CASE WHEN contact_ = {_CROSSING} THEN false WHEN contact_ = {_APART} THEN NOT {hole_inside}"
        f" ELSE {_pieces_contained(outer, inner)} END"))
    first = f"get({inner}, 0)"
    exact = f"{polygon_covers_point(outer, f'{first}.x1', f'{first}.y1')} AND {bind_sql(near, 'near_', by_contact)}"
    inside = few_edges_contain_point(outer, f"{first}.x1", f"{first}.y1", _FEW_OUTER)
    return f"CASE WHEN {_few_edges_clear(outer, inner_prefix)} THEN {inside} ELSE {exact} END"


_FEW_OUTER = 6


def _few_edges_clear(polygon_edges: Sql, prefix: str) -> Sql:
    """No edge comes near the rectangle in the columns ``<prefix>xmin`` .. ``<prefix>ymax``, with room for rounding. False if there are more than a few edges."""
    xmin, xmax, ymin, ymax = (prefix + name for name in BOX)
    x, y = f"(({xmin} + {xmax}) / 2)", f"(({ymin} + {ymax}) / 2)"
    wide, high = (f"(({b} - {a}) * 0.5000001D + (abs({a}) + abs({b})) * 1e-15D)" for a, b in ((xmin, xmax), (ymin, ymax)))
    terms = [f"size({polygon_edges}) <= {_FEW_OUTER}"]
    for i in range(_FEW_OUTER):
        e = f"get({polygon_edges}, {i})"
        dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
        p, q = f"{dx} * ({y} - {e}.y1)", f"({x} - {e}.x1) * {dy}"
        aside = f"abs({p} - {q}) > {wide} * abs({dy}) + {high} * abs({dx}) + (abs({p}) + abs({q})) * 1e-9D"
        terms.append(f"CASE WHEN size({polygon_edges}) <= {i} THEN true"
                     f" WHEN NOT {_edge_meets_bounds(e, xmin, xmax, ymin, ymax)} THEN true ELSE {aside} END")
    return " AND ".join(terms)


def polygon_intersects_polygon(a: Sql, b: Sql) -> Sql:
    """Closed: edges meet, or one polygon holds a vertex of the other. A polygon within a hole of the other does not meet it."""
    met = f"exists({a}, i_e -> exists({b}, o_e -> {_contact('i_e', 'o_e')} <> {_APART}))"
    held = (polygon_covers_point(x, f"get({y}, 0).x1", f"get({y}, 0).y1") for x, y in ((a, b), (b, a)))
    return f"({met} OR {' OR '.join(held)})"


def box_edges(prefix: str = "") -> Sql:
    """The four edges of the rectangle held in the columns ``<prefix>xmin`` .. ``<prefix>ymax``, counter-clockwise."""
    left, right, low, high = (prefix + name for name in BOX)
    corners = [(left, low), (right, low), (right, high), (left, high)]
    rows = (f"named_struct('x1', {a}, 'y1', {b}, 'x2', {c}, 'y2', {d})" for (a, b), (c, d) in zip(corners, [*corners[1:], corners[0]]))
    return f"array({', '.join(rows)})"


# ---------------------------------------------------------------- projections

def circle_box(cx: Column, cy: Column, radius: Column) -> Box:
    return Box(cx - radius, cx + radius, cy - radius, cy + radius)


def box_to_circle(b: Box) -> tuple[Column, Column, Column]:
    """Centre and radius of the circle as wide as the rectangle, on its lower left square; height is ignored."""
    radius = (b.xmax - b.xmin) / 2
    return b.xmin + radius, b.ymin + radius, radius


def box_columns(b: Box, prefix: str = "") -> list[Column]:
    """The bounds aliased ``<prefix>xmin`` .. ``<prefix>ymax``, for use in a select."""
    return [value.alias(prefix + name) for value, name in zip(b, BOX)]


def box_center(b: Box) -> tuple[Column, Column]:
    return (b.xmin + b.xmax) / 2, (b.ymin + b.ymax) / 2
