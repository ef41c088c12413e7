"""The registered queries as plain SQL over the same tables, written without the library's methods:
range joins instead of cells, edges as rows instead of arrays. Used only to check results."""

from __future__ import annotations

from meshfold.sources import tables as t

# Query parameters (fixed values): windows (xmin, xmax, ymin, ymax), query points, k, radius, partitions.
W1 = (-90.01, -80.01, 30.01, 40.01)
W2 = (-120.01, -60.01, 10.01, 50.01)
W3 = (-100.0, 0.0, -40.0, 0.0)
CENTER = (-84.01, 34.01)
P3 = (-30.0, -10.0)
K_RECTS = 1000
QUERY_RINGS = [  # a concave shell and a hole
    [(-120.013, -20.007), (60.011, -50.003), (100.017, 40.009), (10.019, 10.001), (-80.023, 60.027)],
    [(-40.103, -10.207), (0.309, -12.401), (-10.511, 5.603)],
]
RADIUS = 0.1
N_PARTITIONS = 16
CELLS = 70680

# Trip coordinates derived from the events; some fall outside the city's box.
TRIP_LAT = "4.045e1+((event_id*7919)%5000)/1e4"
TRIP_LON = "-7.43e1+((event_id*10473)%6500)/1e4"


def _ring_case(shape: list[tuple[int, int]], axis: int) -> str:
    return "CASE k " + " ".join(f"WHEN {k} THEN {v[axis]}" for k, v in enumerate(shape)) + " END"


def _corners(n: int) -> str:
    return "(" + " UNION ALL ".join(f"SELECT {k} AS k" for k in range(n)) + ") ks"


def _poly_vertex(axis: int) -> str:
    return f"r*CASE WHEN gid%2=1 THEN {_ring_case(t.DIAMOND, axis)} ELSE {_ring_case(t.ELL, axis)} END"


def _edges(source: str) -> str:
    return f"""SELECT gid, k, vx AS x1, vy AS y1,
      coalesce(lead(vx) OVER (PARTITION BY gid ORDER BY k), first_value(vx) OVER (PARTITION BY gid ORDER BY k)) AS x2,
      coalesce(lead(vy) OVER (PARTITION BY gid ORDER BY k), first_value(vy) OVER (PARTITION BY gid ORDER BY k)) AS y2
      FROM {source}"""


def _distance(edge: str, x: str, y: str) -> str:
    """Distance from a point to a segment given as a row with x1, y1, x2, y2."""
    e = edge
    along = (f"(({x}-{e}.x1)*({e}.x2-{e}.x1)+({y}-{e}.y1)*({e}.y2-{e}.y1))"
             f"/(({e}.x2-{e}.x1)*({e}.x2-{e}.x1)+({e}.y2-{e}.y1)*({e}.y2-{e}.y1))")
    t_ = f"least(greatest({along},0e0),1e0)"
    px, py = f"({e}.x1+{t_}*({e}.x2-{e}.x1))", f"({e}.y1+{t_}*({e}.y2-{e}.y1))"
    return f"sqrt(({px}-({x}))*({px}-({x}))+({py}-({y}))*({py}-({y})))"


TABLES = {
    "pts": f"SELECT o_orderkey AS id, {t.POINT_X} AS x, {t.POINT_Y} AS y FROM orders",
    "skew": f"SELECT c_custkey AS id, {t.CLUSTER_X} AS x, {t.CLUSTER_Y} AS y FROM customer",
    "circles": f"SELECT c_custkey AS id, {t.CLUSTER_X} AS cx, {t.CLUSTER_Y} AS cy, (1+c_custkey%10)/1e1 AS radius FROM customer",
    "rects": f"""SELECT p_partkey AS id, {t.RECT_X}-p_size/1e1 AS xmin, {t.RECT_X}+p_size/1e1 AS xmax,
      {t.RECT_Y}-p_size/2e1 AS ymin, {t.RECT_Y}+p_size/2e1 AS ymax FROM part""",
    "polyv": f"""SELECT gid, k, px+{_poly_vertex(0)} AS vx, py+{_poly_vertex(1)} AS vy
      FROM (SELECT s_suppkey AS gid, {t.POLY_X} AS px, {t.POLY_Y} AS py, 3+s_suppkey%7 AS r FROM supplier) s
      CROSS JOIN {_corners(6)} WHERE k < CASE WHEN gid%2=1 THEN 4 ELSE 6 END""",
    "edges": _edges("polyv"),
    "pbox": "SELECT gid AS id, min(vx) AS xmin, max(vx) AS xmax, min(vy) AS ymin, max(vy) AS ymax FROM polyv GROUP BY gid",
    "smallv": f"""SELECT gid, k, px+r*{_ring_case(t.DIAMOND, 0)} AS vx, py+r*{_ring_case(t.DIAMOND, 1)} AS vy
      FROM (SELECT p_partkey AS gid, {t.RECT_X} AS px, {t.RECT_Y} AS py, p_size/1e2 AS r FROM part) p
      CROSS JOIN {_corners(4)}""",
    "smalledges": _edges("smallv"),
    "sbox": "SELECT gid AS id, min(vx) AS xmin, max(vx) AS xmax, min(vy) AS ymin, max(vy) AS ymax FROM smallv GROUP BY gid",
    "taxi": """SELECT event_id AS id, CAST(extract(DAY FROM ts) AS INT) AS t, CAST(4050+(event_id*event_id)%40 AS INT) AS cx,
      CAST(-7425+(event_id*user_id)%57 AS INT) AS cy FROM events""",
    "counts": "SELECT t, cx, cy, count(*) AS n FROM taxi GROUP BY t, cx, cy",
    "steps": "SELECT -1 AS d UNION ALL SELECT 0 UNION ALL SELECT 1",
    "sums": """SELECT CAST(c.t+a.d AS INT) AS t, CAST(c.cx+b.d AS INT) AS cx, CAST(c.cy+e.d AS INT) AS cy,
      CAST(sum(n) AS BIGINT) AS s, CAST(sum(n*n) AS BIGINT) AS s2
      FROM counts c CROSS JOIN steps a CROSS JOIN steps b CROSS JOIN steps e
      WHERE c.t+a.d BETWEEN 1 AND 31 AND c.cx+b.d BETWEEN 4050 AND 4089 AND c.cy+e.d BETWEEN -7425 AND -7369
      GROUP BY 1, 2, 3""",
    "weighted": """SELECT *, CAST((least(t+1,31)-greatest(t-1,1)+1)*(least(cx+1,4089)-greatest(cx-1,4050)+1)
      *(least(cy+1,-7369)-greatest(cy-1,-7425)+1) AS INT) AS w FROM sums""",
    "moments": f"SELECT sum(n)/{CELLS}e0 AS m, sum(n*n)/{CELLS}e0 AS m2 FROM counts",
    "cube": """SELECT CAST(a.v AS INT) AS t, CAST(b.v AS INT) AS cx, CAST(c.v AS INT) AS cy
      FROM range(1, 32) a(v) CROSS JOIN range(4050, 4090) b(v) CROSS JOIN range(-7425, -7368) c(v)""",
    # Union: every edge cut where edges of other polygons cross it; a piece whose middle no other polygon holds is outline.
    "crossings": """SELECT e.gid, e.k, ((f.x1-e.x1)*(f.y2-f.y1)-(f.y1-e.y1)*(f.x2-f.x1))/((e.x2-e.x1)*(f.y2-f.y1)-(e.y2-e.y1)*(f.x2-f.x1)) AS t,
      ((f.x1-e.x1)*(e.y2-e.y1)-(f.y1-e.y1)*(e.x2-e.x1))/((e.x2-e.x1)*(f.y2-f.y1)-(e.y2-e.y1)*(f.x2-f.x1)) AS u
      FROM edges e JOIN edges f ON e.gid<>f.gid AND (e.x2-e.x1)*(f.y2-f.y1)-(e.y2-e.y1)*(f.x2-f.x1)<>0""",
    "marks": """SELECT gid, k, t FROM crossings WHERE t>0 AND t<1 AND u>=0 AND u<=1
      UNION SELECT gid, k, 0e0 FROM edges UNION SELECT gid, k, 1e0 FROM edges""",
    "parts": """SELECT e.*, m.t0, m.t1, e.x1+(m.t0+m.t1)/2*(e.x2-e.x1) AS mx, e.y1+(m.t0+m.t1)/2*(e.y2-e.y1) AS my
      FROM (SELECT gid, k, t AS t0, lead(t) OVER (PARTITION BY gid, k ORDER BY t) AS t1 FROM marks) m
      JOIN edges e ON e.gid=m.gid AND e.k=m.k WHERE m.t1 IS NOT NULL""",
    "holders": """SELECT p.gid, p.k, p.t0, f.gid AS other FROM parts p JOIN edges f
      ON f.gid<>p.gid AND ((f.y1>p.my)<>(f.y2>p.my)) AND p.mx < (f.x2-f.x1)*(p.my-f.y1)/(f.y2-f.y1)+f.x1
      GROUP BY p.gid, p.k, p.t0, f.gid HAVING count(*)%2=1""",
    "outline": """SELECT p.* FROM parts p WHERE NOT EXISTS
      (SELECT 1 FROM holders h WHERE h.gid=p.gid AND h.k=p.k AND h.t0=p.t0)""",
    "runs": """SELECT *, sum(fresh) OVER (PARTITION BY gid, k ORDER BY t0) AS run FROM
      (SELECT *, CASE WHEN lag(t1) OVER (PARTITION BY gid, k ORDER BY t0)=t0 THEN 0 ELSE 1 END AS fresh FROM outline) o""",
}


def _with(names: str, body: str, extra: str = "") -> str:
    """The query with the tables it needs, and those they need in turn, as common table expressions."""
    needed: list[str] = []

    def need(name: str) -> None:
        for other in TABLES:
            if other != name and other not in needed and any(f" {other}{end}" in TABLES[name] + " " for end in (" ", "\n", ")")):
                need(other)
        if name not in needed:
            needed.append(name)

    for name in names.split():
        need(name)
    tables = [f"{n} AS ({TABLES[n]})" for n in needed] + ([extra] if extra else [])
    return f"WITH {'RECURSIVE ' if extra else ''}" + ",\n".join(tables) + "\n" + body


def _window(w: tuple[float, float, float, float]) -> tuple[str, str, str, str]:
    return tuple(repr(v) + "e0" for v in w)


def _inside(w) -> str:
    a, b, c, d = _window(w)
    return f"xmin >= {a} AND xmax <= {b} AND ymin >= {c} AND ymax <= {d}"


def _touches(w) -> str:
    a, b, c, d = _window(w)
    return f"xmin <= {b} AND xmax >= {a} AND ymin <= {d} AND ymax >= {c}"


def _points_in(w) -> str:
    a, b, c, d = _window(w)
    return f"x BETWEEN {a} AND {b} AND y BETWEEN {c} AND {d}"


def _polygon_meets(w, edges: str) -> str:
    """Ids of polygons with an edge that survives clipping to the window, or that hold a corner of it."""
    a, b, c, d = _window(w)

    def clip(p: str, q: str, low: str, high: str) -> tuple[str, str]:
        enter = f"CASE WHEN {p}={q} THEN 0e0 ELSE least(({low}-{p})/({q}-{p}),({high}-{p})/({q}-{p})) END"
        leave = f"CASE WHEN {p}={q} THEN 1e0 ELSE greatest(({low}-{p})/({q}-{p}),({high}-{p})/({q}-{p})) END"
        return enter, leave

    ex, lx = clip("x1", "x2", a, b)
    ey, ly = clip("y1", "y2", c, d)
    outside = (f"(least(x1,x2)>{b} OR greatest(x1,x2)<{a} OR least(y1,y2)>{d} OR greatest(y1,y2)<{c})")
    return f"""SELECT gid AS id FROM {edges} WHERE NOT {outside}
      AND greatest({ex},{ey},0e0) <= least({lx},{ly},1e0)
      UNION SELECT gid AS id FROM {edges} WHERE ((y1>{c})<>(y2>{c})) AND {a} < (x2-x1)*({c}-y1)/(y2-y1)+x1
      GROUP BY gid HAVING count(*)%2=1"""


def _query_edges() -> str:
    rows = [(*a, *b) for ring in QUERY_RINGS for a, b in zip(ring, [*ring[1:], ring[0]])]
    return "q AS (SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(f"{v!r}e0" for v in row) + ")" for row in rows) + ") v(x1, y1, x2, y2))"


def _in_query(x: str, y: str) -> str:
    return f"(SELECT count(*) FROM q WHERE ((q.y1>{y})<>(q.y2>{y})) AND {x} < (q.x2-q.x1)*({y}-q.y1)/(q.y2-q.y1)+q.x1)%2=1"


_RECT_EDGES = """redges AS (SELECT id AS gid, 0 AS k, xmin AS x1, ymin AS y1, xmax AS x2, ymin AS y2 FROM rects UNION ALL
      SELECT id, 1, xmax, ymin, xmax, ymax FROM rects UNION ALL SELECT id, 2, xmax, ymax, xmin, ymax FROM rects UNION ALL
      SELECT id, 3, xmin, ymax, xmin, ymin FROM rects)"""


def _by_query(edges: str, meet: bool) -> str:
    """Ids of shapes in, or meeting, the query polygon: by crossing edges, and by vertices of each in the other. The tables hold no touching edges."""
    cross = f"""SELECT e.gid FROM {edges} e JOIN q ON
      (((q.x2-q.x1)*(e.y1-q.y1)-(e.x1-q.x1)*(q.y2-q.y1)>0) <> ((q.x2-q.x1)*(e.y2-q.y1)-(e.x2-q.x1)*(q.y2-q.y1)>0))
      AND (((e.x2-e.x1)*(q.y1-e.y1)-(q.x1-e.x1)*(e.y2-e.y1)>0) <> ((e.x2-e.x1)*(q.y2-e.y1)-(q.x2-e.x1)*(e.y2-e.y1)>0))"""
    held = f"""SELECT gid FROM (SELECT e.gid, q.x1, q.y1 FROM {edges} e JOIN q ON ((e.y1>q.y1)<>(e.y2>q.y1))
      AND q.x1 < (e.x2-e.x1)*(q.y1-e.y1)/(e.y2-e.y1)+e.x1 GROUP BY e.gid, q.x1, q.y1 HAVING count(*)%2=1) h"""
    inside = f"SELECT gid FROM {edges} e WHERE k=0 AND {_in_query('e.x1', 'e.y1')}"
    if meet:
        return f"{cross} UNION {held} UNION {inside}"
    return f"{inside} EXCEPT ({cross} UNION {held})"


def _ranked(source: str, k: int) -> str:
    """``source`` gives (id, d)."""
    return f"""SELECT CAST(row_number() OVER (ORDER BY d, id) AS INT) AS rank, id, round(d, 6) AS distance
      FROM (SELECT id, d FROM ({source}) s ORDER BY d, id LIMIT {k}) n"""


_X, _Y = (f"({v!r}e0)" for v in CENTER)
_PX, _PY = (f"({v!r}e0)" for v in P3)
_POINT_D = f"SELECT id, sqrt((x-{_X})*(x-{_X})+(y-{_Y})*(y-{_Y})) AS d FROM pts"
_RECT_D = f"""SELECT id, sqrt(dx*dx+dy*dy) AS d FROM (SELECT id, greatest(xmin-{_X}, 0e0, {_X}-xmax) AS dx,
  greatest(ymin-{_Y}, 0e0, {_Y}-ymax) AS dy FROM rects) r"""


def _poly_d(edges: str) -> str:
    return f"""SELECT gid AS id, CASE WHEN sum(CASE WHEN ((y1>{_Y})<>(y2>{_Y})) AND {_X} < (x2-x1)*({_Y}-y1)/nullif(y2-y1,0)+x1
      THEN 1 ELSE 0 END)%2=1 THEN 0e0 ELSE min({_distance('e', _X, _Y)}) END AS d FROM {edges} e GROUP BY gid"""


_PAIRS = "r.id AS window_id, p.id AS object_id"
_PTS_RECTS = "rects r JOIN pts p ON p.x BETWEEN r.xmin AND r.xmax AND p.y BETWEEN r.ymin AND r.ymax"
_NEAR = "(p.x-c.x)*(p.x-c.x)+(p.y-c.y)*(p.y-c.y)"
_PTS_RECTS_COUNT = """SELECT r.id AS window_id, count(p.id) AS n FROM rects r LEFT JOIN pts p
  ON p.x BETWEEN r.xmin AND r.xmax AND p.y BETWEEN r.ymin AND r.ymax GROUP BY r.id"""
_CONTAINS = "a.xmin >= b.xmin AND a.xmax <= b.xmax AND a.ymin >= b.ymin AND a.ymax <= b.ymax"
_MEET = "a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin"

_Z = "CASE WHEN sd*sqrt({ratio}) > 0 THEN round((s-m*w)/(sd*sqrt({ratio})), 6) ELSE 0e0 END"
_REAL = f"(({CELLS}e0*w-w*w)/({CELLS}e0-1))"
_GLOBAL = "(SELECT weighted.*, m, sqrt(m2-m*m) AS sd FROM weighted CROSS JOIN moments) q"
_LOCAL = f"(SELECT *, s/{CELLS}e0 AS m, sqrt(greatest(s2/{CELLS}e0-(s/{CELLS}e0)*(s/{CELLS}e0), 0e0)) AS sd FROM weighted) q"


def _scores(source: str, ratio: str = _REAL) -> str:
    return f"SELECT cx, cy, t, {_Z.format(ratio=ratio)} AS z, s, s2, w FROM {source}"


_CHECK = "SELECT CAST(0 AS BIGINT) AS {}, CAST(0 AS BIGINT) AS {}, count(*) AS total{} FROM {}"

# Each site's half-planes a*x + b*y <= c, against the other sites and the bounds; crossings of two that break none of the others are the cell's corners.
_VORONOI = f"""WITH sites AS MATERIALIZED (SELECT s_suppkey AS id, {t.POLY_X} AS x, {t.POLY_Y} AS y FROM supplier),
    b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM sites),
    planes AS MATERIALIZED (
      SELECT s.id, o.id AS k, o.x-s.x AS a, o.y-s.y AS b, ((o.x-s.x)*(o.x+s.x)+(o.y-s.y)*(o.y+s.y))/2 AS c FROM sites s JOIN sites o ON s.id<>o.id
      UNION ALL SELECT id, v.k, v.a, v.b, v.c FROM sites CROSS JOIN (
        SELECT -1 AS k, -1e0 AS a, 0e0 AS b, -x0 AS c FROM b UNION ALL SELECT -2, 1e0, 0e0, x1 FROM b
        UNION ALL SELECT -3, 0e0, -1e0, -y0 FROM b UNION ALL SELECT -4, 0e0, 1e0, y1 FROM b) v),
    crossings AS (
      SELECT p.id, p.k AS k1, q.k AS k2, (p.c*q.b-q.c*p.b)/(p.a*q.b-q.a*p.b) AS x, (p.a*q.c-q.a*p.c)/(p.a*q.b-q.a*p.b) AS y
      FROM planes p JOIN planes q ON p.id=q.id AND p.k<q.k WHERE abs(p.a*q.b-q.a*p.b)>1e-12),
    corners AS (
      SELECT * FROM crossings v WHERE NOT EXISTS (
        SELECT 1 FROM planes h WHERE h.id=v.id AND h.k<>v.k1 AND h.k<>v.k2 AND h.a*v.x+h.b*v.y-h.c>1e-8*sqrt(h.a*h.a+h.b*h.b)))
    SELECT id, round(min(x), 5)+0e0 AS xmin, round(max(x), 5)+0e0 AS xmax, round(min(y), 5)+0e0 AS ymin, round(max(y), 5)+0e0 AS ymax FROM corners GROUP BY id"""

# The curve from the highest bit of the cell down: the quadrant's place, then the turn into it.
_HILBERT = """WITH RECURSIVE cells AS (
      SELECT CAST(least(greatest(floor((x-x0)/((x1-x0)/32768)), 0), 32767) AS BIGINT) AS x,
             CAST(least(greatest(floor((y-y0)/((y1-y0)/32768)), 0), 32767) AS BIGINT) AS y
      FROM ({pts}) p CROSS JOIN (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM ({pts}) q) b),
    h AS (
      SELECT 16384 AS s, x, y, CAST(0 AS BIGINT) AS d FROM cells
      UNION ALL
      SELECT s//2, CASE WHEN ry=0 THEN (CASE WHEN rx=1 THEN 32767-y ELSE y END) ELSE x END,
             CASE WHEN ry=0 THEN (CASE WHEN rx=1 THEN 32767-x ELSE x END) ELSE y END,
             d + CAST(s AS BIGINT)*s*(CASE WHEN rx=0 THEN ry ELSE 3-ry END)
      FROM (SELECT *, CASE WHEN x & s > 0 THEN 1 ELSE 0 END AS rx, CASE WHEN y & s > 0 THEN 1 ELSE 0 END AS ry FROM h) t WHERE s > 0)
    SELECT CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS uneven, count(*) AS total, CAST(0 AS BIGINT) AS disorder,
      CAST(sum(d) AS BIGINT) AS key_sum FROM h WHERE s = 0"""


def _trips(cut: str) -> str:
    lat, lon = (cut.replace("?", f"({v}*100)") for v in (TRIP_LAT.join("()"), TRIP_LON.join("()")))
    return f"""SELECT CAST(extract(DAY FROM ts) AS INT) AS t, CAST({lat} AS INT) AS cx, CAST({lon} AS INT) AS cy, count(*) AS n
      FROM events WHERE {TRIP_LAT} BETWEEN 40.5e0 AND 40.9e0 AND {TRIP_LON} BETWEEN -74.25e0 AND -73.7e0 GROUP BY 1, 2, 3"""


def _bounds(table: str, x1: str = "xmin", x2: str = "xmax", y1: str = "ymin", y2: str = "ymax") -> str:
    return f"SELECT min({x1}) AS xmin, max({x2}) AS xmax, min({y1}) AS ymin, max({y2}) AS ymax FROM {table}"


SQL: dict[str, str] = {
    "range_pts_contains": _with("pts", f"SELECT * FROM pts WHERE {_points_in(W1)}"),
    "range_rects_contains": _with("rects", f"SELECT * FROM rects WHERE {_inside(W2)}"),
    "range_rects_intersects": _with("rects", f"SELECT * FROM rects WHERE {_touches(W2)}"),
    "range_polys_contains": _with("pbox", f"SELECT id FROM pbox WHERE {_inside(W2)}"),
    "range_polys_intersects": _with("edges", _polygon_meets(W2, "edges")),
    "range_polys_mbr": _with("pbox", f"SELECT id FROM pbox WHERE {_touches(W2)}"),
    "range_small_polys_contains": _with("sbox", f"SELECT id FROM sbox WHERE {_inside(W2)}"),
    "range_small_polys_intersects": _with("smalledges", _polygon_meets(W2, "smalledges")),
    "range_pts_indexed": _with("pts", f"SELECT * FROM pts WHERE {_points_in(W1)}"),
    "range_rects_indexed": _with("rects", f"SELECT * FROM rects WHERE {_touches(W2)}"),
    "range_polys_indexed": _with("sbox", f"SELECT id FROM sbox WHERE {_touches(W2)}"),
    "knn_pts": _with("pts", _ranked(_POINT_D, 5)),
    "knn_rects": _with("rects", _ranked(_RECT_D, K_RECTS)),
    "knn_polys": _with("edges", _ranked(_poly_d("edges"), 5)),
    "knn_pts_some_null": _with("pts", _ranked(_POINT_D.replace("FROM pts", "FROM pts WHERE id % 3 <> 0"), 5)),
    "knn_polys_some_null": _with("edges", _ranked(_poly_d("edges").replace("GROUP BY gid", "WHERE gid % 3 <> 0 GROUP BY gid"), 5)),
    "knn_pts_pruned": _with("pts", _ranked(_POINT_D, 5)),
    "knn_rects_pruned": _with("rects", _ranked(_RECT_D, K_RECTS)),
    "knn_polys_pruned": _with("smalledges", _ranked(_poly_d("smalledges"), 5)),
    "join_pts_rects_pairs": _with("pts rects", f"SELECT {_PAIRS} FROM {_PTS_RECTS}"),
    "join_pts_rects_count": _with("pts rects", _PTS_RECTS_COUNT),
    "join_equal_pts_rects_count": _with("skew rects", _PTS_RECTS_COUNT.replace("pts", "skew")),
    "join_pts_rects_groups": _with("pts rects", """SELECT r.id AS window_id, CAST(0 AS BIGINT) AS part, count(p.id) AS n,
      coalesce(string_agg(CAST(p.id AS VARCHAR), ',' ORDER BY p.id), '') AS objects FROM rects r LEFT JOIN pts p
      ON p.x BETWEEN r.xmin AND r.xmax AND p.y BETWEEN r.ymin AND r.ymax GROUP BY r.id"""),
    "join_pts_rects_small_groups": _with("pts rects", """SELECT r.id AS window_id, count(p.id) AS n,
      coalesce(string_agg(CAST(p.id AS VARCHAR), ',' ORDER BY p.id), '') AS objects FROM rects r LEFT JOIN pts p
      ON p.x BETWEEN r.xmin AND r.xmax AND p.y BETWEEN r.ymin AND r.ymax GROUP BY r.id"""),
    "join_pts_rects_indexed": _with("pts rects", f"SELECT {_PAIRS} FROM {_PTS_RECTS}"),
    "join_rects_rects_contains": _with("rects", f"SELECT b.id AS window_id, a.id AS object_id FROM rects a JOIN rects b ON {_CONTAINS}"),
    "join_rects_rects_intersects": _with("rects", f"SELECT b.id AS window_id, a.id AS object_id FROM rects a JOIN rects b ON {_MEET}"),
    "join_pts_polys": _with("pts edges", """SELECT e.gid AS window_id, p.id AS object_id FROM pts p JOIN edges e
      ON ((e.y1>p.y)<>(e.y2>p.y)) AND p.x < (e.x2-e.x1)*(p.y-e.y1)/(e.y2-e.y1)+e.x1 GROUP BY 1, 2 HAVING count(*)%2=1"""),
    "join_pts_polys_mbr": _with("pts pbox", f"SELECT {_PAIRS} FROM {_PTS_RECTS.replace('rects', 'pbox')}"),
    # No vertex outside and no edge crossing; the tables hold no touching edges.
    "join_polys_polys_contains": _with("smalledges edges sbox pbox", f"""SELECT b.id AS window_id, a.id AS object_id
      FROM sbox a JOIN pbox b ON {_CONTAINS}
      WHERE NOT EXISTS (SELECT 1 FROM smalledges s JOIN edges e ON
        (((e.x2-e.x1)*(s.y1-e.y1)-(s.x1-e.x1)*(e.y2-e.y1)>0) <> ((e.x2-e.x1)*(s.y2-e.y1)-(s.x2-e.x1)*(e.y2-e.y1)>0))
        AND (((s.x2-s.x1)*(e.y1-s.y1)-(e.x1-s.x1)*(s.y2-s.y1)>0) <> ((s.x2-s.x1)*(e.y2-s.y1)-(e.x2-s.x1)*(s.y2-s.y1)>0))
        WHERE s.gid=a.id AND e.gid=b.id)
      AND (SELECT count(*) FROM smalledges s JOIN edges e ON ((e.y1>s.y1)<>(e.y2>s.y1))
        AND s.x1 < (e.x2-e.x1)*(s.y1-e.y1)/(e.y2-e.y1)+e.x1 WHERE s.gid=a.id AND s.k=0 AND e.gid=b.id)%2=1"""),
    "join_polys_polys_mbr": _with("sbox pbox", f"SELECT b.id AS window_id, a.id AS object_id FROM sbox a JOIN pbox b ON {_MEET}"),
    "join_distinct_geometry_count": _with("skew rects", """SELECT r.id AS window_id, count(p.x) AS n FROM rects r
      LEFT JOIN (SELECT DISTINCT x, y FROM skew) p ON p.x BETWEEN r.xmin AND r.xmax AND p.y BETWEEN r.ymin AND r.ymax GROUP BY r.id"""),
    "distance_join_exact": _with("skew", f"SELECT c.id AS window_id, p.id AS object_id FROM skew c JOIN skew p ON sqrt({_NEAR}) < {RADIUS}e0"),
    "distance_join_mbr": _with("skew", f"""SELECT c.id AS window_id, p.id AS object_id FROM skew c JOIN skew p
      ON p.x BETWEEN c.x-{RADIUS}e0 AND c.x+{RADIUS}e0 AND p.y BETWEEN c.y-{RADIUS}e0 AND c.y+{RADIUS}e0"""),
    "distance_join_count": _with("skew pts", f"""SELECT c.id AS window_id, count(p.id) AS n
      FROM skew c LEFT JOIN pts p ON sqrt({_NEAR}) < 1e0 GROUP BY c.id"""),
    "distance_join_mbr_count": _with("skew pts", """SELECT c.id AS window_id, count(p.id) AS n
      FROM skew c LEFT JOIN pts p ON p.x BETWEEN c.x-1e0 AND c.x+1e0 AND p.y BETWEEN c.y-1e0 AND c.y+1e0 GROUP BY c.id"""),
    "distance_join_circles": _with("circles pts", """SELECT c.id AS window_id, p.id AS object_id FROM circles c JOIN pts p
      ON sqrt((p.x-c.cx)*(p.x-c.cx)+(p.y-c.cy)*(p.y-c.cy)) < c.radius"""),
    "boundary_pts": _with("pts", _bounds("pts", "x", "x", "y", "y")),
    "boundary_rects": _with("rects", _bounds("rects")),
    "boundary_polys": _with("polyv", _bounds("polyv", "vx", "vx", "vy", "vy")),
    "boundary_circles": _with("circles", _bounds("circles", "cx-radius", "cx+radius", "cy-radius", "cy+radius")),
    "circles_from_pts": _with("pts", f"SELECT id, x AS cx, y AS cy, {RADIUS}e0 AS radius FROM pts"),
    "circles_mbr": _with("circles", "SELECT id, cx-radius AS xmin, cx+radius AS xmax, cy-radius AS ymin, cy+radius AS ymax FROM circles"),
    "circle_centers": _with("circles", "SELECT id, cx AS x, cy AS y FROM circles"),
    "mbr_to_circle": _with("rects", "SELECT id, xmin+(xmax-xmin)/2 AS cx, ymin+(xmax-xmin)/2 AS cy, (xmax-xmin)/2 AS radius FROM rects"),
    "polys_mbr": _with("pbox", "SELECT * FROM pbox"),
    "circle_rect_intersects": _with("circles", f"""SELECT id FROM (SELECT *, abs(cx-({W3[0]}+{W3[1]})/2e0) AS dx, abs(cy-({W3[2]}+{W3[3]})/2e0) AS dy,
      ({W3[1]}-({W3[0]}))/2e0 AS hw, ({W3[3]}-({W3[2]}))/2e0 AS hh FROM circles) c
      WHERE dx <= hw+radius AND dy <= hh+radius AND (dx <= hw OR dy <= hh OR (dx-hw)*(dx-hw)+(dy-hh)*(dy-hh) <= radius*radius)"""),
    "circle_point_predicates": _with("circles", f"""SELECT id, d < radius AS contains, d <= radius AS intersects
      FROM (SELECT *, sqrt((cx-{_PX})*(cx-{_PX})+(cy-{_PY})*(cy-{_PY})) AS d FROM circles) c"""),
    "record_counts": "SELECT count(*) AS n FROM orders",
    "distinct_geometries": _with("skew", "SELECT count(*) AS n FROM (SELECT DISTINCT x, y FROM skew) s"),
    "partition_equalgrid": _with("pts", """SELECT CAST(gx*3+gy AS INT) AS pid, count(*) AS n, round(count(*)/(SELECT count(*)*1e0 FROM pts), 6) AS share
      FROM (SELECT least(floor((x-x0)/((x1-x0)/3)), 2) AS gx, least(floor((y-y0)/((y1-y0)/3)), 2) AS gy FROM pts
        CROSS JOIN (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts) b) p GROUP BY 1"""),
    "partition_hilbert_check": _HILBERT.format(pts=TABLES["pts"]),
    "partition_rtree_check": _CHECK.format("lost", "uneven", ", CAST(0 AS BIGINT) AS overlaps", "orders"),
    "partition_voronoi_check": _CHECK.format("wrong", "empty", "", "orders"),
    "voronoi_bounds": _VORONOI,
    "partition_quadtree_check": _CHECK.format("lost", "oversized", ", CAST(0 AS BIGINT) AS overlaps", "customer"),
    "partition_by_other_table": _with("pts rects", """SELECT CAST(gx*3+gy AS INT) AS pid, count(*) AS n
      FROM (SELECT greatest(least(floor(((xmin+xmax)/2-x0)/((x1-x0)/3)), 2), 0) AS gx, greatest(least(floor(((ymin+ymax)/2-y0)/((y1-y0)/3)), 2), 0) AS gy
        FROM rects CROSS JOIN (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts) b) p GROUP BY 1"""),
    "partition_windows_check": _with("pts rects", _PTS_RECTS_COUNT),
    "hotspot_counts": _with("counts", "SELECT * FROM counts"),
    "hotspot_gistar_top50": _with("weighted moments", _scores(_GLOBAL) + " ORDER BY z DESC, t, cx, cy LIMIT 50"),
    "hotspot_gistar_all": _with("weighted moments cube", f"""SELECT cx, cy, t, {_Z.format(ratio=_REAL)} AS z, s, s2, w FROM
      (SELECT c.*, coalesce(s.s, 0) AS s, coalesce(s.s2, 0) AS s2, m, sqrt(m2-m*m) AS sd,
        CAST((least(c.t+1,31)-greatest(c.t-1,1)+1)*(least(c.cx+1,4089)-greatest(c.cx-1,4050)+1)
        *(least(c.cy+1,-7369)-greatest(c.cy-1,-7425)+1) AS INT) AS w
       FROM cube c LEFT JOIN sums s ON s.t=c.t AND s.cx=c.cx AND s.cy=c.cy CROSS JOIN moments) q"""),
    "hotspot_gistar_local": _with("weighted", _scores(_LOCAL) + " ORDER BY z DESC, t, cx, cy LIMIT 50"),
    "hotspot_gistar_int_division": _with("weighted moments", _scores(_GLOBAL, f"floor({_REAL})")),
    "hotspot_join_counts": _with("cube taxi", """SELECT c.t, ((CAST(c.t AS BIGINT)-1)*40+(c.cx-4050))*57+(c.cy+7425) AS square, count(e.id) AS n
      FROM cube c LEFT JOIN taxi e ON e.t=c.t AND e.cx>=c.cx AND e.cx<=c.cx+1 AND e.cy>=c.cy AND e.cy<=c.cy+1 GROUP BY 1, 2"""),
    "hotspot_trips_floor": _trips("floor(?)"),
    "hotspot_trips_truncate": _trips("trunc(?)"),
    "hotspot_trips_round": _trips("trunc(floor(?*100+0.5e0)/100)"),
    "load_points_tsv_roundtrip": _with("skew", "SELECT id, x, y FROM skew"),
    "load_points_wkt_roundtrip": _with("pbox", "SELECT id, xmin AS x, ymin AS y FROM pbox"),
    "load_rects_roundtrip": _with("rects", "SELECT * FROM rects"),
    "load_rects_wkt_roundtrip": _with("pbox", "SELECT * FROM pbox"),
    "load_rects_wkt_z_roundtrip": _with("pbox", "SELECT * FROM pbox"),
    "load_rects_collection_roundtrip": _with("pbox", "SELECT xmin, xmax, ymin, ymax FROM pbox"),
    "load_rects_geojson_roundtrip": _with("pbox", "SELECT xmin, xmax, ymin, ymax FROM pbox"),
    "load_polygons_csv_roundtrip": _with("polyv", "SELECT gid AS id, k, vx, vy FROM polyv"),
    "load_polygons_wkt_roundtrip": _with("polyv", "SELECT gid AS id, k, vx, vy FROM polyv"),
    "load_polygons_geojson_roundtrip": _with("smallv", "SELECT k, vx, vy FROM smallv"),
    "geojson_points": _with("skew", "SELECT x, y FROM skew"),
    "load_step_points_roundtrip": _with("taxi", "SELECT t, CAST(cx AS DOUBLE) AS x, CAST(cy AS DOUBLE) AS y FROM taxi"),
    "load_step_rects_roundtrip": _with("taxi", """SELECT t, CAST(cx AS DOUBLE) AS xmin, CAST(cx+1 AS DOUBLE) AS xmax,
      CAST(cy AS DOUBLE) AS ymin, CAST(cy+1 AS DOUBLE) AS ymax FROM taxi"""),
    "union_area": _with("outline", """SELECT round(sum((x1+t0*(x2-x1))*(y1+t1*(y2-y1))-(x1+t1*(x2-x1))*(y1+t0*(y2-y1)))/2, 6) AS area FROM outline"""),
    "union_boundary": _with("runs", """SELECT gid AS id, round(x1+min(t0)*(x2-x1), 6) AS x1, round(y1+min(t0)*(y2-y1), 6) AS y1,
      round(x1+max(t1)*(x2-x1), 6) AS x2, round(y1+max(t1)*(y2-y1), 6) AS y2 FROM runs GROUP BY gid, k, run, x1, y1, x2, y2"""),
    "union_parts": _with("holders outline", """SELECT part, count(*) AS polygons, round(sum(a)/2, 6) AS area FROM
      (SELECT gid, min(other) AS part FROM reach GROUP BY gid) l JOIN
      (SELECT gid, sum((x1+t0*(x2-x1))*(y1+t1*(y2-y1))-(x1+t1*(x2-x1))*(y1+t0*(y2-y1))) AS a FROM
        (SELECT gid, x1, y1, x2, y2, t0, t1 FROM outline UNION ALL SELECT gid, 0, 0, 0, 0, 0, 0 FROM polyv WHERE k=0) o GROUP BY gid) a
      ON a.gid=l.gid GROUP BY part""",
      "reach AS (SELECT gid, gid AS other FROM polyv WHERE k=0 UNION SELECT r.gid, e.b FROM reach r JOIN "
      "(SELECT gid AS a, other AS b FROM holders UNION SELECT other, gid FROM holders) e ON e.a=r.other)"),
}
SQL |= {
    "join_pts_rects_stored": SQL["join_pts_rects_pairs"],
    "join_equal_pts_rects_stored": _with("skew rects", f"SELECT {_PAIRS} FROM {_PTS_RECTS.replace('pts', 'skew')}"),
    "join_rects_rects_stored_contains": SQL["join_rects_rects_contains"],
    "join_rects_rects_stored_intersects": SQL["join_rects_rects_intersects"],
    "join_pts_polys_stored": SQL["join_pts_polys"],
    "join_polys_polys_stored_contains": SQL["join_polys_polys_contains"],
    "join_polys_polys_stored_mbr": SQL["join_polys_polys_mbr"],
}
_IN_QUERY = _with("pts", f"SELECT * FROM pts p WHERE {_in_query('p.x', 'p.y')}", _query_edges())
SQL |= {
    "range_pts_in_polygon": _IN_QUERY,
    "range_pts_in_polygon_indexed": _IN_QUERY,
    "range_rects_in_polygon": _with("rects", f"SELECT * FROM rects WHERE id IN ({_by_query('redges', False)})", f"{_query_edges()},\n{_RECT_EDGES}"),
    "range_rects_meet_polygon": _with("rects", f"SELECT * FROM rects WHERE id IN ({_by_query('redges', True)})", f"{_query_edges()},\n{_RECT_EDGES}"),
    "range_polys_in_polygon": _with("smalledges", f"SELECT gid AS id FROM ({_by_query('smalledges', False)}) s", _query_edges()),
    "range_polys_meet_polygon": _with("edges", f"SELECT gid AS id FROM ({_by_query('edges', True)}) s", _query_edges()),
}
# Rings: runs of the outline followed from end to start, both rounded, until the smallest one of a ring is known.
_REACH = ("reach AS (SELECT gid, gid AS other FROM polyv WHERE k=0 UNION SELECT r.gid, e.b FROM reach r JOIN "
          "(SELECT gid AS a, other AS b FROM holders UNION SELECT other, gid FROM holders) e ON e.a=r.other)")
_STRUNG = """sides AS (SELECT row_number() OVER (ORDER BY gid, k, min(t0)) AS n, gid, x1+min(t0)*(x2-x1) AS ax, y1+min(t0)*(y2-y1) AS ay,
      x1+max(t1)*(x2-x1) AS bx, y1+max(t1)*(y2-y1) AS by_ FROM runs GROUP BY gid, k, run, x1, y1, x2, y2),
    follows AS (SELECT a.n, b.n AS ahead FROM sides a JOIN sides b ON round(a.bx, 6)=round(b.ax, 6) AND round(a.by_, 6)=round(b.ay, 6)),
    walk AS (SELECT n, n AS seen FROM sides UNION SELECT w.n, f.ahead FROM walk w JOIN follows f ON f.n=w.seen)"""
SQL["union_rings"] = _with("holders runs", """SELECT part, CAST(row_number() OVER (PARTITION BY part ORDER BY area < 0, -abs(area), ring)-1 AS INT) AS ring, vertices,
      round(area, 5) AS area, count(*) OVER (PARTITION BY part)-1 AS holes FROM
      (SELECT l.part, r.ring, count(*) AS vertices, sum(s.ax*s.by_-s.bx*s.ay)/2 AS area
       FROM (SELECT n, min(seen) AS ring FROM walk GROUP BY n) r JOIN sides s ON s.n=r.n
       JOIN (SELECT gid, min(other) AS part FROM reach GROUP BY gid) l ON l.gid=s.gid GROUP BY l.part, r.ring) q""", _REACH + ",\n" + _STRUNG)
SQL["load_points_roundtrip"] = _with("pts", """SELECT id, x, y, concat('p,', id, ',', x, ',', y, ',rest') AS user_data FROM pts""")
