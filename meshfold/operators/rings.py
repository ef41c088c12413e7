"""Directed pieces of an outline strung into rings, without walking them one by one.

Each piece looks up the piece that starts where it ends (a join of points on a fine grid), which makes cycles. Pointer doubling then
tells every piece the smallest piece of its cycle and its distance to it, in as many joins as the longest ring has binary digits. Nothing is
collected until a ring's points are put into its array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshfold.session import stored

# Points count as one if they are nearer than this share of the largest coordinate; rounding of crossings is far below it.
_SAME = 1e-10
# Cells of the lookup grid, in units of that distance.
_CELL = 1 << 10


def _tolerance(pieces: DataFrame) -> float:
    largest = F.greatest(*(F.abs(c) for c in ("x1", "y1", "x2", "y2")))
    return (pieces.agg(F.max(largest).alias("size")).first()["size"] or 1.0) * _SAME


def _cells(x: str, y: str, reach: float, tolerance: float) -> Column:
    """The cells within ``reach`` of a point: one for most, four at most."""
    def axis(v: str) -> Column:
        low, high = (F.floor((F.col(v) + d) / (tolerance * _CELL)) for d in (-reach, reach))
        return F.array_distinct(F.array(low, high))

    return F.flatten(F.transform(axis(x), lambda i: F.transform(axis(y), lambda j: F.struct(i.alias("cell_x"), j.alias("cell_y")))))


def _followers(pieces: DataFrame, tolerance: float) -> DataFrame:
    """(piece, next, turn): every piece that starts where ``piece`` ends, and the angle from looking back to looking ahead, clockwise.

    The inside lies left of a piece, so the sector that begins at the look back, clockwise, is inside, and ends at the piece with the smallest turn.
    """
    ends = pieces.select(
        "piece", "x2", "y2", F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2")).alias("back"),
        F.inline(_cells("x2", "y2", 2 * tolerance, tolerance)))
    starts = pieces.select(
        F.col("piece").alias("next"), "x1", "y1", F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("ahead"),
        F.inline(_cells("x1", "y1", 0.0, tolerance)))
    near = (F.abs(F.col("x1") - F.col("x2")) <= 2 * tolerance) & (F.abs(F.col("y1") - F.col("y2")) <= 2 * tolerance)
    turn = F.pmod(F.col("back") - F.col("ahead"), F.lit(6.283185307179586))
    found = ends.join(starts, ["cell_x", "cell_y"]).where(near)
    return found.select("piece", "next", F.when(turn <= 1e-9, turn + 7).otherwise(turn).alias("turn"))


def _cycles(links: DataFrame) -> DataFrame:
    """(piece, next, ring, steps) for ``links`` (piece, next), a permutation: the smallest piece of the cycle, and the steps ahead to it.

    A round joins each piece's stretch with the stretch that begins where it ends. When no smallest piece changes, stretches cover their
    cycles: each is at most that of the stretch behind it, all the way round.
    """
    state, width = stored(links.select("piece", "next", F.col("next").alias("jump"), F.col("piece").alias("ring"), F.lit(0).cast("bigint").alias("steps")), "rings"), 1
    while True:
        ahead = state.select(F.col("piece").alias("jump"), F.col("jump").alias("far"), F.col("ring").alias("ring_ahead"), F.col("steps").alias("steps_ahead"))
        lower = F.col("ring_ahead") < F.col("ring")
        moved = stored(
            state.join(ahead, "jump").select(
                "piece", "next", F.col("far").alias("jump"), F.least("ring", "ring_ahead").alias("ring"),
                F.when(lower, F.col("steps_ahead") + width).otherwise(F.col("steps")).alias("steps"), lower.alias("changed")), "rings")
        changed = moved.where("changed").limit(1).count()
        state, width = moved.drop("changed"), 2 * width
        if not changed:
            return state.drop("jump")


def _split(found: DataFrame, meeting: DataFrame) -> DataFrame:
    """(piece, next) of pieces that go on elsewhere, so that no ring passes a point twice.

    ``meeting`` (piece, node): pieces that end where several do. Where a ring comes by k times, each time but the first goes on as the time before did, and the first as the
    last: k rings of the stretches in between. Stretches are nested, as rings don't cross, so this can be done at all points at once.
    """
    visits = found.join(meeting, "piece")
    order = F.when(F.col("steps") == 0, F.lit(None).cast("bigint")).otherwise(-F.col("steps"))  # along the ring, from its smallest piece
    at = Window.partitionBy("node", "ring").orderBy(order.asc_nulls_first())
    whole = Window.partitionBy("node", "ring")
    last = F.max_by("next", F.coalesce(order, F.lit(-(1 << 62)))).over(whole)
    moved = visits.withColumn("times", F.count("*").over(whole)).withColumn("other", F.coalesce(F.lag("next").over(at), last))
    return moved.where("times > 1").select("piece", "other")


def strung(pieces: DataFrame) -> DataFrame:
    """``pieces`` (x1, y1, x2, y2 and others; the inside on the left) with columns ring and place: the closed ring each belongs to, numbered
    by its smallest piece, and the place along it from 0.

    Rings may touch in points, and are then split so that none passes a point twice. Pieces shorter than rounding are left out; if the others don't close, an error is raised.
    """
    pieces = stored(pieces.withColumn("piece", F.monotonically_increasing_id()), "ring-pieces")
    tolerance = _tolerance(pieces)
    long = (F.abs(F.col("x2") - F.col("x1")) > tolerance) | (F.abs(F.col("y2") - F.col("y1")) > tolerance)
    pieces = pieces.where(long)
    followers = stored(_followers(pieces, tolerance), "ring-followers")
    chosen = followers.groupBy("piece").agg(
        F.min(F.struct("turn", "next")).alias("best"), F.min("next").alias("node"), F.count("*").alias("n"))
    chosen = stored(chosen.select("piece", "best.next", "node", "n"), "ring-links")
    counted = chosen.agg(F.count("*").alias("n"), F.count_distinct("next").alias("kinds"), F.max("n").alias("most")).first()
    if not pieces.count() == counted["n"] == counted["kinds"]:
        raise ValueError("the pieces don't close to rings")
    found = _cycles(chosen)
    if (counted["most"] or 0) > 1:
        other = stored(_split(found, chosen.where("n > 1").select("piece", "node")), "ring-splits")
        if not other.isEmpty():
            found = _cycles(found.select("piece", "next").join(other, "piece", "left").select("piece", F.coalesce("other", "next").alias("next")))
    sizes = found.groupBy("ring").agg((F.max("steps") + 1).alias("size"))
    placed = found.join(sizes, "ring").select("piece", "ring", F.when(F.col("steps") == 0, F.lit(0)).otherwise(F.col("size") - F.col("steps")).cast("bigint").alias("place"))
    return pieces.join(placed, "piece").drop("piece")


def assembled(placed: DataFrame, part: str = "part") -> DataFrame:
    """(part, rings) of pieces with columns part, ring and place: closed rings, the shell counter-clockwise and first, holes by falling area.

    A part has one shell. Its points are gathered into one value, as a polygon column holds them.
    """
    points = F.array_sort(F.collect_list(F.struct("place", F.col("x1").alias("x"), F.col("y1").alias("y"))))
    area = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    rings = placed.groupBy(part, "ring").agg(points.alias("points"), area.alias("area"))
    closed = F.expr("transform(concat(points, slice(points, 1, 1)), p -> named_struct('x', p.x, 'y', p.y))")
    ring = F.struct((F.col("area") <= 0).alias("hole"), (-F.abs("area")).alias("size"), F.col("ring"), closed.alias("points"))
    return rings.groupBy(part).agg(F.array_sort(F.collect_list(ring)).alias("rings")).select(part, F.expr("transform(rings, r -> r.points)").alias("rings"))
