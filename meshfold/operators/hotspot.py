"""Space-time hot spots: the Getis-Ord Gi* score of every cell of a (time step, x, y) cube.

Counting is a partial aggregation, so a cell holding a third of all rows costs no more than another. From
there on the work is bounded by the number of cells, not by the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("t", "cx", "cy")


@dataclass(frozen=True)
class Cube:
    """Inclusive bounds per axis. The defaults are the city cube: lat*100, lon*100, days of a month (fixed values)."""

    t: tuple[int, int] = (1, 31)
    cx: tuple[int, int] = (4050, 4089)
    cy: tuple[int, int] = (-7425, -7369)

    @property
    def n(self) -> int:
        sizes = [high - low + 1 for low, high in (self.t, self.cx, self.cy)]
        return sizes[0] * sizes[1] * sizes[2]

    def holds(self) -> Column:
        return F.expr(" AND ".join(f"{a} BETWEEN {getattr(self, a)[0]} AND {getattr(self, a)[1]}" for a in AXES))


# The city's box in degrees (fixed values).
CITY_LAT = (40.5, 40.9)
CITY_LON = (-74.25, -73.70)


def trips_in_box(
    trips: DataFrame, lat: str = "lat", lon: str = "lon",
    lat_range: tuple[float, float] = CITY_LAT, lon_range: tuple[float, float] = CITY_LON,
) -> DataFrame:
    """Drops trips that start outside the city's box."""
    return trips.where(F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range))


def trip_cells(
    trips: DataFrame, time: str = "pickup", lat: str = "lat", lon: str = "lon", binning: str = "floor",
) -> DataFrame:
    """(t, cx, cy) of each trip: day of month, and degrees * 100 cut to a whole number by ``binning``:

    ``floor``, ``truncate`` (towards 0) or ``round`` (to two digits, then truncate).
    """
    cut = {
        "floor": lambda c: F.floor(c),
        "truncate": lambda c: c,
        "round": lambda c: F.floor(c * 100 + 0.5) / 100,
    }
    if binning not in cut:
        raise ValueError(f"binning must be one of {sorted(cut)}, not {binning!r}")
    return trips.select(
        F.dayofmonth(time).alias("t"),
        cut[binning](F.col(lat) * 100).cast("int").alias("cx"),
        cut[binning](F.col(lon) * 100).cast("int").alias("cy"),
    )


def cell_counts(cells: DataFrame) -> DataFrame:
    """(t, cx, cy, n): rows per cell."""
    return cells.groupBy(*AXES).agg(F.count("*").alias("n"))


def cube_cells(spark, cube: Cube) -> DataFrame:
    """Every cell of the cube, generated in parallel."""
    (t0, _), (x0, x1), (y0, y1) = cube.t, cube.cx, cube.cy
    nx, ny = x1 - x0 + 1, y1 - y0 + 1
    return spark.range(cube.n).selectExpr(
        f"CAST(id DIV {nx * ny} + {t0} AS INT) AS t",
        f"CAST(id DIV {ny} % {nx} + {x0} AS INT) AS cx",
        f"CAST(id % {ny} + {y0} AS INT) AS cy",
    )


def _weight(cube: Cube) -> Column:
    """Cells of the 3x3x3 neighbourhood that lie in the cube: a product over the axes."""
    product = F.lit(1)
    for axis in AXES:
        low, high = getattr(cube, axis)
        c = F.col(axis)
        product = product * (F.least(c + 1, F.lit(high)) - F.greatest(c - 1, F.lit(low)) + 1)
    return product


def neighbourhood_sums(counts: DataFrame, cube: Cube = Cube()) -> DataFrame:
    """(t, cx, cy, s, s2): sum of counts and of squared counts over the 3x3x3 neighbourhood, clipped to the cube.

    The sum over a cube is a sum along each axis in turn: a cell hands its sums to itself and its two neighbours on one axis, these are
    added up, partly before the shuffle, and so on. No step makes more than three rows of one. Cells without counted neighbours do not appear.
    """
    sums = counts.where(cube.holds()).select(*AXES, F.col("n").alias("s"), (F.col("n") * F.col("n")).alias("s2"))
    for axis in AXES:
        low, high = getattr(cube, axis)
        near = F.explode(F.array(F.col(axis) - 1, F.col(axis), F.col(axis) + 1)).alias(axis)
        spread = sums.select(*(c for c in (*AXES, "s", "s2") if c != axis), near).where(F.col(axis).between(low, high))
        sums = spread.groupBy(*AXES).agg(F.sum("s").alias("s"), F.sum("s2").alias("s2"))
    return sums


def gi_star(
    counts: DataFrame, cube: Cube = Cube(), stats: str = "global", dense: bool = False, int_division: bool = False,
) -> DataFrame:
    """(cx, cy, t, z, s, s2, w): Gi* score per cell.

    ``stats='global'`` takes mean and deviation over all cells of the cube, ``'local'`` from each neighbourhood's own sums.
    ``dense`` returns all cells of the cube, else those with a counted neighbour. ``int_division`` truncates
    the ratio under the root, as integer arithmetic does. A denominator of 0 gives the score 0.
    """
    if stats not in ("global", "local"):
        raise ValueError(f"stats must be 'global' or 'local', not {stats!r}")
    n = float(cube.n)
    sums = neighbourhood_sums(counts, cube)
    if dense:
        sums = cube_cells(counts.sparkSession, cube).join(sums, list(AXES), "left").fillna(0, ["s", "s2"])
    sums = sums.withColumn("w", _weight(cube))
    if stats == "global":
        total = counts.where(cube.holds()).agg(
            (F.coalesce(F.sum("n"), F.lit(0)) / n).alias("mean"),
            (F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)) / n).alias("mean2"),
        )
        sums = sums.join(F.broadcast(total))  # one row
    else:
        sums = sums.withColumn("mean", F.col("s") / n).withColumn("mean2", F.col("s2") / n)
    w = F.col("w")
    ratio = (n * w - w * w) / (n - 1)
    # Rounding may leave a tiny negative variance when all counts are equal.
    deviation = F.sqrt(F.greatest(F.col("mean2") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    scored = sums.withColumn("below", deviation * F.sqrt(F.floor(ratio) if int_division else ratio))
    z = F.when(F.col("below") > 0, (F.col("s") - F.col("mean") * w) / F.when(F.col("below") > 0, F.col("below")))
    return scored.select("cx", "cy", "t", z.alias("z"), "s", "s2", "w").fillna(0.0, ["z"])


def hottest(scores: DataFrame, top: int | None = 50) -> DataFrame:
    """Cells by falling score; ``None`` returns all of them. Cells with equal scores are all kept, in key order."""
    ordered = scores.orderBy(F.desc("z"), *AXES)
    return ordered if top is None else ordered.limit(top)


def unit_squares(spark, cube: Cube = Cube()) -> DataFrame:
    """(id, t, cx, cy, xmin .. ymax): one unit square per cell, the windows for counting by spatial join.

    A point on the line between two squares lies in both.
    """
    (t0, _), (x0, x1), (y0, y1) = cube.t, cube.cx, cube.cy
    return cube_cells(spark, cube).selectExpr(
        f"((CAST(t AS BIGINT) - {t0}) * {x1 - x0 + 1} + (cx - {x0})) * {y1 - y0 + 1} + (cy - {y0}) AS id",
        "t", "cx", "cy", "CAST(cx AS DOUBLE) AS xmin", "CAST(cx + 1 AS DOUBLE) AS xmax",
        "CAST(cy AS DOUBLE) AS ymin", "CAST(cy + 1 AS DOUBLE) AS ymax",
    )
