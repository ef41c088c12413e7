"""The cell join: spatial joins as equi-joins on grid cells, sized to the data.

Every window gets a *tier* from its larger extent: tier t holds windows with extent in
(4^(t-1), 4^t] and is indexed on square cells of side 4^t / 2. A window so covers between
one and nine cells, whatever its size, and nothing is ever capped. Cell sides are powers of two,
which makes ``floor(x / side)`` exact and monotone; no pair can be lost to rounding.

Objects inside windows (``inside=True``): if an object lies in a window, so does its lower left
corner. The object is therefore a single key per tier in use, however large it is, and each pair
meets in exactly one cell.

Objects meeting windows (``inside=False``): both sides cover cells. A pair meets on the larger of
its two tiers, and counts only in the cell that holds the lower left corner of the intersection;
so again each pair comes out once and no ``distinct`` is needed.

Which join runs is decided by weighing, before the join, the rows each side would put into it:

* one side small (`BROADCAST_BYTES`): that side is broadcast, the other is not shuffled at all;
* both large: shuffle on the cell, with a hint, so that no estimate can turn it back into a broadcast. Cells are finer then, and objects
  of a cell packed into arrays before they meet its windows: what holds for all of a pack is settled once. Cells with too many rows on a side, or too many pairs to test, are split: each side is dealt into parts by a hash of its id and copied
  to each part of the other. The crowded cells are found from a sample, which only steers the work and never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.functions.geometry import Box, Sql, bind_sql, box, box_contains_point, boxes_intersect
from meshfold.session import stored

OBJECT_ID, WINDOW_ID = "object_id", "window_id"
OBJECT, WINDOW = "o_", "w_"  # column prefixes of the two sides
# Extents that are indexed apart: points like windows of 4^-20, endless windows like ones of 4^511, the largest in doubles.
_MIN_TIER, _MAX_TIER = -20, 511
# An extent counts as at least this share of the coordinates' size, so that cell numbers stay exact far from the origin.
_GRAIN = 2.0**-48
_LARGEST = 1.7976931348623157e308

BROADCAST_BYTES = 64 << 20
SAMPLE_ROWS = 2_000_000
PART_ROWS = 500_000  # rows of one side that one part of a cell should hold
PART_PAIRS = 1_000_000_000  # pairs that one part of a cell should test
LISTED_CELLS = 200_000  # crowded cells in a broadcast list; a longer list is joined by a shuffle
COUNTED_PAIRS = 10**12  # points times windows, beyond which their number per window is found without pairs
PACK_ROWS = 4_096  # points of a cell in one array
_PACK_HALVINGS = 4  # cells of a sixteenth to a quarter of the windows' extent: most pairs lie in cells that the window covers
_TASKS_A_CORE = 4  # tasks of a shuffled join, at least
_TASK_BYTES = 128 << 20  # of a side in a task of a shuffled join
# Cells of a shuffled join: of an eighth to a half of the windows' extent for objects inside, so that most pairs lie in cells that settle them; of a
# quarter to the whole where both sides cover cells.
_FINE_INSIDE, _FINE_MEETING = 3, 2
_CORNER = ("first_x", "first_y")
_SEEN = 50  # sampled rows a crowded cell should have
# Grids a window may be moved down by: 16 times the cells for each, all made by the task that holds the window.
_MOST_MOVES = 3


@dataclass(frozen=True)
class Limits:
    """Sizes that choose the plan. They never change the result; tests lower them."""

    broadcast_bytes: int = BROADCAST_BYTES
    sample_rows: int = SAMPLE_ROWS
    part_rows: int = PART_ROWS
    part_pairs: int = PART_PAIRS
    counted_pairs: int = COUNTED_PAIRS


def _tier(b: Box) -> Column:
    """Smallest t with extent <= 4^t. ``log2`` of a double is the same on every executor (StrictMath)."""
    size = F.greatest(*(F.abs(c) for c in b))
    extent = F.greatest(b.xmax - b.xmin, b.ymax - b.ymin, size * _GRAIN)
    found = F.greatest(F.ceil(F.log2(F.least(extent, F.lit(_LARGEST))) / 2).cast("int"), F.lit(_MIN_TIER))
    known = b.xmax.isNotNull() & b.xmin.isNotNull() & b.ymax.isNotNull() & b.ymin.isNotNull()
    found = F.least(found, F.lit(_MAX_TIER))
    return F.when(known & (extent > 0), found).when(known & (extent <= 0), F.lit(_MIN_TIER))  # null bounds: no tier, no cell, no pair


def _side(tier: Column | int, halvings: int) -> Column:
    if isinstance(tier, int):
        return F.lit(4.0**tier / 2**halvings)
    return F.pow(F.lit(4.0), tier) / 2**halvings


def _cell(value: Column, side: Column) -> Column:
    """Endless values lie in the cell of the largest number."""
    return F.floor(F.least(F.greatest(value, F.lit(-_LARGEST)), F.lit(_LARGEST)) / side)


def _covered(low: Column, high: Column, side: Column) -> Column:
    return F.explode(F.sequence(_cell(low, side), _cell(high, side)))


def _cover(df: DataFrame, prefix: str, tier: str, halvings: int) -> DataFrame:
    """One row per covered cell of the grid of column ``tier``."""
    b, side = box(prefix), _side(F.col(tier), halvings)
    return (
        df.withColumn("cell_x", _covered(b.xmin, b.xmax, side))
        .withColumn("cell_y", _covered(b.ymin, b.ymax, side))
        .withColumnRenamed(tier, "cell_tier")
    )


def _n_cells(b: Box, tier: Column, halvings: int) -> Column:
    side = _side(tier, halvings)
    return (_cell(b.xmax, side) - _cell(b.xmin, side) + 1) * (_cell(b.ymax, side) - _cell(b.ymin, side) + 1)


def _row_weight(df: DataFrame, prefix: str) -> Column:
    """Bytes of a row, about: a head, a word a column, and the numbers of its edges."""
    plain = F.lit(24.0 + 16 * len(df.columns))
    return plain + 40 * F.coalesce(F.size(prefix + "edges"), F.lit(0)) if prefix + "edges" in df.columns else plain


def _tiers_in_use(df: DataFrame, prefix: str, halvings: int) -> dict[int, tuple[float, float]]:
    """tier -> (weight of its rows, weight once they cover cells). Some sixty tiers exist at most."""
    b, weight = box(prefix), _row_weight(df, prefix)
    rows = (
        df.select(*b, weight.alias("weight"), _tier(b).alias("tier")).groupBy("tier")
        .agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * _n_cells(b, F.col("tier"), halvings)).alias("cells"))
    )
    return {r["tier"]: (r["n"], r["cells"]) for r in rows.collect() if r["tier"] is not None}


def _total_weight(df: DataFrame, prefix: str) -> float:
    return df.agg(F.sum(_row_weight(df, prefix)).alias("n")).first()["n"] or 0.0


def _merged_tiers(tiers: dict[int, tuple[float, float]], budget: float) -> tuple[dict[int, int], float]:
    """Grid tier of each window tier, and the weight of all windows once they cover the cells of their grid.

    Every grid in use costs one more key per object. A tier with few windows, such as some huge ones among many
    small, is therefore indexed on the grid of the tier below, at up to 16 times the cells per step, as long as
    that adds less than ``budget`` and no window goes down by more than `_MOST_MOVES` grids.
    """
    grid = {t: t for t in tiers}
    cells = {t: c for t, (_, c) in tiers.items()}
    for upper, lower in zip(sorted(tiers, reverse=True), sorted(tiers, reverse=True)[1:]):
        if max(t for t, g in grid.items() if g == upper) - lower > _MOST_MOVES:
            continue
        moved = cells[upper] * 16.0 ** (upper - lower)
        if moved <= budget:
            grid = {t: lower if g == upper else g for t, g in grid.items()}
            cells[lower] += moved
            del cells[upper]
            budget -= moved
    return grid, sum(cells.values())


def cell_join(
    objects: DataFrame,
    windows: DataFrame,
    predicate: Column,
    on: Sequence[str] = (),
    inside: bool = True,
    limits: Limits = Limits(),
    halvings: int = 1,
    per_cell: tuple[Sequence[str], Sql] | None = None,
    settled: Column | None = None,
) -> DataFrame:
    """All (object, window) rows that satisfy ``predicate``, each exactly once.

    ``objects`` holds ``object_id`` and ``o_xmin .. o_ymax``, ``windows`` holds ``window_id`` and
    ``w_xmin .. w_ymax``; further columns pass through. ``on`` names columns both sides
    share and must agree on. With ``inside`` the predicate has to imply that the object's
    lower left corner lies in the window's box, without it that the two boxes intersect.
    ``halvings`` sets the cell side, 4^tier / 2^halvings. ``per_cell`` rewrites the window rows knowing the cell their
    objects are in: the columns it replaces, and the SQL of an array of structs with the new columns (empty
    to drop the row), in which ``cell_`` stands for the cell's bounds. ``settled``, for objects inside, says of a window row whether
    the predicate holds for all objects of its cell if the window covers that; objects are packed only where it is given, or both sides cover cells.
    """
    tiers, plain = _tiers_in_use(windows, WINDOW, halvings), windows
    windows = windows.withColumn("w_tier", _tier(box(WINDOW)))
    object_weight, pack = None, None if settled is None else []
    if inside:
        grid, right_weight = _merged_tiers(tiers, limits.broadcast_bytes / 4)
        if right_weight > limits.broadcast_bytes:
            object_weight = _total_weight(objects, OBJECT)
            if pack is not None and halvings < _FINE_INSIDE and object_weight * len(tiers) > limits.broadcast_bytes:
                finer = _tiers_in_use(plain, WINDOW, _FINE_INSIDE)
                if sum(c for _, c in finer.values()) <= object_weight * len(tiers):
                    tiers, halvings = finer, _FINE_INSIDE
            grid, right_weight = _merged_tiers(tiers, object_weight / 4)
        # A generator, so that null checks on the tier stay above it instead of repeating the bounds' computation.
        windows = windows.withColumn("w_tier", F.explode(F.array(_mapped(F.col("w_tier"), grid))))
        left = _corner_keys(objects, sorted(set(grid.values())), halvings)
        right = _cover(windows, WINDOW, "w_tier", halvings)
        left_copies = len(set(grid.values()))
    else:
        object_tiers = _tiers_in_use(objects, OBJECT, halvings)
        left_weight, right_weight = _cover_weight(object_tiers, tiers), _cover_weight(tiers, object_tiers)
        if min(left_weight, right_weight) > limits.broadcast_bytes and halvings < _FINE_MEETING:
            halvings = _FINE_MEETING
            tiers, object_tiers = _tiers_in_use(plain, WINDOW, halvings), _tiers_in_use(objects, OBJECT, halvings)
            left_weight, right_weight = _cover_weight(object_tiers, tiers), _cover_weight(tiers, object_tiers)
        objects = objects.withColumn("o_tier", _tier(box(OBJECT)))
        left = _cover(_shared_tiers(objects, "o_tier", sorted(tiers)), OBJECT, "tier", halvings)
        right = _cover(_shared_tiers(windows, "w_tier", sorted(object_tiers)), WINDOW, "tier", halvings)
        left, right, here = *(_with_corner(df, prefix, halvings) for df, prefix in ((left, OBJECT), (right, WINDOW))), _meets_here()
        pack = ["o_tier", *(OBJECT + c for c in _CORNER)]
        predicate = boxes_intersect(box(OBJECT), box(WINDOW)) & here & predicate
    if per_cell is not None:
        replaced, rows = per_cell
        bounds = ("named_struct('xmin', cell_x * s_, 'xmax', (cell_x + 1) * s_, 'ymin', cell_y * s_, 'ymax', (cell_y + 1) * s_)")
        side = f"pow(4D, cell_tier) / {2**halvings}D"
        # A generator, so that no filter is moved below it and computed over again.
        made = F.inline(F.expr(bind_sql(side, "s_", bind_sql(bounds, "cell_", rows))))
        right = right.select(*(c for c in right.columns if c not in replaced), made)

        if right_weight > limits.broadcast_bytes:  # rows were dropped and made lighter: weigh them again
            right_weight = _total_weight(right, WINDOW)

    key = ["cell_tier", "cell_x", "cell_y", *on]
    if inside:
        left_weight = None if object_weight is None else object_weight * left_copies
    if right_weight <= limits.broadcast_bytes:
        joined = _hash_join(left, F.broadcast(right), key, on, predicate, None)
    elif (left_weight := _total_weight(objects, OBJECT) * left_copies if left_weight is None else left_weight) <= limits.broadcast_bytes:
        joined = _hash_join(F.broadcast(left), right, key, on, predicate, None)
    else:
        if pack is not None:
            right = right.withColumn("settled_", F.lit(False) if settled is None else settled & _covers_cell(halvings))
        joined = dealt_join(left, left_weight, right, right_weight, key, on, predicate, limits, pack, F.lit(True) if inside else here).drop("settled_")
    return joined.drop("o_tier", "w_tier", *(p + c for p in (OBJECT, WINDOW) for c in _CORNER))


def _cover_weight(own: dict[int, tuple[float, float]], other: dict[int, tuple[float, float]]) -> float:
    """One cover on the own tier, at most 4 cells on each higher one of the other side."""
    return sum(cells + 4 * n * len([t for t in other if t > tier]) for tier, (n, cells) in own.items())


def _covers_cell(halvings: int) -> Column:
    """The window covers its cell, whose bounds have to be exact; not the last cells, which also hold what is endless."""
    w, side, covered = box(WINDOW), _side(F.col("cell_tier"), halvings), F.lit(True)
    for cell, low, high in (("cell_x", w.xmin, w.xmax), ("cell_y", w.ymin, w.ymax)):
        first, last = F.col(cell) * side, (F.col(cell) + 1) * side
        covered = covered & (F.abs(cell) < 1 << 52) & (low <= first) & (last <= high) & (first > -_LARGEST) & (last < _LARGEST)
    return covered


def dealt_join(
    left: DataFrame, left_weight: float, right: DataFrame, right_weight: float, key: list[str], on: Sequence[str], predicate: Column, limits: Limits,
    pack: list[str] | None = None, packs: Column | None = None,
) -> DataFrame:
    """Both sides shuffled on ``key``, crowded cells dealt into parts. Rows hold ``object_id`` and ``window_id``.

    With a list of columns, ``pack``, the left rows of a cell that agree on them are packed before the join; ``packs`` tests a pack and a window
    by these columns, and a window's ``settled_`` stands for the predicate on all of a pack's rows.
    """
    left, right = _split_crowded(left, left_weight, right, right_weight, key, limits)
    # Few bytes a cell can mean many pairs: tasks by number, which aren't put together by their bytes.
    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), _TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    if pack is not None:
        tasks = max(tasks, int(max(left_weight, right_weight) / _TASK_BYTES))
    return _hash_join(left, right, [*key, "left_part", "right_part"], on, predicate, tasks, pack, packs)


def packed(df: DataFrame, cell: str, by: Sequence[str]) -> DataFrame:
    """``(cell, *by, packed_)``: arrays of up to `PACK_ROWS` of the rows that agree on ``cell``, by which they have to be dealt already, and ``by``."""
    order = [cell, *by]
    chunk = F.shiftright(F.monotonically_increasing_id(), PACK_ROWS.bit_length() - 1).alias("chunk_")
    rows = F.struct(*(c for c in df.columns if c not in order)).alias("packed_")
    chunked = df.sortWithinPartitions(*order).select(*order, chunk, rows)
    return chunked.groupBy(*order, "chunk_").agg(F.collect_list("packed_").alias("packed_")).drop("chunk_")


def unpacked(df: DataFrame) -> DataFrame:
    return df.select(*(c for c in df.columns if c != "packed_"), F.inline("packed_"))


def _hash_join(
    left: DataFrame, right: DataFrame, key: list[str], on: Sequence[str], predicate: Column, tasks: int | None,
    pack: list[str] | None = None, packs: Column | None = None,
) -> DataFrame:
    """Equi-join on ``key`` by way of one BIGINT hash of it: one number is quicker to look up and to sort than
    several. The key itself is compared as well, so that colliding hashes do no harm; as two inequalities, lest the
    optimizer makes it part of the join key again; after the predicate, which few candidates pass.
    """
    right_names = {c: f"right_{c}" for c in key}
    right = right.withColumnsRenamed(right_names)
    same = F.lit(True)
    for c, other in right_names.items():
        same = same & (F.col(c) >= F.col(other)) & (F.col(c) <= F.col(other))
    left = left.withColumn("cell", F.xxhash64(*key))
    right = right.withColumn("right_cell", F.xxhash64(*right_names.values()))
    if tasks:
        left, right = left.repartition(tasks, "cell"), right.repartition(tasks, "right_cell")
        if pack is not None:
            left = packed(left, "cell", [*key, *pack])
        left, right = left.hint("merge"), right.hint("merge")
    joined = left.join(right, F.col("cell") == F.col("right_cell"))
    if pack is None:
        joined = joined.where(predicate & same)
    else:
        joined = unpacked(joined.where(same & packs)).where(F.col("settled_") | predicate)
    return joined.drop("cell", "right_cell", *right_names.values(), *(c for c in key if c not in on))


def grouped_cell_join(
    points: DataFrame, windows: DataFrame, on: Sequence[str] = (), limits: Limits = Limits(), held: int = 100_000, pack_rows: int = PACK_ROWS,
) -> DataFrame:
    """``(*on, window_id, most, objects)``: arrays of the ids of the points in each window; each pair is in one of them.

    ``points`` holds ``object_id``, ``o_xmin`` and ``o_ymin``. The points of a cell are packed into arrays of about ``pack_rows`` before
    the join, so a window meets a cell in one row: the array as it is where the window covers the cell, a filtered one elsewhere. No
    row is made for a pair. Windows go to all arrays of a crowded cell. ``most`` is a bound on the window's points, the sum of the cells it meets,
    or 0 if that is ``held`` or less. Rows without an id are left out.
    """
    halvings, many = _PACK_HALVINGS, F.lit(1).cast("bigint")
    grid, _ = _merged_tiers(_tiers_in_use(windows, WINDOW, halvings), _total_weight(points, OBJECT) / 4)
    windows = windows.withColumn("w_tier", _tier(box(WINDOW)))
    windows = windows.withColumn("w_tier", F.explode(F.array(_mapped(F.col("w_tier"), grid))))
    key = ["cell_tier", "cell_x", "cell_y", *on]
    right = _cover(windows, WINDOW, "w_tier", halvings)
    left = _corner_keys(points, sorted(set(grid.values())), halvings).where("cell_x IS NOT NULL AND cell_y IS NOT NULL AND object_id IS NOT NULL")
    def listed(df: DataFrame, name: str) -> tuple[DataFrame, int]:
        df = stored(df, name)
        n = df.count()
        return (F.broadcast(df) if n <= LISTED_CELLS else df), n

    counts, _ = listed(left.groupBy(*key).agg(F.count("*").alias("rows")), "cell-counts")
    bounds = right.select(WINDOW_ID, *key).join(counts, key).groupBy(WINDOW_ID).agg(F.sum("rows").alias("most"))
    large, n_large = listed(bounds.where(F.col("most") > held), "crowded-windows")
    crowded, n_crowded = listed(counts.select(*key, F.ceil(F.col("rows") / pack_rows).alias("parts")).where("parts > 1"), "crowded-cells")
    most = F.lit(0).cast("bigint")
    if n_large:
        right, most = right.join(large, WINDOW_ID, "left"), F.coalesce("most", most)
    if n_crowded:
        left, right = left.join(crowded, key, "left"), right.join(crowded, key, "left")
        many = F.coalesce("parts", many)
    deal = F.pmod(F.xxhash64(OBJECT_ID), many).alias("deal")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), many - 1)).alias("deal")
    point = F.struct(F.col("o_xmin").alias("x"), F.col("o_ymin").alias("y"), F.col(OBJECT_ID))
    left = left.select(*key, deal, point.alias("point")).groupBy(*key, "deal").agg(F.collect_list("point").alias("points"))
    right = right.select(*key, copies, WINDOW_ID, most.alias("most"), *box(WINDOW))

    w, covered = box(WINDOW), _covers_cell(halvings)
    inside = F.filter("points", lambda p: box_contains_point(w, p["x"], p["y"]))
    joined = left.hint("merge").join(right.hint("merge"), [*key, "deal"])
    found = joined.select(*on, WINDOW_ID, "most", F.when(covered, F.col("points")).otherwise(inside).alias("points"))
    return found.where(F.size("points") > 0).select(*on, WINDOW_ID, "most", F.col(f"points.{OBJECT_ID}").alias("objects"))


def _mapped(tier: Column, grid: dict[int, int]) -> Column:
    for own, other in grid.items():
        if own != other:
            tier = F.when(F.col("w_tier") == own, F.lit(other)).otherwise(tier)
    return tier


def _corner_keys(objects: DataFrame, tiers: list[int], halvings: int) -> DataFrame:
    """One row per tier in use, in the cell of the object's lower left corner."""
    x, y = F.col(OBJECT + "xmin"), F.col(OBJECT + "ymin")
    keys = [
        F.struct(
            F.lit(t).alias("cell_tier"),
            _cell(x, _side(t, halvings)).alias("cell_x"), _cell(y, _side(t, halvings)).alias("cell_y"),
        )
        for t in tiers or [0]
    ]
    if len(keys) == 1:
        return objects.select("*", *(keys[0][n].alias(n) for n in ("cell_tier", "cell_x", "cell_y")))
    return objects.select("*", F.inline(F.array(*keys)))


def _shared_tiers(df: DataFrame, own: str, others: list[int]) -> DataFrame:
    """One row for the own tier, if the other side reaches down to it, and one for each higher tier of the other side."""
    other = F.array(*map(F.lit, others)).cast("array<int>")
    higher = F.filter(other, lambda t: t > F.col(own))
    lower = F.exists(other, lambda t: t <= F.col(own))
    own_tier = F.when(lower, F.array(F.col(own))).otherwise(F.array().cast("array<int>"))
    return df.withColumn("tier", F.explode(F.concat(own_tier, higher)))


def _with_corner(df: DataFrame, prefix: str, halvings: int) -> DataFrame:
    """Whether the cell is the first one the row covers, on either axis."""
    b, side = box(prefix), _side(F.col("cell_tier"), halvings)
    return df.withColumns({prefix + c: F.col(cell) == _cell(low, side) for c, cell, low in zip(_CORNER, ("cell_x", "cell_y"), (b.xmin, b.ymin))})


def _meets_here() -> Column:
    """The pair belongs to the larger of its tiers and to the cell of the lower left corner of the intersection: the first one of either side on each axis."""
    first = ((F.col(OBJECT + c) | F.col(WINDOW + c)) for c in _CORNER)
    return next(first) & next(first) & ((F.col("cell_tier") == F.col("o_tier")) | (F.col("cell_tier") == F.col("w_tier")))


def _split_crowded(
    left: DataFrame, left_weight: float, right: DataFrame, right_weight: float, key: list[str], limits: Limits,
) -> tuple[DataFrame, DataFrame]:
    """Deal crowded cells into parts: (cell, i, j) joins part i of the left with part j of the right."""
    parts = _crowded(left, left_weight, right, right_weight, key, limits)

    def deal(df: DataFrame, id_column: str, own: str, other: str) -> DataFrame:
        if parts is None:
            return df.withColumns({own: F.lit(0).cast("bigint"), other: F.lit(0).cast("bigint")})
        one = F.lit(1).cast("bigint")
        listed = df.join(parts, key, "left").withColumns({f"{c}s": F.coalesce(f"{c}s", one) for c in (own, other)})
        return (
            listed.withColumn(own, F.pmod(F.xxhash64(id_column), F.col(f"{own}s")))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}s") - 1)))
            .drop(f"{own}s", f"{other}s")
        )

    return deal(left, OBJECT_ID, "left_part", "right_part"), deal(right, WINDOW_ID, "right_part", "left_part")


def _crowded(
    left: DataFrame, left_weight: float, right: DataFrame, right_weight: float, key: list[str], limits: Limits,
) -> DataFrame | None:
    """(key, left_parts, right_parts) of the cells in which a side has more rows, or both more pairs, than a task should get.

    Both sides are sampled, densely enough that a crowded cell is seen `_SEEN` times. Too many pairs are
    halved, as it were, on the side with more rows a part until they fit. The list is stored, so that a task run again
    sees the same parts; it is broadcast if it has few rows, and None if it is empty.
    """
    def counts(df: DataFrame, weight: float, name: str) -> DataFrame:
        rows = weight / (24.0 + 16 * len(df.columns))
        fraction = min(1.0, max(limits.sample_rows / max(rows, 1), _SEEN / limits.part_rows))
        keys = df.select(*key)
        sample = keys if fraction == 1.0 else keys.sample(fraction, seed=7)
        return sample.groupBy(*key).agg((F.count("*") / fraction).alias(name))

    both = counts(left, left_weight, "l").join(counts(right, right_weight, "r"), key, "full").fillna(1.0, ["l", "r"])
    l, r = F.col("l"), F.col("r")
    left_parts, right_parts = (F.ceil(c / limits.part_rows) for c in (l, r))
    # Pairs of a part beyond the limit: more parts, of the side whose parts are longer first, of both in equal measure then.
    excess = F.greatest(l * r / (F.col("left_parts") * F.col("right_parts")) / limits.part_pairs, F.lit(1.0))
    more = both.withColumns({"left_parts": left_parts, "right_parts": right_parts}).withColumn("excess", excess)
    long_left, long_right = l / F.col("left_parts"), r / F.col("right_parts")
    to_left = F.least(F.greatest(F.sqrt(F.col("excess") * long_left / long_right), F.lit(1.0)), F.col("excess"))
    more = more.withColumn("to_left", to_left).select(
        *key, F.ceil(F.col("left_parts") * F.col("to_left")).alias("left_parts"),
        F.ceil(F.col("right_parts") * F.col("excess") / F.col("to_left")).alias("right_parts"),
    ).where("left_parts > 1 OR right_parts > 1")
    listed = stored(more, "crowded-cells")
    n = listed.count()
    return (F.broadcast(listed) if n <= LISTED_CELLS else listed) if n else None
