"""Helpers shared by the operators: stored tables, runs of equal keys, links, components and ranks.

Nothing here holds a whole group in one task: runs of equal keys are streamed from sorted partitions and dealt
in tiles of bounded size, ranks are counted in slices, and components are found by joins.
"""

from __future__ import annotations

import atexit
import os
import shutil
import site
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshfold.session import new_folder, stored  # noqa: F401  (for the operators)

#: Members of a run compared in one task at once; larger runs are dealt in pairs of tiles.
TILE = 8192


def prepare(spark: SparkSession) -> None:
    """Bounds Arrow batches to 1,000 rows, so that long texts fit a worker, and sees that workers find this package.

    An installed package, or one on PYTHONPATH or in the working folder, is found anyway; else a session gets it once, as ``--py-files`` would do.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    root = Path(__file__).resolve().parents[2]
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    if any(p and Path(p).resolve() == root for p in known) or spark.sparkContext.applicationId in _sent:
        return
    folder = tempfile.mkdtemp()  # the driver serves the file from there to the end
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/meshfold.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "meshfold").rglob("*.py")):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(archive)
    _sent.add(spark.sparkContext.applicationId)


_sent: set[str] = set()


def bounded_scan(df: DataFrame, *columns: str) -> DataFrame:
    """The columns alone, for a scan in Python."""
    prepare(df.sparkSession)
    return df.select(*columns)


def packed(df: DataFrame, *beside: Column | str, replaced: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as one struct column in_, without the columns that the result replaces, and the columns ``beside`` again: working columns then
    clash with none of its names."""
    kept = [c for c in df.columns if c.lower() not in replaced]
    return df.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("in_"), *beside)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch as UTF-8 (null: empty), in slices of about ``limit`` bytes: (first row, texts)."""
    col = batch.column(column)
    col = col.fill_null("").cast(pa.large_binary()) if not pa.types.is_null(col.type) else pa.array([b""] * len(col), pa.large_binary())
    first, size, texts = 0, 0, []
    for text in (x.as_py() for x in col):
        if texts and size + len(text) > limit:
            yield first, texts
            first, size, texts = first + len(texts), 0, []
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def _arrays(batch: pa.RecordBatch) -> list:
    return [c.to_numpy(zero_copy_only=False) if pa.types.is_integer(c.type) else c for c in batch.columns]


# ---------------------------------------------------------------- runs of equal keys

def _multi_runs(tile: int) -> Callable:
    """Of partitions sorted by (key, id): the distinct members of runs with two or more, numbered in tiles."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, count, held = None, None, 0, None  # of the run that is open; its first member waits for a second
        for batch in batches:
            keys, ids = _arrays(batch)
            if not len(keys):
                continue
            same_key = np.empty(len(keys), bool)
            same_key[1:], same_key[0] = keys[1:] == keys[:-1], keys[0] == key
            fresh = np.empty(len(keys), bool)
            fresh[1:], fresh[0] = ids[1:] != ids[:-1], ids[0] != last
            keep = ~same_key | fresh
            keys, ids, same_key = keys[keep], ids[keep], same_key[keep]
            if not len(keys):
                continue
            begins = np.flatnonzero(~same_key)
            place = np.arange(len(keys))
            base = np.zeros(len(keys), np.int64)
            base[begins] = place[begins]
            base = np.maximum.accumulate(base)
            rank = place - base
            head = len(keys) if not len(begins) else begins[0]
            rank[:head] += count
            multi = np.zeros(len(keys), bool)
            multi[:-1] |= same_key[1:]
            multi |= same_key
            out = [(keys[multi], ids[multi], rank[multi] // tile)]
            if held is not None and head:
                out.insert(0, (np.array([held[0]]), np.array([held[1]]), np.zeros(1, np.int64)))
                held = None
            elif len(begins):
                held = None
            open_alone = not multi[-1] and not same_key[-1]
            if open_alone:
                held = (keys[-1], ids[-1])
            key, last, count = keys[-1], ids[-1], int(rank[-1]) + 1
            k, i, c = (np.concatenate(x) for x in zip(*out))
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(i, pa.int64()), pa.array(c, pa.int64())], ["key", "id", "tile"])

    return scan


def multi_runs(members: DataFrame, name: str, tile: int = TILE) -> DataFrame:
    """``members`` (key, id: longs) in keys shared by two or more ids, as a stored table (key, id, tile)."""
    dealt = members.select("key", "id").repartition("key").sortWithinPartitions("key", "id")
    return stored(dealt.mapInArrow(_multi_runs(tile), "key long, id long, tile long"), name)


def tile_pairs(multi: DataFrame) -> DataFrame:
    """``multi`` with columns (i, j): each pair of tiles of a key meets once. A key of one tile is copied nowhere."""
    large = multi.groupBy("key").agg(F.max("tile").alias("last")).where("last > 0")
    pairs = F.expr("transform(sequence(0L, coalesce(last, 0L)), t -> struct(least(t, tile) AS i, greatest(t, tile) AS j))")
    return multi.join(large, "key", "left").withColumn("pair", F.explode(pairs)).select(*multi.columns, "pair.i", "pair.j")


class Forest:
    """Union-find over positions 0 to n - 1."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: int, others: np.ndarray) -> None:
        """Put the components of ``others`` and ``a`` together."""
        old = np.unique(self.label[others])
        self.label[np.isin(self.label, old)] = self.label[a]


def run_links(tiles: DataFrame, columns: list[str], near: Callable) -> DataFrame:
    """Links (a, b) that join what is linked within each (key, i, j) of ``tiles`` (key, i, j, tile, id, columns...).

    ``near(held, x, others)``: which of the positions ``others`` are linked with position ``x``, as a mask. Of the links
    of a run only those that join two parts are emitted, so a run of m members gives fewer than m rows, and members
    already joined are not compared again.
    """
    order = ["key", "i", "j", "tile", "id"]
    dealt = tiles.select(*order, *columns).repartition("key", "i", "j").sortWithinPartitions(*order)

    def compare(table: pa.Table) -> Iterator[tuple]:
        i, j, tile, ids = (table.column(n).to_numpy() for n in ("i", "j", "tile", "id"))
        held = {n: table.column(n).combine_chunks() for n in columns} | {"id": ids}
        across, forest = i[0] != j[0], Forest(len(ids))
        for x in range(len(ids) - 1):
            others = np.arange(x + 1, len(ids))
            others = others[forest.label[others] != forest.label[x]]
            if across:
                others = others[tile[others] != tile[x]]
            if len(others):
                found = others[near(held, x, others)]
                if len(found):
                    _, first = np.unique(forest.label[found], return_index=True)
                    yield np.full(len(first), ids[x]), ids[found[first]]
                    forest.join(x, found)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in whole_runs(batches, ("key", "i", "j")):
            found = list(compare(run))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(scan, "a long, b long")


def whole_runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of the rows of one key each, from batches sorted by ``keys`` (integers without nulls)."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            values = batch.column(k).to_numpy()
            change[1:] |= values[1:] != values[:-1]
            change[0] |= bool(rest) and values[0] != rest[-1].column(k)[-1].as_py()
        ends = np.flatnonzero(change)
        start = 0
        for end in ends:
            if end > start:
                rest.append(batch.slice(start, end - start))
            yield pa.Table.from_batches(rest)
            rest, start = [], end
        rest.append(batch.slice(start))
    if rest:
        yield pa.Table.from_batches(rest)


# ---------------------------------------------------------------- components

def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component: its smallest node) of the graph of ``links`` (a, b: longs); nodes without a link are left out.

    Alternating large and small stars: each round every node's larger neighbours, then its smaller ones, are hung on
    the smallest. Minima are taken by partial aggregation, rounds are stored tables, and the end is reached when a
    round changes nothing.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        sides = edges.union(edges.select("b", "a")) if large else edges
        least = F.least("a", F.min("b")) if large else F.min("b")
        least = stored(sides.groupBy("a").agg(least.alias("m")), name)  # read by itself: Spark can then split a hub in the join
        hung = sides.where("b > a") if large else sides
        hung = hung.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            hung = hung.union(least.select("a", F.col("m").alias("b")))
        return hung.where("a != b").distinct()

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), name)
    before = mark(edges)
    while before[0]:
        edges = stored(star(star(edges, True), False), name)
        after = mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


# ---------------------------------------------------------------- ranks

def ranked(rows: DataFrame, group: str, unique: str, seed: int, name: str, per_slice: int = 1_000) -> DataFrame:
    """``rows`` with column rank: a random order of each group, gapless from 0.

    ``group`` has no nulls and a bounded number of values. A group is dealt over slices of about ``per_slice`` rows by a hash of the unique
    long column, slices are counted, and rows are numbered within their slice: a group of any size is ranked by many tasks.
    ``rows`` should be a stored table: it is read three times.
    """
    groups = stored(rows.groupBy(group).agg(F.ceil(F.count("*") / per_slice).alias("slices_")), name)
    sliced = rows.join(F.broadcast(groups), group).withColumn("slice_", F.pmod(F.xxhash64(F.lit(seed), F.col(unique)), F.col("slices_"))).drop("slices_")
    sizes = stored(sliced.groupBy(group, "slice_").agg(F.count("*").alias("n_")), name)
    before = F.coalesce(F.sum("n_").over(Window.partitionBy(group).orderBy("slice_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(group, "slice_", before.alias("start_"))
    order = Window.partitionBy(group, "slice_").orderBy(F.xxhash64(F.lit(seed + 1), F.col(unique)), F.col(unique))
    numbered = sliced.withColumn("at_", F.row_number().over(order) - 1)
    return numbered.join(starts, [group, "slice_"]).withColumn("rank", (F.col("start_") + F.col("at_")).cast("long")).drop("slice_", "start_", "at_")
