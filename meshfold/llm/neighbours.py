"""Approximate nearest neighbours by shifted Hilbert curves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshfold.llm.common import prepare, stored

#: Curves; axes each projects to and bits of an axis (their product fits a long).
CURVES, AXES, BITS, SEED = 32, 12, 4, 11
#: A query sees all rows of its stretch of each curve and of the two beside it. A stretch has ``1 / PARTS`` of the rows, ``LEAST`` at least.
PARTS, LEAST = 96, 512
#: Vectors the projections' ranges are taken from, queries compared in one task at once, and vectors kept beyond k to settle ties and rounding.
SAMPLE, TILE, SPARE = 10_000, 4096, 4


# ---------------------------------------------------------------- the curve

def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points given by ``bits``-bit cell numbers (rows: points, columns: axes).

    From the highest bit down the cell's position in the current subcube is read in Gray order, and the axes are reflected
    or swapped into that subcube's orientation.
    """
    x = cells.astype(np.uint64).T.copy()
    axes = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for i in range(axes):
            upper = (x[i] & high) != 0
            swap = np.where(upper, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(bit)) & np.uint64(1), np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(bit)) & np.uint64(1))
    return key.astype(np.int64)


@dataclass
class Curves:
    """Rotations, shifts and ranges of the curves, and the largest norm of all vectors.

    The largest inner product becomes the smallest distance by one more axis, on which a vector has what its norm lacks of the
    largest and a query, scaled to the largest norm, has 0.
    """

    rotations: np.ndarray
    low: np.ndarray
    width: np.ndarray
    norm: float

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        size = np.linalg.norm(x, axis=1, keepdims=True)
        if query:
            return np.hstack([x * (self.norm / size), np.zeros_like(size)])
        return np.hstack([x, np.sqrt(np.maximum(self.norm**2 - size**2, 0))])

    def keys(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Keys by curve (rows) and vector (columns)."""
        lifted = self.lifted(x.astype(np.float64), query)
        cells = [np.clip((lifted @ r - low) / width * (1 << BITS), 0, (1 << BITS) - 1) for r, low, width in zip(self.rotations, self.low, self.width)]
        return np.stack([hilbert_keys(c, BITS) for c in cells])


def fit_curves(sample: np.ndarray, norm: float, curves: int, seed: int) -> Curves:
    """Random rotations; each axis's range in the sample is widened to twice its length and shifted by a random part of it."""
    rng, out = np.random.default_rng(seed), Curves(np.empty(0), np.empty(0), np.empty(0), norm)
    dimension = sample.shape[1] + 1
    axes = min(AXES, dimension)
    rotations = np.stack([np.linalg.qr(rng.normal(size=(dimension, axes)))[0] for _ in range(curves)])
    both = np.concatenate([out.lifted(sample, False), out.lifted(sample, True)])
    spread = np.einsum("nd,cda->cna", both, rotations)
    low, length = spread.min(axis=1), np.maximum(np.ptp(spread, axis=1), 1e-12)
    return Curves(rotations, low - rng.random(low.shape) * length, 2 * length, norm)


# ---------------------------------------------------------------- search

def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _compare(keep: int):
    """Best ``keep`` candidates of each query of a group; rows come sorted by group, queries before candidates, and only the queries are held."""

    def emit(ids, best, scores):
        row, column = np.nonzero(np.isfinite(scores))
        return pa.RecordBatch.from_arrays([pa.array(ids[row], pa.int64()), pa.array(best[row, column], pa.int64()), pa.array(scores[row, column], pa.float64())], ["query", "v", "score"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, vectors, best, scores = None, [], [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("curve", "stretch", "tile", "kind")])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                here, kind = tuple(key[:3, a].tolist()), key[3, a]
                v, x = batch.column("v").to_numpy()[a:b], _matrix(batch.column("vec").slice(a, b - a), np.float32)
                if here != group:
                    if best is not None:
                        yield emit(np.concatenate(ids), best, scores)
                    group, ids, vectors, best, scores = here, [], [], None, None
                if kind == 0:
                    ids.append(v)
                    vectors.append(x)
                    continue
                if not ids:
                    continue
                if best is None:
                    queries = np.concatenate(vectors)
                    best, scores = np.zeros((len(queries), keep), np.int64), np.full((len(queries), keep), -np.inf)
                rough = queries @ x.T
                n = min(keep, len(v))
                top = np.argpartition(-rough, n - 1, axis=1)[:, :n]
                exact = np.einsum("qd,qnd->qn", queries.astype(np.float64), x.astype(np.float64)[top])
                best, scores = np.hstack([best, v[top]]), np.hstack([scores, exact])
                order = np.lexsort((best, -scores), axis=-1)[:, :keep]
                best, scores = np.take_along_axis(best, order, 1), np.take_along_axis(scores, order, 1)
        if best is not None:
            yield emit(np.concatenate(ids), best, scores)

    return scan


def valid_vectors(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Distinct (vec_id, vec: array<float>) of the vectors that take part."""
    e = F.col("vec")
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<float>").alias("vec"))
    rows = rows.where(F.col("vec_id").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda c: c != 0))
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vec") == (common[0] if common else 0)).distinct()


def nearest(table: DataFrame, every: int = 20, k: int = 20, curves: int = CURVES, seed: int = SEED, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the ``k`` rows of largest inner product found.

    Equal vectors are one vector with its k + 1 smallest ids, so copies fill no window. Each curve orders all vectors; Spark
    sorts them by range, and what a query meets in its stretch and the two beside it is ranked, first in single precision, what is
    kept in double. Candidates of all curves are merged by query. Only projections' ranges come from a sample, of ``SAMPLE``
    vectors; all are indexed.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do null ids and vectors of another than the most
    common length (of two, the greater). Repeated rows count once. Equal scores go to the smaller vec_id. An empty table gives an empty
    result; further columns are not read.
    """
    spark = table.sparkSession
    prepare(spark)
    rows = stored(valid_vectors(table, vec_id, embedding), "vectors")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    firsts = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    copies = firsts.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where(is_query)
    vectors = stored(
        copies.join(asked.select("vec").distinct().withColumn("q", F.lit(True)), "vec", "left")
        .select(F.col("ids")[0].alias("v"), "vec", "ids", F.coalesce("q", F.lit(False)).alias("q")), "vectors-distinct")
    n, norm = vectors.agg(F.count("*"), F.max(F.expr("sqrt(aggregate(vec, 0D, (a, x) -> a + CAST(x AS double) * x))"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array([r.vec for r in vectors.orderBy(F.xxhash64("v")).limit(SAMPLE).select("vec").collect()], np.float64)
    held = spark.sparkContext.broadcast(fit_curves(sample, float(norm), curves, seed))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("vec").flatten().to_numpy().astype(np.float32).reshape(batch.num_rows, -1)
            v, q = batch.column("v").to_numpy(), batch.column("q").to_numpy(zero_copy_only=False).astype(bool)
            for kind, part in ((0, q), (1, np.ones(len(v), bool))):
                if part.any():
                    keys, data = held.value.keys(x[part], kind == 0), pa.array([r.tobytes() for r in x[part]], pa.binary())
                    for curve, key in enumerate(keys):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(key), c), pa.int32()) for c in (curve, kind)] + [pa.array(key, pa.int64()), pa.array(v[part], pa.int64()), data],
                            ["curve", "kind", "key", "v", "vec"])

    ordered = vectors.select("v", "q", "vec").mapInArrow(keyed, "curve int, kind int, key long, v long, vec binary")
    ordered = ordered.repartitionByRange("curve", "key", "v").sortWithinPartitions("curve", "key", "v", "kind")
    ordered = stored(ordered.withColumns({"part": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}), "vectors-curves")
    parts = ordered.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("curve", "part", (before - F.col("first")).alias("start"))
    reach = max(LEAST, -(-n // PARTS))
    tiles = -(-asked.count() * 3 * reach // (n * TILE)) or 1
    placed = ordered.join(F.broadcast(starts), ["curve", "part"]).withColumn("stretch", F.expr(f"(seq + start) DIV {reach}"))
    around, tile = F.expr("sequence(stretch - 1, stretch + 1)"), F.pmod(F.xxhash64("v"), F.lit(tiles)).cast("int")
    columns = ["curve", "stretch", "tile", "kind", "v", "vec"]
    queries = placed.where("kind = 0").withColumn("tile", tile).withColumn("stretch", F.explode(around)).select(*columns)
    candidates = placed.where("kind = 1").withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(*columns)
    dealt = queries.union(candidates).repartition("curve", "stretch", "tile").sortWithinPartitions("curve", "stretch", "tile", "kind")
    found = dealt.mapInArrow(_compare(k + 1 + SPARE), "query long, v long, score double")
    best = found.groupBy("query").agg(F.slice(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("s"), "v"))), 1, k + 1 + SPARE).alias("b"))
    best = best.select("query", F.explode("b").alias("b")).select("query", "b.s", "b.v").join(vectors.select("v", "ids"), "v")
    lists = best.select("query", "s", F.explode("ids").alias("id")).groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("s", "id"))), 1, k + 1).alias("b"))
    owners = asked.join(vectors.where("q").select("vec", F.col("v").alias("query")), "vec").select(F.col("vec_id").alias("query_id"), "query")
    own = owners.join(lists, "query").select("query_id", F.posexplode(F.slice(F.filter("b", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("p", "x"))
    return own.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.s")).alias("score"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
