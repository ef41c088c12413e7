"""Uniform sharding by a hypergeometric communication matrix."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.llm.common import packed, ranked, stored

SHARDS, SEED = 8, 20_240
#: Rows of the matrix at most; further partitions share rows.
MATRIX_ROWS = 4096


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` items taken without replacement from ``good`` + ``bad`` are good.

    By inversion around the mode: ratios of neighbouring probabilities are multiplied outwards over twelve standard
    deviations; what lies beyond is below double precision.
    """
    total = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    reach = 60 + int(12 * (draws * (good / total) * (bad / total)) ** 0.5)
    up = np.arange(mode + 1, min(high, mode + reach) + 1, dtype=float)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=float)
    above = np.cumprod((good - up + 1) * (draws - up + 1) / (up * (bad - draws + up)))
    below = np.cumprod(down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1)))
    weights = np.cumsum(np.concatenate([below[::-1], [1.0], above]))
    return mode - len(below) + int(np.searchsorted(weights, rng.random() * weights[-1], "right"))


def communication_matrix(sizes: list[int], targets: list[int], seed: int) -> list[list[int]]:
    """Rows of partition i that go to shard s, as a uniformly random permutation of all rows would send them.

    Row sums are ``sizes``, column sums ``targets``. The partitions draw one after the other, each from what the shards have left:
    a multivariate hypergeometric draw made of one draw for each shard.
    """
    rng, left, matrix = random.Random(seed), list(targets), []
    for size in sizes:
        rest, others, row = size, sum(left), []
        for s, room in enumerate(left):
            others -= room
            n = hypergeometric(rng, room, others, rest)
            row.append(n)
            rest -= n
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def shard(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with columns shard (0 to ``shards`` - 1) and slot: a uniform shuffle in which the shards' numbers of rows differ by at
    most one and slots are gapless from 0.

    The rows are stored with their partition and a running number. The partitions' sizes reach the driver (``MATRIX_ROWS`` numbers
    at most), which draws the exact number of rows from each partition to each shard. Rows are then permuted within their partition
    and cut by that matrix's row, exchanged, and permuted within their shard. Hashes of the running number order the rows, never values:
    equal and null rows are spread like any other, and an empty table gives an empty result. Columns shard and slot of
    ``rows`` are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark, rows = rows.sparkSession, packed(rows, replaced=("shard", "slot"))
    kept = stored(rows.withColumns({"part_": F.pmod(F.spark_partition_id(), F.lit(MATRIX_ROWS)), "row_": F.monotonically_increasing_id()}), "shard-rows")
    sizes = {r[0]: r[1] for r in kept.groupBy("part_").count().collect()}
    total = sum(sizes.values())
    targets = [total // shards + (s < total % shards) for s in range(shards)]
    random.Random(seed).shuffle(targets)
    parts = sorted(sizes)
    matrix = communication_matrix([sizes[p] for p in parts], targets, seed + 1)
    bounds = [(p, [sum(row[: s + 1]) for s in range(shards)]) for p, row in zip(parts, matrix)]
    cuts = spark.createDataFrame(bounds, "cut_part_ int, cuts_ array<long>")
    placed = (
        ranked(kept, "part_", "row_", seed + 2, "shard-local").withColumnRenamed("rank", "place_")
        .join(F.broadcast(cuts), F.col("part_") == F.col("cut_part_"))
        .withColumn("shard", F.size(F.filter("cuts_", lambda c: c <= F.col("place_"))))
        .drop("part_", "cut_part_", "cuts_", "place_")
    )
    return ranked(stored(placed, "shard-exchange"), "shard", "row_", seed + 4, "shard-slots").select("in_.*", "shard", F.col("rank").alias("slot"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    narrow = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                         F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32"))
    return shard(narrow).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard"))
