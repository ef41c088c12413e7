"""Exact shard sizes, the draw's distribution, and rows that survive whole."""

import random
import zlib
from collections import Counter
from math import comb

import pytest

from meshfold.llm import sharding


def test_hypergeometric_has_its_distribution():
    rng, n = random.Random(1), 40_000
    found = Counter(sharding.hypergeometric(rng, 10, 15, 8) for _ in range(n))
    for k in range(9):
        p = comb(10, k) * comb(15, 8 - k) / comb(25, 8)
        assert abs(found[k] / n - p) < 5 * (p / n) ** 0.5 + 1e-4
    assert sharding.hypergeometric(rng, 0, 5, 3) == 0 and sharding.hypergeometric(rng, 5, 0, 3) == 3
    big = [sharding.hypergeometric(rng, 10**10, 3 * 10**10, 10**9) for _ in range(200)]
    assert abs(sum(big) / 200 - 2.5e8) < 5 * 13_700 / 200**0.5


def test_matrix_has_exact_margins():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(0, 50) for _ in range(rng.randint(1, 9))]
        total, shards = sum(sizes), rng.randint(1, 8)
        targets = [total // shards + (s < total % shards) for s in range(shards)]
        matrix = sharding.communication_matrix(sizes, targets, rng.random())
        assert [sum(r) for r in matrix] == sizes and [sum(c) for c in zip(*matrix)] == targets


def test_shuffle_is_uniform(spark):
    """Each row meets each shard and slot equally often over many seeds."""
    rows = spark.range(6).repartition(2)
    seen = Counter()
    for seed in range(30):
        for r in sharding.shard(rows, 2, seed).collect():
            seen[r.id, r.shard] += 1
    assert all(3 <= seen[i, s] <= 27 for i in range(6) for s in range(2))


def test_shards_of_repeated_and_null_rows(spark):
    rows = [(None, None)] * 100 + [(1, "x")] * 200 + [(i, "y") for i in range(103)]
    table = spark.createDataFrame(rows, "doc_id long, rank string").withColumnRenamed("rank", "cut_").repartition(5)
    got = sharding.shard(table).collect()
    assert Counter((r.doc_id, r.cut_) for r in got) == Counter(rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert max(Counter(r.shard for r in got if r.doc_id == 1).values()) < 60  # copies are spread
    assert sharding.shard(table.where("doc_id = -1")).collect() == []
    assert len(sharding.shard(spark.range(3).withColumnRenamed("id", "doc_id")).collect()) == 3
    clash = table.selectExpr("doc_id", "cut_ AS slot", "doc_id AS rank", "doc_id AS row_", "cut_ AS in_", "1 AS slice_")
    found = sharding.shard(clash).collect()
    assert Counter((r.doc_id, r.in_) for r in found) == Counter(rows) and {r.shard for r in found} == set(range(8))
    with pytest.raises(ValueError):
        sharding.shard(table, 0)


def test_query(spark, sf_small):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    found = sharding.op2_sharding(spark, sf_small)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    got = found.collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items()}
    assert Counter(r.shard for r in got).most_common()[0][1] <= -(-len(docs) // 8)
