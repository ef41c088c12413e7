"""The curve, recall against brute force, and ties."""

import itertools

import numpy as np

from meshfold.llm import neighbours


def test_hilbert_curve_visits_all_cells_by_single_steps():
    for axes, bits in ((1, 4), (2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        keys = neighbours.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def brute(rows, every, k):
    """(query_id, rank, vec_id, score) over distinct valid (vec_id, vector) rows."""
    out = []
    for q, x in rows:
        if q % every == 0:
            scored = sorted((-float(np.dot(np.float64(x), np.float64(y))), i) for i, y in rows if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    valid = [(i, np.float32(rng.normal(size=6) * rng.choice([0.5, 1, 4])).tolist()) for i in range(200)]
    valid += [(i, valid[7][1]) for i in range(300, 360)]  # copies: ties to the smaller id
    broken = [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, None] + [0.0] * 4), (404, [float("nan")] * 6), (405, [float("inf")] + [0.0] * 5), (420, [1.0, 2.0]), (None, [1.0] * 6)]
    rows = valid + broken + valid[:20]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, v int, vec string").repartition(5)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest(table, 20, 10, curves=4).collect())
    expected = sorted(brute(valid, 20, 10))
    assert [x[:3] for x in got] == [x[:3] for x in expected]
    assert np.allclose([x[3] for x in got], [x[3] for x in expected], rtol=1e-12)
    assert neighbours.nearest(table.where("vec_id = -1")).collect() == []
    few = neighbours.nearest(table.where("vec_id < 3"), 1, 20, curves=2).collect()
    assert len({(r.query_id, r.vec_id) for r in few}) == 6


def test_recall_of_the_windows(spark, sf_small, monkeypatch):
    """With windows far smaller than the table, so that the curves decide."""
    monkeypatch.setattr(neighbours, "LEAST", 16)
    monkeypatch.setattr(neighbours, "PARTS", 32)
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    expected = {(q, i) for q, _, i, _ in brute(rows, 20, 20)}
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(table).collect()}
    assert len(got & expected) >= 0.9 * len(expected)


def test_query(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    expected = {x[:3]: x[3] for x in brute(rows, 20, 20)}
    got = {(r.query_id, r["rank"], r.vec_id): r.score for r in neighbours.op6_neighbours(spark, sf_small).collect()}
    assert len(set(got) & set(expected)) >= 0.9 * len(expected)
    assert all(abs(got[x] - expected[x]) < 1e-12 for x in set(got) & set(expected))
