"""The chain against enumeration, and held-out accuracy."""

import itertools
import zlib

import numpy as np

from meshfold.llm import quality


def test_marginals_are_those_of_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 5, 3])
    good, steps = rng.normal(size=12) * 3, rng.normal(size=(2, 2))
    p, pairs, log_z = quality.marginals(good, steps, quality.Padded(lengths))
    at, total, z_all, expected = 0, np.zeros((2, 2)), 0.0, []
    for n in lengths:
        weights, ones, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(good[at + i] for i in range(n) if labels[i]) + sum(steps[a, b] for a, b in zip(labels, labels[1:])))
            weights += w
            ones += w * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                moves[a, b] += w
        expected += (ones / weights).tolist()
        total += moves / weights
        z_all += np.log(weights)
        at += n
    assert np.allclose(p, expected) and np.allclose(pairs, total) and np.isclose(log_z, z_all)


def test_fit_climbs_the_likelihood_and_uses_neighbours():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 6, 300)
    labels = rng.integers(0, 2, 300)
    x = rng.normal(size=(lengths.sum(), quality.WIDTH)).astype(np.float32)
    x[:, 0] += np.repeat(labels, lengths)
    x[:, -1] = 1
    chain = quality.fit(x, lengths, labels)
    p, _, _ = quality.marginals(chain.scores(x), chain.steps, quality.Padded(lengths))
    assert ((p > 0.5) == np.repeat(labels, lengths)).mean() > 0.75
    assert chain.steps[0, 0] + chain.steps[1, 1] > chain.steps[0, 1] + chain.steps[1, 0]


def test_held_out_accuracy(spark, sf_small):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    got = quality.op3_quality(spark, sf_small).collect()
    assert len(got) == spark.read.parquet(f"{sf_small}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    rest = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rest) >= 0.9 * len(rest)


def test_held_out_labels_are_never_read(spark, sf_small):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert (a.weights == b.weights).all() and (a.steps == b.steps).all()


def test_edge_cases(spark, sf_small):
    from pyspark.sql import functions as F

    rows = [(1, None, 0.5), (2, "", 0.5), (3, "\n\n \n", 0.5), (None, "x\n" * 20_000, 0.5), (4, "Word " * 50_000, None), (4, "Word " * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality double").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (4, 1, 0), (None, 1, 0), (2, None, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    chain = quality.train(docs.drop("quality"), labels)
    got = quality.score(docs, chain).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == by[3]
    assert quality.train(docs.drop("quality"), labels.where("doc_id = 9")) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(docs.where("doc_id = 9"), chain).collect() == []


def test_the_sample_is_drawn_from_the_documents(spark, monkeypatch):
    """Labels of a hundred times as many other documents leave no empty sample, nor do documents that are all long."""
    monkeypatch.setattr(quality, "TRAIN_DOCS", 20)
    good, bad = "The river ran past the old mill, and nobody spoke.\n" * 300, "$$$ CLICK >>> 100% @@@ ###\n" * 300
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, good if i % 2 else bad, 1) for i in ids], "doc_id long, text string, `a.b` int")
    labels = spark.range(6000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    chain = quality.train(docs, labels)
    got = quality.score(docs, chain).collect()
    assert len(got) == len(ids) and all(r.predicted == r.doc_id % 2 and r["a.b"] == 1 for r in got)
