"""Components over the forest against all pairs of whole sets."""

import os
import random
import re

import duckdb
import numpy as np
import pytest

from meshfold.llm import forest

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_components(sets, share=85):
    """The smallest position reachable over all pairs."""
    label = list(range(len(sets)))
    find = lambda i: i if label[i] == i else find(label[i])
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= share * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


def family(rng, members, words, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    return [" ".join(edited(rng, base, rng.randint(0, edits))) for _ in range(members)]


@pytest.mark.parametrize("region", [None, 4])
def test_components_are_those_of_all_pairs(spark, monkeypatch, region):
    if region:  # every region is crowded: deeper prefixes, one of each component, and the rest
        monkeypatch.setattr(forest, "REGION", region)
    rng = random.Random(5)
    texts = [t for words, edits in ((200, 6), (60, 2), (400, 20), (30, 1), (12, 1), (300, 9)) for t in family(rng, 40, words, edits)]
    texts += family(rng, 1, 300, 0) * 3
    passage = " ".join(f"shared{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"own{rng.randrange(10**6)}" for _ in range(rng.randint(1, 60))) for _ in range(60)]
    rng.shuffle(texts)
    got = forest.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect()
    sets = [plain_set(t) for t in texts]
    want = plain_components(sets)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i in range(len(texts))}
    assert 20 < len(set(want)) < len(texts) - 100


def test_rest_meets_all_pairs_of_different_labels(spark, monkeypatch):
    monkeypatch.setattr(forest, "REGION", 5)
    rows = [(k, i, label) for k in range(3) for i, label in enumerate([900] * 23 + [901] * (7 * k) + [1, 2, 2, 3, 4, 5, 6, 7] + [902] * 5)]
    dealt = forest._rest(spark.createDataFrame(rows, "key long, id long, label long")).toPandas()
    met = {}
    for (key, i, j), run in dealt.groupby(["key", "i", "j"]):
        for a in run.itertuples():
            for b in run.itertuples():
                if a.id < b.id and (i == j or a.tile != b.tile):
                    met[key, a.id, b.id] = met.get((key, a.id, b.id), 0) + 1
    want = {(k, a, b) for k, a, x in rows for l, b, y in rows if k == l and a < b and x != y}  # noqa: E741
    assert want <= set(met) and set(met.values()) == {1}
    assert not any(x == y == 900 for x, y in ((dict((i, lab) for k, i, lab in rows if k == key)[a], dict((i, lab) for k, i, lab in rows if k == key)[b]) for key, a, b in met))


def test_signatures_estimate_the_share():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    for share in (0.5, 0.85, 0.95):
        same = int(len(a) * 2 * share / (1 + share))
        b = np.unique(np.concatenate([a[:same], rng.integers(0, 1 << 63, len(a) - same).astype(np.uint64)]))
        assert abs((forest.signature(a) == forest.signature(b)).mean() - share) < 0.13
    orders = forest._orders()
    assert sorted(orders[:16].ravel().tolist()) == sorted(orders[16:].ravel().tolist()) == list(range(128))
    keys = forest.prefix_keys(np.stack([forest.signature(a), forest.signature(a)]), 4)
    assert (keys[0] == keys[1]).all() and (keys[0] >> np.uint64(59)).tolist() == list(range(32))


def test_edge_cases(spark):
    long = " ".join(f"lang{i % 70_000}" for i in range(120_000))
    rows = [(9, None, "x"), (1, "", "x"), (2, " \t\n", None), (5, "One two", "x"), (4, "one  TWO", "x"), (4, "one  TWO", "x"), (None, long, "x"), (8, long + " end", "x"),
            (7, "É è", "x"), (3, "a b c d e", "x"), (6, "a b c d e f", "x"), (None, "alone here", "x"), (0, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string").selectExpr("*", "id AS `a.b`", "1 AS label").repartition(3)
    got = forest.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None) == [
        (0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 4, False), (6, 2, 6, True), (7, 1, 7, True),
        (8, 70_001, 8, True), (9, 0, 9, True)]
    assert sorted(((r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None), key=repr) == [(1, None, True), (70_000, 8, False)]
    kept = forest.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.select("doc_id").toPandas().doc_id.fillna(-1).tolist()) == [-1, 0, 1, 2, 3, 4, 6, 7, 8, 9]
    empty = docs.where("doc_id = -1")
    assert forest.near_duplicates(empty).collect() == [] and forest.keep_one(empty).collect() == []


def test_query(spark, sf_small):
    got = sorted(map(tuple, forest.op11_minhash_forest(spark, sf_small).collect()))
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    assert got == sorted(sql.execute(forest.SQL).fetchall())
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").collect()
    want = plain_components([plain_set(d.text) for d in docs])
    assert [(r[0], r[2]) for r in got] == [(d.doc_id, docs[w].doc_id) for d, w in zip(docs, want)]


def test_sets_are_not_stored_and_few_texts_are_sent(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"{rng.randrange(10**4):04d}" for _ in range(1500)) for _ in range(150)]
    for base in [text.split() for text in texts[:30]]:  # these meet in regions but are far from alike: about half of the shingles are shared
        texts.append(" ".join(edited(rng, base, 100)))
    texts += family(rng, 2, 1500, 3)
    folder, kept = {}, forest.stored

    def stored(df, name):
        out = kept(df, name)
        folder.setdefault(name, []).extend(out.inputFiles())
        return out

    sent, confirmed = [], forest._confirmed
    monkeypatch.setattr(forest, "stored", stored)
    monkeypatch.setattr(forest, "_confirmed", lambda members, *rest: sent.append(members.select("id").distinct().count()) or confirmed(members, *rest))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in forest.near_duplicates(docs).collect()}
    assert got == dict(enumerate(plain_components([plain_set(t) for t in texts])))
    size = sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for files in folder.values() for f in files)
    assert 0 < size < 0.3 * sum(map(len, texts))
    assert max(sent) <= 4


def test_rows_picked_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(forest, "BROADCAST_IDS", 0)
    rng = random.Random(9)
    texts = [t for _ in range(8) for t in family(rng, 6, 120, 2)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 5 + [(None, texts[7])] * 3 + [(50, None), (51, "")]
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = plain_components([plain_set(t) for t in texts])
    assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got if r.doc_id is not None and r.doc_id < 50} == dict(enumerate(want))
    assert {r.component_id for r in got if r.doc_id is None} == {want[7]}
