"""The positional index against plain string search."""

import hashlib
import random
import re

import duckdb
import pytest

from meshfold.llm import decontamination as d

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return PATTERN.findall((text or "").translate(LOWER))


def brute(docs, items, length, slop=0):
    """(doc_id, n_words, n_hit, items, near_items) of lists of (id, text)."""
    runs = {(i, tuple(w[k : k + length])) for i, t in items if (w := words(t)) for k in range(max(1, len(w) - length + 1))}
    out = []
    for doc, text in docs:
        w, covered, exact, near = words(text), set(), set(), set()
        for i, run in runs:
            for s in range(-slop, len(w) + slop):
                if s >= 0 and tuple(w[s : s + len(run)]) == run:
                    covered.update(range(s, s + len(run)))
                    exact.add(i)
                if slop and near_at(w, run, s, slop):
                    near.add(i)
        out.append((doc, len(w), len(covered), sorted(exact - {None}), sorted((near | exact) - {None})))
    return out


def near_at(w, run, s, slop):
    """All of the run's words at most ``slop`` from their places, the run laid from ``s`` on."""
    return all(any(0 <= s + k + j < len(w) and w[s + k + j] == x for j in range(-slop, slop + 1)) for k, x in enumerate(run))


def test_words():
    assert d.words("Ab-c1 É\x00\x7f,Z".encode()) == [w.encode() for w in ("ab", "c1", "É", "z")]


def test_packing_round_trip():
    import numpy as np

    n = np.array([5, 9, 2, 2**31, 0], np.uint32)
    assert (d._unpack(d._pack(n)) == n).all()


@pytest.mark.parametrize("length", [1, 3, 10])
def test_exact_matches(spark, length, monkeypatch):
    monkeypatch.setattr(d, "SEGMENT_BYTES", 200)
    monkeypatch.setattr(d, "BLOCK_BYTES", 400)  # several blocks: their results are merged
    rng = random.Random(length)
    vocabulary = ["a", "b", "c", "é", "Dd", "e1"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(0, 14))) for i in range(12)] + [(None, text(12)), (3, None), (50, ""), (51, "a"), (52, "a")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(None, items[0][1]), (7, None), (8, ""), (9, items[1][1]), (9, items[1][1]), (10, "b " * 5000 + items[2][1] + " b" * 5000)]
    table = spark.createDataFrame([(i, t, i) for i, t in docs], "doc_id long, text string, ord long").repartition(3)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.near_items) for r in d.contamination(table, bench, length).collect()), key=repr)
    expected = sorted(((*x[:4], x[3]) for x in brute(docs, items, length)), key=repr)
    assert got == expected
    assert d.contamination(table.where("doc_id = -1"), bench).collect() == []
    assert all(r.n_hit == 0 and r["items"] == [] for r in d.contamination(table, bench.where("item_id = -1")).collect())


def test_proximity(spark):
    items = [(1, "alpha beta gamma delta")]
    docs = [(1, "x alpha beta gamma delta"), (2, "alpha x beta gamma delta"), (3, "beta alpha gamma delta"), (4, "alpha x x x beta gamma delta"), (5, "alpha beta gamma")]
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("abcdefg") for _ in range(n))
    more = [(i, text(rng.randint(0, 9))) for i in range(10, 60)]
    table, bench = spark.createDataFrame(docs + more, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in d.contamination(table, bench, 4, slop=1).collect()}
    assert {i: x for i, x in got.items() if i < 10} == {1: ([1], [1]), 2: ([], [1]), 3: ([], [1]), 4: ([], []), 5: ([], [])}
    items = [(i, text(3)) for i in range(6)]
    found = d.contamination(table, spark.createDataFrame(items, "item_id long, text string"), 3, slop=2).collect()
    assert {(r.doc_id, tuple(r["items"]), tuple(r.near_items)) for r in found} == {(x[0], tuple(x[3]), tuple(x[4])) for x in brute(docs + more, items, 3, 2)}
    with pytest.raises(ValueError):
        d.search(table, None, 40)


def test_query_agrees_with_sql(spark, sf_small):
    sql = duckdb.connect()
    for t in ("documents", "benchmark"):
        sql.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    got = sorted(tuple(r) for r in d.op1_decontamination(spark, sf_small).collect())
    assert got == sorted(sql.execute(d.SQL).fetchall())
    assert sum(r[5] for r in got) > 0
    assert got[0][4] == hashlib.sha256(b"").hexdigest() or got[0][3] > 0
