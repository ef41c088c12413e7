"""Runs against a loop over all periods and starts, the query against the contract read word by word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meshfold.llm import periodic


def plain_runs(words, least, repeats):
    """Every period: maximal stretches of words equal to the one a period on; a stretch of a smaller period counts for that one."""
    n, found = len(words), {}
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i + p - start
            if length >= max(least, repeats * p):
                found.setdefault((start, length), p)
    return sorted(((s, k, p) for (s, k), p in found.items()), key=lambda r: (r[0], r[2]))


def found(words, least, repeats):
    return periodic.find_runs(np.array(words, np.int64), least, repeats)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(1, 12), st.integers(3, 5))
def test_runs_of_short_alphabets(words, least, repeats):
    assert found(words, least, repeats) == plain_runs(words, least, repeats)


def test_runs_of_built_texts():
    rng = random.Random(7)
    for trial in range(150):
        words = []
        while len(words) < rng.randint(30, 400):
            unit = [rng.randint(0, rng.choice([1, 3, 50])) for _ in range(rng.randint(1, 25))]
            words += (unit * rng.randint(1, 12))[: rng.randint(1, 200)]
        least, repeats = rng.choice([(24, 3), (10, 3), (24, 4), (1, 3)])
        assert found(words, least, repeats) == plain_runs(words, least, repeats)
    nested = ([1, 2] * 12 + [3]) * 9  # runs within the periods of a run
    assert found(nested, 24, 3) == plain_runs(nested, 24, 3)
    assert len(found(nested, 24, 3)) == 10


def test_long_texts_take_no_square_time():
    n = 60_000
    assert found([1] * n, 24, 3) == [(0, n, 1)]
    assert found(list(range(1000)) * (n // 1000), 24, 3) == [(0, n, 1000)]
    passage = list(range(20))
    many = [x for i in range(3000) for x in [*passage, 100 + i]]  # a passage with ever other neighbours
    assert found(many, 24, 3) == []
    with pytest.raises(ValueError):
        found([1, 1], 2, 2)


def plain_query(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 24, 3)
    gone = {i for s, k, p in runs for i in range(s + p, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{k},{p}\n" for s, k, p in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_is_brute_force(spark, sf_small):
    got = {r.doc_id: tuple(r)[1:] for r in periodic.op13_periodic_runs(spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    assert got == {d.doc_id: plain_query(d.doc_id, d.text) for d in docs}
    assert sum(r[0] > 0 for r in got.values()) > 5


def test_edge_cases(spark, tmp_path):
    rows = [(1, None, "x", 1), (2, "", None, 2), (3, " \t\n", "x", 3), (4, "a b " * 40, "x", 4), (4, "a b " * 40, "x", 4), (None, "é e\n" * 30, "x", 5),
            (6, "one two three", "x", 6), (7, " ".join(["lang"] * 200_000), "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, runs long").repartition(3)
    made = periodic.periodic_runs(docs)
    assert made.columns == ["doc_id", "text", "a.b", "n_words", "runs", "collapsed"]
    got = {r.doc_id: r for r in made.collect()}
    assert made.count() == len(rows)
    assert [tuple(x) for x in got[4].runs] == [(0, 80, 2)] and got[4].collapsed == "a b" and got[4].n_words == 80
    assert [tuple(x) for x in got[None].runs] == [(0, 30, 1)] and got[None].collapsed == "é e"
    assert [(got[i].n_words, got[i].runs, got[i].collapsed) for i in (1, 2, 3)] == [(0, [], "")] * 3
    assert got[6].collapsed == "one two three" and [tuple(x) for x in got[7].runs] == [(0, 200_000, 1)]
    assert periodic.periodic_runs(docs.where("doc_id = -1")).collect() == []
    (tmp_path / "t").mkdir()
    few = [(i, t) for i, t, *_ in rows[:-1]] + [(i, " ".join(f"w{j}" for j in range(i))) for i in range(20, 60)]
    spark.createDataFrame(few, "doc_id long, text string").write.parquet(f"{tmp_path}/t/documents.parquet")
    query = sorted((tuple(r) for r in periodic.op13_periodic_runs(spark, f"{tmp_path}/t").collect()), key=repr)
    assert query == sorted(((i, *plain_query(i, t)) for i, t in few), key=repr)
