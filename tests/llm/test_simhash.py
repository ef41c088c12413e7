"""Golay keys and SimHash groups against brute force."""

import re

import numpy as np
import pytest
import xxhash

from meshfold.llm import simhash

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest position reachable over pairs of at most two bits."""
    prints = np.array(prints, np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    label = np.arange(len(prints))
    while True:
        new = np.where(near, label[None, :], len(prints)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_every_word_is_within_three_bits_of_a_code_word():
    words = np.random.default_rng(1).integers(0, 1 << 23, 10_000)
    assert (simhash._remainders(words ^ simhash.CORRECTIONS[simhash._remainders(words)]) == 0).all()
    distinct = {len(set(r)) for r in simhash.near_indices(words, 23).tolist()}
    assert distinct == {1, 6}


def test_all_pairs_within_two_bits_share_a_key():
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 1 << 63))
    others = [base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a, 64)]  # a == b: no change
    at, key = simhash.keys(np.array([base, *others], np.uint64))
    own = set(key[at == 0].tolist())
    for i in range(1, len(others) + 1):
        assert own & set(key[at == i].tolist())


def test_links_join_what_brute_force_joins(spark):
    rng = np.random.default_rng(3)
    prints = []
    for _ in range(60):  # chains and clusters around random centres
        x = int(rng.integers(0, 1 << 63)) * 2
        for _ in range(12):
            prints.append(x)
            for b in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                x ^= 1 << b
    prints = list(dict.fromkeys(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    place = {p: i for i, p in enumerate(signed)}
    from meshfold.llm.common import components

    found = components(spark.createDataFrame(links, "a long, b long"), "t").collect()
    label = list(range(len(prints)))
    groups = {}
    for r in found:
        groups.setdefault(r.component, []).append(place[r.node])
    for g in groups.values():
        for i in g:
            label[i] = min(g)
    assert label == plain_groups(prints).tolist()
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_edge_cases(spark):
    long = "lang wort " * 30_000
    rows = [(3, None, "x"), (1, "", "x"), (2, " \t\n", None), (5, "One two", "x"), (4, "one  TWO", "x"), (4, "one  TWO", "x"), (None, long, "x"), (9, long, "x"),
            (7, "É è", "x"), (8, "a b c d", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.fp == 0} == {1}
    by = {r.doc_id: r for r in got}
    assert by[5].component_id == by[4].component_id == 4
    assert by[9].component_id == 9 and by[None].component_id == 9
    for i, t, _ in rows:
        assert np.array([by[i].fp]).view(np.uint64)[0] == plain_print(t)
    assert simhash.near_duplicates(docs.where("doc_id = -1")).collect() == []


def test_query_is_brute_force(spark, sf_small):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op5_simhash(spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [plain_print(d.text) for d in docs]
    group = plain_groups(prints)
    assert got == {d.doc_id: (f"{p:016x}", docs[g].doc_id) for d, p, g in zip(docs, prints, group)}
