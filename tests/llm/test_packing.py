"""Best-fit decreasing against the plain algorithm, and pieces that cover their documents."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from meshfold.llm import packing

SPECIAL = "a<|endoftext|>b"


def plain_best_fit(items, capacity):
    rooms = []
    for size in sorted(items, reverse=True):
        fits = [b for b in range(len(rooms)) if rooms[b] >= size]
        if fits:
            rooms[min(fits, key=lambda b: rooms[b])] -= size
        else:
            rooms.append(capacity - size)
    return sorted(capacity - r for r in rooms)


def test_best_fit_is_the_plain_one():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.choice([7, 64, 100])
        items = [rng.choice([rng.randint(1, capacity), rng.randint(1, 9) % capacity + 1, capacity // 3]) for _ in range(rng.randint(0, 200))]
        windows, seen = defaultdict(list), 0
        for length, a, b, each, window, offset in packing.best_fit_decreasing(Counter(items), capacity):
            for k in range(a, b):
                windows[window + (k - a) // each].append((offset + (k - a) % each * length, length))
                seen += 1
        assert seen == len(items) and sorted(windows) == list(range(len(windows)))
        for w in windows.values():
            at = 0
            for offset, length in sorted(w):
                assert offset == at
                at += length
        assert sorted(sum(x for _, x in w) for w in windows.values()) == plain_best_fit(items, capacity)


def test_the_plan_does_not_grow_with_the_documents():
    rng = random.Random(2)
    counts = {n: rng.randint(0, 10**9) for n in range(1, 1025)}
    rows = packing.best_fit_decreasing(counts, 1024)
    assert len(rows) < 10_000 and sum(r[2] - r[1] for r in rows) == sum(counts.values())


def check(docs, got, capacity):
    """docs: (doc_id, text) rows with distinct ids."""
    tokens = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    of, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(of) == {i for i, _ in docs}
    for i, text in docs:
        ids = np.array([*tokens.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(of[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            if "ids" in r:
                assert r.ids == ids[at : at + r.length].tolist()
            at += r.length
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for r in got)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, SPECIAL), (4, "word " * 3000), (5, "é\n\n  x"), (None, "null id"), (6, "a" * 5000)] + [(i, "same length") for i in range(10, 60)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, length string, piece int").repartition(4)
    got = packing.pack(docs, capacity=64, with_ids=True).collect()
    assert "ids" in got[0]
    check(rows, got, 64)
    assert Counter(r.doc_id for r in packing.pack(docs.where("doc_id = 2").union(docs.where("doc_id = 2"))).collect()) == {2: 2}
    assert packing.pack(docs.where("doc_id = -1")).collect() == []


def test_query(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    windows, tokens = check(docs, packing.op7_packing(spark, sf_small).collect(), packing.CAPACITY)
    assert tokens > 0.98 * windows * packing.CAPACITY
