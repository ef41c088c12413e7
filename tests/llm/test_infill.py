"""Cuts and orders against the contract by regular expressions, exact restoration, and SQL."""

import hashlib
import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from meshfold.llm import infill


def plain(doc_id, text, seed=42, rate=50, suffix_first=80):
    """(tokens, form, prefix, middle, output)."""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return len(tokens), "plain", None, None, text
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h4 % 100 < suffix_first:
        return len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("a<PSM> \t\n\x0b\x1c\x85 é漢😀"), max_size=60), st.integers(-5, 10**12), st.integers(0, 100))
def test_texts_are_cut_and_restored(text, doc_id, suffix_first):
    made = infill.transformed(text.encode(), doc_id, 100, suffix_first, 42)
    assert (*made[:4], made[4].decode()) == plain(doc_id, text, 42, 100, suffix_first)
    assert infill.restored(made[4], made[1]).decode() == text


def test_rotation_exchanges_blocks():
    for start in range(4):
        for middle in range(start, 8):
            for end in range(middle, 11):
                buffer, given_ = bytearray(b"0123456789"), b"0123456789"
                infill.rotate(buffer, start, middle, end)
                assert buffer == given_[:start] + given_[middle:end] + given_[start:middle] + given_[end:]
                infill.rotate(buffer, start, start + end - middle, end)
                assert buffer == given_


def test_edge_cases(spark):
    long = "wörter " * 300_000
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t ", "x"), (4, "has a <S> mark", "x"), (5, long, "x"), (6, "twice", "x"), (6, "twice", "x"), (None, "no id here", "x")]
    rows += [(i, f"{i} <P ordinary > text <M < S>", "x") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string").withColumnRenamed("doc_id", "doc_id").selectExpr("*", "doc_id AS `a.b`").repartition(3)
    made = infill.fill_in_middle(docs)
    assert made.columns == ["doc_id", "text", "a.b", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = infill.restore(made).collect()
    want = sorted(((i, *plain(i, t or "")) for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == want
    assert all(r.restored == (r.text or "") for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.restore(infill.fill_in_middle(docs.where("doc_id = -1"))).collect() == []
    assert {r.form for r in infill.fill_in_middle(docs, rate=0).collect()} == {"plain"}
    bare = spark.createDataFrame([(None, None), ("a < b", "plain")], "output string, form string")
    assert sorted(r.restored for r in infill.restore(bare).collect()) == ["", "a < b"]


def test_query(spark, sf_small):
    got = sorted(map(tuple, infill.op12_fill_in_middle(spark, sf_small).collect()))
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    assert got == sorted(sql.execute(infill.SQL).fetchall())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    assert got == sorted((d.doc_id, *(p := plain(d.doc_id, d.text))[:4], sha(p[4]), sha(d.text)) for d in docs)
