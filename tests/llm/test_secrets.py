"""Spans against Python's regular expressions, links against a double loop."""

import hashlib
import random
import re

import duckdb

from meshfold.llm import secrets

BASE = {"assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 24)}
AWS = "AKIA" + "Q7" * 8
WEAK = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"


def base_spans(text):
    order = list(BASE)
    found = [(m.start(), order.index(k), m.end(), k) for k, (p, ok) in BASE.items() for m in re.finditer(p, text, re.A) if ok(m)]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def plain(text, scope=secrets.SCOPE):
    """All spans: base ones, and weak ones by a loop over their possible partners."""
    found = base_spans(text)
    for k in secrets.KINDS[3:]:
        for m in re.finditer(secrets.PATTERNS[k], text):
            if k != "wsecret" or all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]")):
                found.append((k, m.start(), m.end()))
    near = lambda s, group: any(k in group and abs(a - s) <= scope for k, a, _ in found)
    kept = [(s, secrets.KINDS.index(k), k, e) for k, s, e in found if k in secrets.BASE or all(near(s, g) for g in secrets.NEEDS[k])]
    return [(k, s, e) for s, _, k, e in sorted(kept)]


def test_spans_of_made_up_texts(spark):
    rng = random.Random(4)
    parts = [AWS, WEAK, "token = abc", "Token='abcdef", "api_key:xyz123.=", "secret=token\"=abcdefgh", "f" * 23, "0a" * 12, "https://db.example.com:5432/x", "login: jo", "user = bob",
             "é", "😀", "\n", "password==x", "AKIAQ", "client_id=ab12", "deadbeef" * 8, "ſecret=abcdefg", "passwd:" + "a" * 40]
    rows = [(i, " ".join(rng.choice(parts) + "x " * rng.choice([0, 0, 3, 150]) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    rows += [(200, None), (201, ""), (None, AWS), (202, f"{AWS} {WEAK}"), (203, WEAK), (204, f"{AWS} " * 3000 + WEAK), (202, f"{AWS} {WEAK}")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kind string").repartition(4)
    got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in secrets.scan_secrets(docs).collect()), key=repr)
    assert got == sorted(((i, plain(t or "")) for i, t in rows), key=repr)
    by = dict(got)
    assert [k for k, *_ in by[202]] == ["access", "wsecret"] and by[203] == []
    assert secrets.scan_secrets(docs.where("doc_id = -1")).collect() == []


def test_query(spark, sf_small):
    found = secrets.op8_secrets(spark, sf_small)
    assert not any(x in found._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Arrow", "Pandas"))
    got = sorted(tuple(r) for r in found.collect())
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    assert got == sorted(sql.execute(secrets.SQL).fetchall())
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect():
        row = next(x for x in got if x[0] == r.doc_id)
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in base_spans(r.text))
        assert row[4] == hashlib.sha256(base.encode()).hexdigest()
