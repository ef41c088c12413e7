"""The pipeline against brute force, stage by stage."""

import re

import corpus_pipeline
import pytest
from test_lines import brute
from test_simhash import plain_groups, plain_print

from meshfold.llm import decontamination, lines, packing, quality, simhash

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = quality.stage(spark, docs, sf_small).cache()
    assert kept.columns == columns
    chain = quality.train(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    scores = quality.document_scores([t.encode() for _, t in rows], chain)
    assert rows_of(kept) == sorted(r for r, s in zip(rows, scores) if s >= 0.5)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert sum(i in ids for i, q in labels.items() if q == 1) >= 0.95 * sum(labels.values())

    short = lines.stage(spark, kept, sf_small).cache()
    assert short.columns == columns
    assert rows_of(short) == sorted((k[0], t) for k, t in brute(rows_of(kept), lines.EDITS, lines.LEAST).items())

    single = simhash.stage(spark, short, sf_small).cache()
    before = rows_of(short)
    group = plain_groups([plain_print(t) for _, t in before])
    assert single.columns == columns
    assert rows_of(single) == [before[i] for i in sorted(set(group.tolist()))]

    clean = decontamination.stage(spark, single, sf_small).cache()
    items = [PATTERN.findall(r.text.translate(LOWER)) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}

    def hit(text):
        w = PATTERN.findall(text.translate(LOWER))
        return any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    assert clean.columns == columns
    assert rows_of(clean) == [r for r in rows_of(single) if not hit(r[1])]

    packed = packing.stage(spark, clean, sf_small).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in rows_of(clean)}


def test_run_is_the_stages_in_order(spark, sf_small):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    found = corpus_pipeline.run(spark, sf_small)
    assert found.count() > 0 and "sequence_id" in found.columns


def test_repeated_rows_and_nulls_pass_the_stages(spark, sf_small):
    schema = spark.read.parquet(f"{sf_small}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "One two three four.", "en", "s", 19), (2, "One two three four.", None, None, 19)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns and out.count() <= 5
        assert stage(spark, docs.where("doc_id = 9"), sf_small).count() == 0
    clash = docs.selectExpr("*", "doc_id AS fp", "text AS in_", "1 AS row_", "'k' AS key", "text AS removed_", "2 AS score")
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, clash, sf_small).columns == clash.columns
        stage(spark, clash, sf_small).collect()
    kept = simhash.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2]


@pytest.mark.parametrize("name", ["op1_decontamination", "op2_sharding", "op3_quality", "op4_line_dedup", "op5_simhash", "op6_neighbours", "op7_packing", "op8_secrets", "op9_warc", "op10_extraction"])
def test_all_are_registered(name):
    import __spark_entry__ as entry

    assert name in entry.queries()
