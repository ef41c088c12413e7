"""From raw documents to packed sequences: five stages, each over all that the one before it kept.

``run(spark, sf_dir)`` returns the last stage's rows. A stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``. Between stages the documents are written to the folder in ``spark.checkpoint.dir`` and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meshfold.llm import decontamination, lines, packing, quality, simhash
from meshfold.llm.common import stored

STAGES = [
    ("quality classifier", quality.stage),
    ("line dedup", lines.stage),
    ("simhash near-dedup", simhash.stage),
    ("benchmark decontamination", decontamination.stage),
    ("packing", packing.stage),
]

#: The classifier, the edit join, the Golay keys and the tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
