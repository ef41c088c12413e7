"""Fill-in-middle transformation by in-place block rotation.

A text is cut twice between tokens, sentinels are inserted in a bytearray, and blocks are exchanged by three reversals; the same
rotation the other way round gives the text back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.llm.common import bounded_scan, packed, text_slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Share of texts that are rearranged, and of these the share with the suffix first, in percent.
RATE, SUFFIX_FIRST, SEED = 50, 80, 42
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def token_ends(text: bytes) -> np.ndarray:
    """Where tokens end, in bytes: a word with the white space before it, or white space at the end of the text.

    White space is ASCII, so that the bytes of UTF-8 give the same tokens as code points do.
    """
    space = np.ones(len(text) + 1, bool)
    space[:-1] = _SPACE[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(text)) if len(text) and space[-2] else ends


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchanges the blocks [start, middle) and [middle, end) by reversing each, then both together."""
    for a, b in ((start, middle), (middle, end), (start, end)):
        buffer[a:b] = buffer[a:b][::-1]


def rearranged(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text cut at two places (bytes), with sentinels, in the order of ``form``."""
    buffer = bytearray(text)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def restored(output: bytes, form: str) -> bytearray:
    """The text that ``rearranged`` was given, from its output and form alone."""
    buffer = bytearray(output)
    if form == "plain":
        return buffer
    if form == "psm":
        rotate(buffer, buffer.find(SUFFIX), buffer.find(MIDDLE), len(buffer))
    else:
        rotate(buffer, 0, buffer.find(PREFIX), len(buffer))
    for mark in (SUFFIX, MIDDLE, PREFIX):  # prefix, middle and suffix are in order now; what lies before a mark keeps its place
        at = buffer.find(mark)
        del buffer[at : at + len(mark)]
    return buffer


def _draws(seed: int, doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _length(text: bytes) -> int:
    return len(text.decode())


def transformed(text: bytes, doc_id: int | None, rate: int, suffix_first: int, seed: int) -> tuple:
    """(tokens, form, code points of the prefix, of the middle, output)."""
    ends = token_ends(text)
    a, b, chance, order = _draws(seed, doc_id)
    if not text or chance % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return len(ends), "plain", None, None, text
    starts = np.concatenate([[0], ends])  # of the tokens and of what follows them
    first, second = sorted(int(starts[x % len(starts)]) for x in (a, b))
    form = "spm" if order % 100 < suffix_first else "psm"
    return len(ends), form, _length(text[:first]), _length(text[first:second]), bytes(rearranged(text, first, second, form))


def fill_in_middle(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED, text: str = "text") -> DataFrame:
    """``docs`` with columns n (tokens), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output.

    Cuts, form and order are drawn from the seed and doc_id alone, so a rerun gives the same. ``rate`` and ``suffix_first`` are percents.
    A null text is empty, and an empty text stays plain; so does one that holds a sentinel. A null doc_id draws as if it were an empty string;
    repeated rows come out alike, as often as they are. Texts of any length are handled one by one, whole, in memory for a few copies
    of one text. An empty table gives an empty result. Other columns are passed on, except those of the added columns' names, which are replaced.
    """
    table = packed(docs, F.col("doc_id").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"), replaced=_ADDED)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, texts in text_slices(batch, "text"):
                made = [transformed(t, ids[first + i], rate, suffix_first, seed) for i, t in enumerate(texts)]
                columns = [pa.array(c, t) for c, t in zip(zip(*made), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()))]
                columns[-1] = columns[-1].cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("in_").slice(first, len(texts)), *columns], ["in_", *_ADDED])

    types = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
    schema = table.select("in_").withColumns({c: F.lit(None).cast(t) for c, t in types.items()}).schema
    return bounded_scan(table, "in_", "doc_id", "text").mapInArrow(scan, schema).select("in_.*", *_ADDED)


def restore(made: DataFrame) -> DataFrame:
    """``made`` (output, form and others) with column restored: the text rebuilt from these two alone. A null output is empty, and a null form is plain."""
    table = packed(made, "output", F.coalesce("form", F.lit("plain")).alias("form"), replaced=("restored",))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column("form").to_pylist()
            for first, outputs in text_slices(batch, "output"):
                back = pa.array([bytes(restored(o, forms[first + i])) for i, o in enumerate(outputs)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("in_").slice(first, len(outputs)), back], ["in_", "restored"])

    schema = table.select("in_").withColumn("restored", F.lit(None).cast("string")).schema
    return bounded_scan(table, "in_", "output", "form").mapInArrow(scan, schema).select("in_.*", "restored")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    digest = lambda c: F.sha2(c, 256).alias(f"{c}_sha256")
    return restore(fill_in_middle(docs)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


_WHITE = r"\x20\x09-\x0D"
_draw = lambda i: f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS UBIGINT)"
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
  regexp_extract_all(coalesce(text, ''), '[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+') AS w FROM documents),
c AS (SELECT *, CAST(least({_draw(0)} % (len(w) + 1), {_draw(1)} % (len(w) + 1)) AS BIGINT) AS a, CAST(greatest({_draw(0)} % (len(w) + 1), {_draw(1)} % (len(w) + 1)) AS BIGINT) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_draw(2)} % 100 >= {RATE} THEN 'plain'
    WHEN {_draw(3)} % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, len(w) AS n, form, text, coalesce(array_to_string(w[1:a], ''), '') AS p, coalesce(array_to_string(w[a + 1:b], ''), '') AS m,
  coalesce(array_to_string(w[b + 1:], ''), '') AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form != 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form != 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
