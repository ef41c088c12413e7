"""Benchmark decontamination with a positional inverted index of the training tokens."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.llm.common import bounded_scan, packed, stored, text_slices

WINDOW = 10
#: Empty places between documents in a segment's numbering, so that no match spans two of them.
GAP = 64
#: Text of one index segment, and of the benchmark windows that are searched for at once, in bytes.
SEGMENT_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
# Words are runs of digits, a-z (A-Z lower-cased) and bytes of non-ASCII characters.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


# ---------------------------------------------------------------- index

def _pack(numbers: np.ndarray) -> bytes:
    """Differences of 32-bit numbers byte plane by byte plane, which Parquet's compression shrinks well."""
    return np.diff(numbers, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


INDEX = "segment long, doc_ids array<long>, n_words array<long>, terms array<binary>, counts array<int>, places binary"


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional inverted index of all tokens of ``docs``, stored: one row a segment of about ``SEGMENT_BYTES`` of text.

    A segment has its documents (in order) with their numbers of words, its terms with their numbers of postings, and the
    postings: places ascending within each term, packed. Documents lie ``GAP`` places apart.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, texts in text_slices(batch, "text", SEGMENT_BYTES):
                vocabulary: dict[bytes, int] = defaultdict(count().__next__)
                terms = [np.fromiter(map(vocabulary.__getitem__, w), np.int32, len(w)) for w in map(words, texts)]
                n = np.array([len(t) for t in terms], np.int64)
                starts = GAP + np.concatenate([[0], np.cumsum(n + GAP)[:-1]])
                place = np.concatenate([s + np.arange(k) for s, k in zip(starts, n)]).astype(np.uint32)
                term = np.concatenate(terms)
                yield pa.RecordBatch.from_arrays([
                    pa.array([segment], pa.int64()), pa.array([ids[first : first + len(texts)]], pa.list_(pa.int64())),
                    pa.array([n], pa.list_(pa.int64())), pa.array([list(vocabulary)], pa.list_(pa.binary())),
                    pa.array([np.bincount(term, minlength=len(vocabulary)).astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([_pack(place[np.argsort(term, kind="stable")])], pa.binary()),
                ], ["segment", "doc_ids", "n_words", "terms", "counts", "places"])
                segment += 1

    table = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stored(bounded_scan(table, "doc_id", "text").mapInArrow(scan, INDEX), "postings")


# ---------------------------------------------------------------- windows of the benchmark

def windows(benchmark: DataFrame, length: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, words): all runs of ``length`` consecutive words; an item of fewer, but not none, is one window."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id")
            for first, texts in text_slices(batch, "text", 1 << 16):
                for i, t in enumerate(texts, first):
                    w = words(t)
                    if w:
                        runs = [w[k : k + length] for k in range(max(1, len(w) - length + 1))]
                        yield pa.RecordBatch.from_arrays([pa.array([ids[i].as_py()] * len(runs), pa.int64()), pa.array(runs, pa.list_(pa.binary()))], ["item_id", "words"])

    table = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return bounded_scan(table, "item_id", "text").mapInArrow(scan, "item_id long, words array<binary>").distinct()


class Block:
    """Windows of one block: words as numbers of the block's vocabulary, padded with -1, and each window's items."""

    def __init__(self, rows: list, length: int):
        self.vocabulary: dict[bytes, int] = {}
        of: dict[tuple, list] = defaultdict(list)
        for r in rows:
            of[tuple(bytes(w) for w in r.words)].append(r.item_id)
        self.items = list(of.values())
        self.words = np.full((len(of), length), -1)
        for i, w in enumerate(of):
            self.words[i, : len(w)] = [self.vocabulary.setdefault(x, len(self.vocabulary)) for x in w]
        self.sizes = (self.words >= 0).sum(axis=1)


def blocks(found: DataFrame, length: int) -> Iterator[Block]:
    """The windows in blocks of about ``BLOCK_BYTES``. Pairs of window and item are dealt by their hash, so neither a common window
    nor a long item makes a block large."""
    found = stored(found, "windows")
    size = found.agg(F.sum(F.expr("16 + aggregate(words, 0L, (a, w) -> a + 8 + length(w))"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    dealt = found.withColumn("block", F.pmod(F.xxhash64("words", "item_id"), F.lit(max(1, n))))
    for b in range(n):
        yield Block(dealt.where(F.col("block") == b).collect(), length)


# ---------------------------------------------------------------- search

def _intersect(block: Block, terms: list, counts: np.ndarray, places: np.ndarray, slop: int):
    """(window, first place, exact) of the matches in one segment.

    Each window starts from the postings of its rarest word; those of its other words, rarer ones first, are shifted by their
    place in the window and looked up among the sorted postings.
    """
    get = block.vocabulary.get
    known = np.array([get(t, -1) for t in terms], np.int64)
    local = np.full(len(block.vocabulary) + 1, -1)  # the last entry is for the padding
    local[known[known >= 0]] = np.flatnonzero(known >= 0)
    local[-1] = -1
    term = local[block.words]
    window = np.flatnonzero((term >= 0).sum(axis=1) == block.sizes)
    if not len(window):
        return None
    term, sizes = term[window], block.sizes[window]
    frequency = np.where(block.words[window] >= 0, counts[term], np.iinfo(np.int64).max)
    order = np.argsort(frequency, axis=1, kind="stable")
    starts = np.cumsum(counts) - counts
    postings = (np.repeat(np.arange(len(counts)), counts) << 32) | places.astype(np.int64)
    rarest = term[np.arange(len(window)), order[:, 0]]
    n = counts[rarest]
    row = np.repeat(np.arange(len(window)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[rarest], n)
    first = places[at].astype(np.int64) - order[row, 0]
    exact = np.ones(len(row), bool)
    if slop:  # the rarest word, too, may be off its place
        shift = np.arange(-slop, slop + 1)
        row, first, exact = np.repeat(row, len(shift)), (first[:, None] + shift).ravel(), np.tile(shift == 0, len(row))
    for k in range(1, term.shape[1]):
        active = sizes[row] > k
        offset = order[row, k]
        wanted = (term[row, offset] << 32) | (first + offset)
        near = np.minimum(np.searchsorted(postings, wanted - slop), len(postings) - 1)
        hit = (postings[near] >= wanted - slop) & (postings[near] <= wanted + slop)
        if slop:
            same = np.minimum(np.searchsorted(postings, wanted), len(postings) - 1)
            exact &= ~active | (postings[same] == wanted)
        keep = ~active | hit
        row, first, exact = row[keep], first[keep], exact[keep]
    return window[row], first, exact


MATCHES = "segment long, ord int, spans array<struct<s: long, e: long>>, items array<long>, near_items array<long>"


def search(index: DataFrame, block: Block, slop: int = 0) -> DataFrame:
    """Rows of documents with matches: ``spans`` of words inside exact occurrences, the ``items`` they belong to, and with a ``slop``
    the ``near_items``: those with a window that can be laid so that each of its words occurs at most ``slop`` words from its place."""
    if not 0 <= slop < GAP // 4:
        raise ValueError(f"slop must be from 0 to {GAP // 4 - 1}")
    held = index.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = held.value
        for batch in batches:
            for r in range(batch.num_rows):
                segment, n, terms, counts, places = (batch.column(c)[r] for c in ("segment", "n_words", "terms", "counts", "places"))
                found = _intersect(b, terms.as_py(), np.array(counts.values, np.int64), _unpack(places.as_py()), slop)
                if found is None or not len(found[0]):
                    continue
                n = np.array(n.values, np.int64)
                bases = GAP + np.concatenate([[0], np.cumsum(n + GAP)[:-1]])
                ord_ = np.searchsorted(bases, found[1] + GAP // 4, "right") - 1
                out = defaultdict(lambda: ([], set(), set()))
                for d, w, s, e in zip(ord_.tolist(), found[0].tolist(), (found[1] - bases[ord_]).tolist(), found[2].tolist()):
                    spans, items, near = out[d]
                    near.update(b.items[w])
                    if e:
                        spans.append((s, s + int(b.sizes[w])))
                        items.update(b.items[w])
                yield pa.RecordBatch.from_pylist(
                    [{"segment": segment.as_py(), "ord": d, "spans": [{"s": s, "e": e} for s, e in _merged(x)], "items": list(i), "near_items": list(k)} for d, (x, i, k) in out.items()],
                    pa.schema([("segment", pa.int64()), ("ord", pa.int32()), ("spans", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), ("items", pa.list_(pa.int64())), ("near_items", pa.list_(pa.int64()))]))

    return index.select("segment", "n_words", "terms", "counts", "places").mapInArrow(scan, MATCHES)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, slop: int = 0) -> DataFrame:
    """(doc_id, n_words, n_hit, items, near_items) for each row of ``docs``: words, words inside an occurrence of a benchmark window, the
    sorted ids of the items with exact windows there, and of those with near ones (empty without a ``slop``).

    The index covers whole texts and is searched once for each block of windows, so the benchmark may have any size. Null or
    empty texts have no words, repeated rows come out as often as they are, an item without an id marks words but names
    nothing, and an empty benchmark or table of documents gives no hits or no rows.
    """
    index = build_index(docs)
    found = None
    for block in blocks(windows(benchmark, length), length):
        part = search(index, block, slop)
        found = part if found is None else found.union(part)
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ord", "d")).select("segment", "ord", "d.doc_ids", "d.n_words")
    if found is None:
        found = docs.sparkSession.createDataFrame([], MATCHES)
    flat = lambda c: F.array_sort(F.array_compact(F.array_distinct(F.flatten(F.collect_list(c)))))
    merged = found.groupBy("segment", "ord").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), flat("items").alias("items"), flat("near_items").alias("near_items"))
    covered = F.expr("aggregate(spans, struct(0L AS n, 0L AS to), (a, x) -> struct(a.n + greatest(0L, x.e - greatest(x.s, a.to)) AS n, greatest(a.to, x.e) AS to), a -> a.n)")
    none = F.array().cast("array<long>")
    return rows.join(merged, ["segment", "ord"], "left").select(
        F.col("doc_ids").alias("doc_id"), "n_words", F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    named = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(named, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a word inside an occurrence of a benchmark window. Rows alike in doc_id and text share their fate."""
    keyed = packed(docs, "text", F.xxhash64("doc_id", "text").alias("key"))
    found = contamination(keyed.select(F.col("key").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = stored(found.where("n_hit > 0").select(F.col("doc_id").alias("key")).distinct(), "contaminated")
    return keyed.select("in_", "key").join(hit, "key", "left_anti").select("in_.*")


_LOWERED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LOWERED} AS w FROM documents),
b AS (SELECT item_id, {_LOWERED} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, list_slice(w, i, i + {WINDOW - 1}) AS g FROM b, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(g) AS n FROM bw),
dw AS (SELECT r, i, n, list_slice(w, i, i + n - 1) AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT r, i, n, g FROM dw WHERE g IN (SELECT g FROM bw)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM hits JOIN bw USING (g) WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""
