"""SimHash near-duplicates by Golay-code fuzzy hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.llm.common import bounded_scan, components, multi_runs, packed, run_links, stored, text_slices, tile_pairs

# The binary Golay code has words of 23 bits, 12 of them free, and this generator polynomial.
GENERATOR, WORD_BITS, CHECK_BITS = 0b110001110101, 23, 11
#: Cuts of the 64 bits into three segments that fit a code word: (first bit, bits).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, shingle: int) -> int:
    """The bits that are set in over half of the XXH64 (seed 42) of all word shingles; 0 without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], 42) for s, e in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(axis=0, dtype=np.int32) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _remainders(words: np.ndarray) -> np.ndarray:
    """What is left of 23-bit words divided by the generator: 0 for code words."""
    rest = words.copy()
    for bit in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
        rest ^= np.where((rest >> bit) & 1, GENERATOR << (bit - CHECK_BITS), 0)
    return rest


def _corrections() -> np.ndarray:
    """For each remainder the word of at most three bits that leaves it; the code is perfect, so there is exactly one."""
    ones = [1 << b for b in range(WORD_BITS)]
    words = [0, *ones] + [a | b for a in ones for b in ones if a < b] + [a | b | c for a in ones for b in ones for c in ones if a < b < c]
    table = np.zeros(1 << CHECK_BITS, np.int64)
    table[_remainders(np.array(words))] = words
    return table


CORRECTIONS = _corrections()


def decode(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the code word nearest to each 23-bit word."""
    return (words ^ CORRECTIONS[_remainders(words)]) >> CHECK_BITS


def near_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """For each word, the indices that it and the words one bit away decode to, sorted; at most six differ."""
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    return np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) for fingerprints as unsigned 64-bit integers.

    Two bits of difference in three segments leave one segment alike whose successor differs in at most one bit. A key is
    a segment as it is and a nearby code word's index of its successor; both of such a pair share one.
    """
    at, out = [], []
    parts = [((prints >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    for k in range(3):
        exact, (_, bits) = parts[k], SEGMENTS[(k + 1) % 3]
        near = near_indices(parts[(k + 1) % 3], bits)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        row, column = np.nonzero(new)
        at.append(row)
        out.append((np.int64(k) << 60) | (exact[row] << 12) | near[row, column])
    return np.concatenate(at), np.concatenate(out)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """``docs`` without the text, with column fp (long: the 64 bits). Null text: 0, as without words."""
    kept = [c for c in docs.columns if c != text]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle) for _, texts in text_slices(batch, text) for t in texts]
            column = pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), column], [*kept, "fp"])

    schema = docs.select(*kept).withColumn("fp", F.lit(0).cast("long")).schema
    return bounded_scan(docs, *kept, text).mapInArrow(scan, schema)


def fingerprint_links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join all that differ in at most ``distance`` (0 to 2) bits."""
    if not 0 <= distance <= 2:
        raise ValueError("the keys hold for distances up to 2 bits")

    def members(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            at, key = keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(fp[at], pa.int64())], ["key", "id"])

    def near(held, x, others):
        ids = held["id"].view(np.uint64)
        return np.bitwise_count(ids[others] ^ ids[x]) <= distance

    keyed = prints.select("fp").mapInArrow(members, "key long, id long")
    return run_links(tile_pairs(multi_runs(keyed, "simhash-runs")), [], near)


def groups(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable from each of the stored, distinct ``prints``."""
    found = components(fingerprint_links(prints, distance), "simhash-components")
    moved = found.select(F.col("node").alias("fp"), F.col("component").alias("root"))
    return stored(prints.select("fp").join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), "simhash-groups")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``: the smallest doc_id reachable over fingerprints that differ in at
    most ``distance`` bits.

    Equal fingerprints are one node, so exact copies cost nothing. Null text and text without words have fingerprint 0 and are
    linked like any other; repeated rows come out as often as they are; a null doc_id never names a component unless all
    are null; an empty table gives an empty result; other columns are not read.
    """
    table = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stored(fingerprints(table, shingle), "simhash-rows")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    rooted = prints.join(groups(prints, distance), "fp")
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(lowest, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` (doc_id, text and others) with one row of each group of near duplicates: that of the smallest doc_id, nulls last; of rows that share
    it, one."""
    table = packed(docs, "doc_id", "text")
    rows = stored(fingerprints(table, shingle).withColumn("row_", F.monotonically_increasing_id()), "simhash-docs")
    prints = stored(rows.select("fp").distinct(), "simhash-prints")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_")
    first = rows.select("fp", order.alias("o")).join(groups(prints, distance), "fp").groupBy("root").agg(F.min("o").alias("o"))
    return rows.join(first.select("o.row_"), "row_", "left_semi").select("in_.*")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)
