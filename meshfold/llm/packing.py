"""Packing of token sequences into windows: best-fit decreasing over the counts of each length."""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meshfold.llm.common import bounded_scan, ranked, stored, text_slices

CAPACITY, END, SEED = 1024, 0, 77
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


# ---------------------------------------------------------------- tokens

@cache
def _encoders(vocabulary: str, ranks: str):
    pairs = (line.split() for line in open(ranks, "rb"))
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(t): int(r) for t, r in pairs}, special_tokens={})
    exact = Tokenizer.from_file(vocabulary)
    return fast, exact, [t.content for t in exact.get_added_tokens_decoder().values()]


def encode(text: str, vocabulary: str, ranks: str) -> np.ndarray:
    """The ids of ``text`` by the vocabulary file. The rank file holds the same vocabulary for the faster library; only texts with a
    special token's string need the other."""
    fast, exact, special = _encoders(vocabulary, ranks)
    if any(s in text for s in special):
        return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
    return np.array(fast.encode_ordinary(text), "<u4")


def pieces(docs: DataFrame, capacity: int, vocabulary: str, ranks: str, with_ids: bool) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, piece[, ids]), stored: each document's ids and the id ``END``, cut into full windows
    and a rest."""
    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("doc_id")
            for first, texts in text_slices(batch, "text", 1 << 20):
                rows, cuts = [], []
                for i, text in enumerate(texts, first):
                    ids = np.append(encode(text.decode(), vocabulary, ranks), np.uint32(END)).astype("<u4")
                    name = names[i].as_py()
                    for s in range(0, len(ids), capacity):
                        part = ids[s : s + capacity]
                        rows.append((name, s, len(part), zlib.crc32(part.tobytes()), len(ids)))
                        cuts.append(part.astype(np.int64))
                out = [pa.array(c, pa.int64()) for c in zip(*rows)]
                if with_ids:
                    out.append(pa.array(cuts, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(out, fields + ["ids"] * with_ids)

    schema = ", ".join(f"{f} long" for f in fields) + ", ids array<long>" * with_ids
    cut = bounded_scan(docs, "doc_id", "text").mapInArrow(scan, schema)
    return stored(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")


# ---------------------------------------------------------------- best fit

class OpenWindows:
    """Open windows by remaining capacity, under a segment tree that finds the tightest one with enough room.

    Windows with the same remaining capacity are kept as ranges of numbers, so the work doesn't grow with their count.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.ranges: dict[int, deque] = {}

    def _mark(self, room: int, open_: bool) -> None:
        node = self.leaves + room
        self.any[node] = open_
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        """The least remaining capacity of at least ``size`` among open windows."""
        node = self.leaves + size
        if not self.any[node]:
            while True:  # up to the first subtree to the right that has an open window
                if node == 1:
                    return None
                if node % 2 == 0 and self.any[node + 1]:
                    node += 1
                    break
                node //= 2
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves

    def put(self, room: int, low: int, high: int) -> None:
        if room and low < high:
            held = self.ranges.setdefault(room, deque())
            held.append((low, high))
            if len(held) == 1:
                self._mark(room, True)

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` windows of one range."""
        held = self.ranges[room]
        low, high = held.popleft()
        if high - low > most:
            held.appendleft((low + most, high))
            high = low + most
        if not held:
            self._mark(room, False)
        return low, high


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where best-fit decreasing puts pieces, given how many there are of each length: rows (length, from, to, each, window, offset).

    The pieces ranked ``from`` to ``to`` - 1 of their length go to consecutive windows from ``window`` on, ``each`` to a window, the
    first at ``offset``. A window that takes a piece is then the tightest that fits, as long as another of the same length fits;
    so all windows of equal room are filled by one row.
    """
    windows, opened, rows = OpenWindows(capacity), 0, []
    for length in sorted((n for n, k in counts.items() if k), reverse=True):
        placed, total = 0, counts[length]
        while placed < total:
            rest, room = total - placed, windows.tightest(length)
            each = (capacity if room is None else room) // length
            each, most = (each, rest // each) if rest >= each else (rest, 1)
            if room is None:
                room, low, high = capacity, opened, opened + most
                opened = high
            else:
                low, high = windows.take(room, most)
            done = (high - low) * each
            rows.append((length, placed, placed + done, each, low, capacity - room))
            windows.put(room - each * length, low, high)
            placed += done
    return rows


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, ranks: str | None = None, with_ids: bool = False, seed: int = SEED) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with their places: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    Documents over ``capacity`` ids are cut into full windows first. Only the number of pieces of each length reaches the driver, where the
    packing is worked out for all of them at once; a row there stands for a whole range of windows, and their number depends on
    ``capacity``, not on the documents. Spark numbers the pieces of each length and looks their range up.

    A null text is empty and gives one piece, the closing id; repeated rows are packed each for itself; null doc_ids are kept; an empty table gives
    an empty result; further columns are not read.
    """
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    ranks = ranks or public_tokenizers.path(RANKS)
    cut = pieces(docs, capacity, vocabulary, ranks, with_ids)
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    plan = docs.sparkSession.createDataFrame(
        best_fit_decreasing(counts, capacity), "length long, from_ long, to_ long, each_ long, window_ long, at_ long").hint("broadcast")
    places = ranked(cut.drop("ids"), "length", "piece", seed, "pieces-ranked")
    found = places.join(plan, "length").where("rank >= from_ AND rank < to_").selectExpr(
        "*", "window_ + (rank - from_) DIV each_ AS sequence_id", "at_ + (rank - from_) % each_ * length AS offset")
    if with_ids:
        found = found.join(cut.select("piece", "ids"), "piece")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return found.select(*names, *["ids"] * with_ids)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return pack(docs)
