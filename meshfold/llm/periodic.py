"""Periodic runs of words by maximal pairs over an LCP-interval tree.

Two places whose texts agree for l words, but neither before nor after them, are a maximal pair. If their distance p is at most half of l, the
words from the first place to the end of the second's agreement repeat with period p and can't be extended, so
they are a run as they stand. Suffixes are sorted by doubling, the tree of LCP intervals is walked bottom-up, and pairs are taken where two
children of an interval meet.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.llm.common import bounded_scan, packed, text_slices

#: Words of the shortest run, and how often its period fits in it at least.
LEAST, REPEATS = 24, 3
_ADDED = ("n_words", "runs", "collapsed")
_RUNS = "array<struct<start: long, length: long, period: long>>"


# ---------------------------------------------------------------- suffixes

def _first_of(new: np.ndarray) -> np.ndarray:
    """For each element the index of the last one at or before it that is marked as new."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _split(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], keys[1:] != keys[:-1]])


def repeated_suffixes(words: np.ndarray, common: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, lcp): the suffixes that share ``common`` words or more with another, sorted, and what each has in common with the one
    before it (0 where that is less than about ``common``).

    Prefix doubling: a suffix's rank is that of its group's first one, and only groups of two or more are sorted on. Common lengths follow
    from place to place, as the next suffix shares at most one word less.
    """
    n, reach, held = len(words), 1, None
    order = np.argsort(words, kind="stable")
    new = _split(words[order])
    rank = np.empty(n, np.int64)
    rank[order] = _first_of(new)
    todo = order[~(new & np.append(new[1:], True))]
    while len(todo):
        if held is None and 2 * reach > common:
            held, alike, tied = rank.copy(), reach, np.sort(todo)
        follow = np.where(todo + reach < n, rank[np.minimum(todo + reach, n - 1)] + 1, 0)
        sort = np.lexsort((follow, rank[todo]))
        todo, follow = todo[sort], follow[sort]
        old = rank[todo]
        coarse = _split(old)
        fine = coarse | _split(follow)
        rank[todo] = old + _first_of(fine) - _first_of(coarse)
        todo = todo[~(fine & np.append(fine[1:], True))]
        reach *= 2
    if held is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = tied[np.argsort(rank[tied])]
    before = np.full(n, -1)
    inner = np.flatnonzero(held[places[1:]] == held[places[:-1]])
    before[places[inner + 1]] = places[inner]
    lcp, line, length, last = np.zeros(n, np.int64), words.tolist(), 0, -1
    for at, other in zip(tied.tolist(), before[tied].tolist()):
        if other < 0:
            length = 0
        else:
            length = max(length - 1 if at == last + 1 else 0, alike)
            end = n - max(at, other)
            while length < end and line[at + length] == line[other + length]:
                length += 1
            lcp[at] = length
        last = at
    return places, np.where(lcp[places] >= common, lcp[places], 0)


# ---------------------------------------------------------------- intervals

class Places:
    """The places of an interval. The lists of its left-word classes are kept interleaved, in the order of the text, in chunks: a place's class is the
    word left of it, and a run joins only neighbours in that order."""

    def __init__(self, place: int):
        self.chunks, self.size = {place >> 12: [place]}, 1

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks.values():
            yield from chunk

    def add(self, place: int) -> None:
        insort(self.chunks.setdefault(place >> 12, []), place)
        self.size += 1

    def neighbours(self, place: int, reach: int) -> Iterator[int]:
        """The nearest places before and behind ``place`` that lie within ``reach``; ``place`` itself isn't one of the interval."""
        own = place >> 12
        chunk = self.chunks.get(own, [])
        k = bisect_left(chunk, place)
        before = chunk[k - 1] if k else next((self.chunks[c][-1] for c in range(own - 1, ((place - reach) >> 12) - 1, -1) if c in self.chunks), None)
        behind = chunk[k] if k < len(chunk) else next((self.chunks[c][0] for c in range(own + 1, ((place + reach) >> 12) + 1) if c in self.chunks), None)
        if before is not None and place - before <= reach:
            yield before
        if behind is not None and behind - place <= reach:
            yield behind


def find_runs(words: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs of ``least`` words and ``repeats`` periods or more, by start, then period.

    A pair at distance p with l words in common makes a run of p + l words: so l is at least (repeats - 1) * p, two or more periods. Between the two places of
    a run's pair of smallest period no other place agrees for l words (with a second period, the two lengths being together at most l, their common divisor would be one), so
    only neighbours among an interval's places are looked at. Where one of them has a multiple of the period, it gives the same start and length and
    the smaller period counts. Each place moves into a larger interval each time, so at most log n times.
    """
    if repeats < 3:
        raise ValueError("runs of fewer than three periods may have pairs that are no neighbours")
    n = len(words)
    common = max(1, min(max(least - p, (repeats - 1) * p) for p in range(1, max(least, 1) + 1)))
    if n < least or n < common + 1:
        return []
    places, lcp = repeated_suffixes(words, common)
    line, found = words.tolist(), {}

    def meet(length: int, a: Places, b: Places) -> Places:
        """Two children of an interval of ``length`` common words become one; their pairs differ behind these words, and must before."""
        small, large = (a, b) if a.size < b.size else (b, a)
        reach = length // (repeats - 1)
        for x in small:
            for y in large.neighbours(x, reach):
                i, j = (x, y) if x < y else (y, x)
                if (i == 0 or line[i - 1] != line[j - 1]) and j - i + length >= least:
                    run = (i, j - i + length)
                    found[run] = min(found.get(run, n), j - i)
        for x in small:
            large.add(x)
        return large

    open_: list[tuple[int, Places]] = []  # intervals from the root down: common words, places so far
    child = None
    for place, length in zip([*places.tolist(), None], [*lcp.tolist(), 0]):
        while open_ and open_[-1][0] > length:
            common_words, held = open_.pop()
            child = meet(common_words, held, child)
        if length:
            if open_ and open_[-1][0] == length:
                open_[-1] = (length, meet(length, open_[-1][1], child))
            else:
                open_.append((length, child))
        if place is not None:
            child = Places(place)
    return sorted(((s, k, p) for (s, k), p in found.items()), key=lambda r: (r[0], r[2]))


def word_ids(words: list[bytes]) -> np.ndarray:
    ids: dict[bytes, int] = {}
    return np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those in no run, and each run's first period unless another run drops it."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) == 0


# ---------------------------------------------------------------- Spark

def periodic_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS, text: str = "text") -> DataFrame:
    """``docs`` with columns n_words, runs (array of start, length, period in words, by start, then period) and collapsed (the words that are left when
    each run keeps its first period only, joined by one space).

    Words are what white space (0x20, 0x09 to 0x0D) separates. Null and empty texts have no words, no runs and collapse to an empty text. A text is handled whole, by
    one task, in memory in proportion to it; time is n log n words. Runs may overlap; repeated rows come out as often as they are; an empty
    table gives an empty result. Other columns are passed on, those of the added columns' names are replaced.
    """
    table = packed(docs, F.col(f"`{text}`").alias("text"), replaced=_ADDED)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            for first, texts in text_slices(batch, "text"):
                counts, runs, left = [], [], []
                for words in (t.split() for t in texts):
                    found = find_runs(word_ids(words), least, repeats)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": k, "period": p} for s, k, p in found])
                    left.append(b" ".join(w for w, keep in zip(words, kept_words(len(words), found)) if keep) if found else b" ".join(words))
                columns = [pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(left, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column("in_").slice(first, len(texts)), *columns], ["in_", *_ADDED])

    schema = table.select("in_").withColumns({"n_words": F.lit(None).cast("long"), "runs": F.lit(None).cast(_RUNS), "collapsed": F.lit(None).cast("string")}).schema
    return bounded_scan(table, "in_", "text").mapInArrow(scan, schema).select("in_.*", *_ADDED)


def planted(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The words of a document, in a tenth of the documents with a periodic end, as the query's contract has it."""
    h = zlib.crc32((doc_id or "").encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def with_planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text: the words, planted ones included, joined by one space)."""
    table = docs.select("doc_id", F.col("doc_id").cast("string").alias("name"), "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("name").to_pylist()
            for first, texts in text_slices(batch, "text"):
                out = [b" ".join(planted(t.split(), names[first + i])) for i, t in enumerate(texts)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return bounded_scan(table, "doc_id", "name", "text").mapInArrow(scan, docs.select("doc_id", "text").schema)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs(with_planted(docs))
    order = """array_sort(runs, (a, b) -> CAST(CASE WHEN a.length * b.period != b.length * a.period THEN sign(b.length * a.period - a.length * b.period)
        WHEN a.start != b.start THEN sign(a.start - b.start) ELSE sign(a.period - b.period) END AS INT))"""
    best = F.get(F.expr(order), F.lit(0))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * best.length) DIV best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
