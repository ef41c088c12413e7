"""Line deduplication by a segment-partition edit join."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.llm.common import bounded_scan, components, packed, stored, text_slices, tile_pairs, whole_runs


@dataclass(frozen=True)
class Alike:
    """When two lines count as the same: at most ``edits`` edits of code points lead from one to the other, or at most one edit of a word for
    each full ``per`` words of the longer line (0: no such edits). Words are what white space separates."""

    edits: int
    per: int = 0

    def __lt__(self, difference: int) -> bool:
        """Whether lines whose lengths differ by ``difference`` code points can't be alike; an edited word may have any length."""
        return not self.per and self.edits < difference

    def words(self, n):
        """Edits of words for a line of ``n`` words."""
        return n // self.per if self.per else n * 0


#: Edits between lines that count as the same, and the code points from which on a line is compared at all.
EDITS, LEAST = Alike(2, per=20), 32
#: Documents, and words of the line, from which on exact copies of a shorter line go too.
SPREAD, WORDS = 10, 2
#: Words of a hashed run of words. A longer one is more selective, but more of them are sent.
RUN = 5
#: Keys that a task deals out at once, keys in a row at most, buckets of keys for each shuffled partition.
SENT, PACK, BUCKETS = 1 << 20, 2048, 8
#: Rows of a bucket from which on keys of many lines are passed on, and lines that make many.
HELD, MANY = 1 << 21, 4096
#: Lines of a key whose pairs are selected at once; runs of more are compared in pairs of tiles of about TILE.
FEW, TILE = 16, 2048
#: Longer runs are put together if the pairs of what they hold are at most so many times their own pairs.
WIDER = 4
#: Rows of runs that a task looks at at once, and pairs of rows of a longer run.
ROWS, BLOCK = 16_384, 1 << 16
#: Candidate lines whose ids are broadcast to pick up their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


# ---------------------------------------------------------------- segments and probes

def segments(length: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, size) of the ``edits`` + 1 segments of lines of each length; sizes differ by one at most, the longer ones come last."""
    parts = edits + 1
    short, longer = length // parts, length % parts
    sizes = [short + (i >= parts - longer) for i in range(parts)]
    return [(sum(sizes[:i], np.zeros_like(length)), sizes[i]) for i in range(parts)]


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(difference, segment, shift): where a line of length n looks for the segments of lines of length n - difference.

    An alignment with few edits either meets a segment with at most as many edits before it as there are segments before, or leaves at most as
    many behind it as there are behind; only shifts that agree with both are tried. Difference 0 with shift 0 is the line's own segment.
    """
    out = []
    for difference in range(edits + 1):
        for i in range(edits + 1):
            low = max(-i, difference - (edits - i))
            high = min(i, difference + (edits - i))
            out += [(difference, i, shift) for shift in range(low, high + 1)]
    return out


_BASE = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """Powers of the hash base and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 1 << 16)
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b)]), dtype=np.uint64) for b in (_BASE, inverse))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def line_keys(points: np.ndarray, start: np.ndarray, length: np.ndarray, edits: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of the lines at ``start`` of ``length`` in an array of code points: hashes of (length, segment, substring)."""
    powers.grow(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(points.astype(np.uint64) * powers.up[: len(points)], out=sums[1:])
    lines, keys = [], []
    for difference, i, shift in probes(edits):
        of = length - difference
        begin, size = segments(of, edits)[i]
        a = start + begin + shift
        ok = np.flatnonzero((begin + shift >= 0) & (begin + shift + size <= length))
        a, size = a[ok], size[ok]
        content = (sums[a + size] - sums[a]) * powers.down[a]
        lines.append(ok)
        keys.append(_mixed(content ^ _mixed(of[ok].astype(np.uint64) * np.uint64(edits + 1) + np.uint64(i))))
    return np.concatenate(lines), np.concatenate(keys)


# ---------------------------------------------------------------- runs of words

_SPACE = np.array([chr(i).isspace() for i in range(0x3001)] + [False])


def line_words(points: np.ndarray, start: np.ndarray, length: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of each word of the lines at ``start`` (ascending) of ``length``, in order."""
    powers.grow(len(points) + 1)
    space = np.ones(len(points) + 2, bool)
    space[1:-1] = _SPACE[np.minimum(points, 0x3001)]
    begin, end = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    line = np.searchsorted(start, begin, "right") - 1
    inside = line >= 0
    inside[inside] = begin[inside] < (start + length)[line[inside]]
    begin, end, line = begin[inside], end[inside], line[inside]
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(points.astype(np.uint64) * powers.up[: len(points)], out=sums[1:])
    return line, _mixed((sums[end] - sums[begin]) * powers.down[begin] ^ _mixed((end - begin).astype(np.uint64)))


def word_classes(alike: Alike) -> list[tuple[int, float, int]]:
    """(least, most, window) by the number of words of the longer of two lines, from two edited words on: some ``window`` neighbouring
    runs of ``RUN`` words are in both.

    Lines of n words with t = n // per edits of words have n - t of them in common at least, in t + 1 stretches at most. An edit of a code point
    touches two neighbouring words at most, so that with e of them n - 2 e words are in common, in e + 1 stretches.
    """
    bounds = [2 * alike.per, 4 * alike.per, float("inf")]
    shared = [min(-(-(n - n // alike.per) // (n // alike.per + 1)), -(-(n - 2 * alike.edits) // (alike.edits + 1))) for n in bounds[:2]]
    if shared[0] < RUN:
        raise ValueError("lines alike must share a run of words")
    return [(bounds[i], bounds[i + 1], shared[i] - RUN + 1) for i in range(2)]


def word_keys(line: np.ndarray, words: np.ndarray, count: np.ndarray, alike: Alike) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of lines of ``count`` words: of each window of runs of words the smallest hash.

    Two lines with a window's words in common, wherever they are, have its smallest hash in common. A line sends the keys of its
    own class of lengths, and of the next if a longer line alike can be in that one.
    """
    lines, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    n = len(words) - RUN + 1
    if n > 0:
        runs = np.zeros(n, np.uint64)
        for j in range(RUN):
            runs = runs * _BASE + words[j : j + n]
        runs, of = _mixed(runs), count[line]
        for i, (least, most, window) in enumerate(word_classes(alike)):
            m = n - window + 1
            if m <= 0:
                continue
            smallest = runs[:m].copy()
            for j in range(1, window):
                np.minimum(smallest, runs[j : j + m], out=smallest)
            last = window + RUN - 2
            shortest = least - max(least // alike.per, alike.edits)
            ok = (line[:m] == line[last : last + m]) & (of[:m] >= shortest) & (of[:m] < most)
            ok[1:] &= (smallest[1:] != smallest[:-1]) | (line[1:m] != line[: m - 1])
            lines.append(line[:m][ok])
            keys.append(_mixed(smallest[ok] + np.uint64(i + 1)))
    return np.concatenate(lines), np.concatenate(keys)


def keys_of(points: np.ndarray, start: np.ndarray, length: np.ndarray, alike: Alike, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of the lines at ``start`` (ascending) of ``length``; two that are alike have a key in common.

    Without edits of words: segments and probes of code points. Else lines on which less than two words may be edited send these, and
    segments and probes of words for one such edit. Of two edits of words on a line would send 12, 26, 49 keys and more, so longer lines send those of
    their runs of words (some 11 for 40 to 80 words), which are in common after edits of code points as well.
    """
    if not alike.per:
        return line_keys(points, start, length, alike.edits, powers)
    line, words = line_words(points, start, length, powers)
    count = np.bincount(line, minlength=len(start))
    few, one = np.flatnonzero(count < 2 * alike.per), np.flatnonzero((count >= alike.per - 1) & (count < 2 * alike.per))
    found = [(few, line_keys(points, start[few], length[few], alike.edits, powers)),
             (one, line_keys(words, (np.cumsum(count) - count)[one], count[one], 1, powers)),
             (np.arange(len(start)), word_keys(line, words, count, alike))]
    return np.concatenate([of[at] for of, (at, _) in found]), np.concatenate([key for _, (_, key) in found])


# ---------------------------------------------------------------- keys that lines share

def dealt_keys(found: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, pairs): keys and the ids of their lines by bucket of key, up to ``PACK`` of them in a row.

    Most keys are of one line. As rows of their own they cost more to write, sort and hand over than to compare.
    """
    key, ids = (np.concatenate(c) for c in zip(*found))
    for at in range(0, len(key), 4 * SENT):
        yield _dealt(key[at : at + 4 * SENT], ids[at : at + 4 * SENT], buckets)


def _dealt(key: np.ndarray, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket.astype(np.min_scalar_type(buckets - 1)), kind="stable")
    bucket, pairs = bucket[order], np.column_stack([key.view(np.int64)[order], ids[order]])
    cuts = np.union1d(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, np.arange(0, len(bucket), PACK))
    offsets = (np.append(cuts, len(bucket)) * 16).astype(np.int32)
    column = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(pairs)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts].astype(np.int32)), column], ["bucket", "pairs"])


def _members(rows: np.ndarray, few: int, many: np.ndarray) -> pa.RecordBatch:
    """(key, id, large: whether the key has more than ``few``) of keys that two or more ids share, or that are among ``many``; ``rows`` are (key, id)."""
    order = np.argsort(rows[:, 0])
    key = rows[order, 0]
    shared, same = np.isin(key, many), key[1:] == key[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    rows, n = _distinct(rows[order[shared]])
    known = np.isin(rows[:, 0], many)
    rows, large = rows[(n > 1) | known], ((n > few) | known)[(n > 1) | known]
    return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(large)], ["key", "id", "large"])


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct of ``rows`` (key, id), sorted, and for each the number of those of its key."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]).any(1)
    rows = rows[fresh]
    first = np.ones(len(rows), bool)
    first[1:] = rows[1:, 0] != rows[:-1, 0]
    run = np.cumsum(first) - 1
    return rows, np.bincount(run)[run] if len(rows) else run


def shared_keys(batches: Iterator[pa.RecordBatch], few: int, held: int, many: int) -> Iterator[pa.RecordBatch]:
    """``_members`` of each bucket, of (bucket, pairs) sorted by bucket.

    From ``held`` rows on those of keys of more than ``many`` ids are passed on, so that no key is held whole; such a row can come twice.
    """
    bucket, rows, n, most, passed = None, [], 0, held, np.zeros(0, np.int64)
    for batch in batches:
        buckets, column = batch.column("bucket").to_numpy(), batch.column("pairs").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // 8
        pairs = np.frombuffer(column.buffers()[2], np.int64, offsets[-1])
        cuts = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1).tolist(), len(buckets)]
        for begin, end in zip(cuts, cuts[1:]):
            if begin == end:
                continue
            if buckets[begin] != bucket:
                if rows:
                    yield _members(np.concatenate(rows), few, passed)
                bucket, rows, n, most, passed = buckets[begin], [], 0, held, passed[:0]
            rows.append(pairs[offsets[begin] : offsets[end]].reshape(-1, 2))
            n += len(rows[-1])
            if n > most:
                whole, count = _distinct(np.concatenate(rows))
                crowd = (count > many) | np.isin(whole[:, 0], passed)
                if crowd.any():
                    passed = np.union1d(passed, whole[crowd, 0])
                    yield _members(whole[crowd], few, passed)
                rows = [whole[~crowd]]
                n = len(rows[0])
                most = max(held, 2 * n)
    if rows:
        yield _members(np.concatenate(rows), few, passed)


# ---------------------------------------------------------------- verification

def within(a: str | list[str], b: str | list[str], edits: int | Alike) -> bool:
    """Whether at most ``edits`` edits turn ``a`` into ``b``: of code points if they are texts, of words if they are lists of them.

    Bit-parallel over a diagonal band of 2 * ``edits`` + 1 cells: bit k of a column's words stands for the row that lies k - ``edits`` below the
    diagonal. The value on the band's lower edge is carried along, then along the last row.
    """
    if isinstance(edits, Alike):
        if within(a, b, edits.edits):
            return True
        a, b = a.split(), b.split()
        most = edits.words(max(len(a), len(b)))
        return most > 0 and within(a, b, most)
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > edits:
        return False
    head, most = 0, len(b)
    while head < most and a[head : head + 32] == b[head : head + 32]:
        head += 32
    head = min(head, most)
    while head < most and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < most - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    m, n = len(a), len(b)
    if not n:
        return m <= edits
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + edits)  # shifted, so that column j's band starts at bit j
    width = 2 * edits + 1
    mask, bottom = (1 << width) - 1, 1 << (2 * edits)
    plus, minus, value, row = mask ^ ((1 << edits) - 1), 0, edits, 0
    for j, c in enumerate(b):
        same = (where.get(c, 0) >> j) & mask
        zero = ((((same & plus) + plus) ^ plus) | same | minus) & mask
        right = (minus | ~(zero | plus)) & mask
        left = zero & plus
        if j + edits < m:  # the lower edge goes on down its diagonal
            value += not zero & bottom
        else:  # the last row; it climbs one bit a column
            row = bottom >> (j + edits - m + 1)
            value += bool(right & row) - bool(left & row)
        if value > edits + (n - j - 1) + edits:
            return False
        plus, minus = (left | ~((zero >> 1) | right)) & mask, (zero >> 1) & right
    return value <= edits


#: What is known of a line: code points, words, parities of its counts of pairs of neighbouring code points, and of its counts of words (four longs).
FACTS = ["size", "count", "mark", "words0", "words1", "words2", "words3"]


def line_facts(points: np.ndarray, start: np.ndarray, length: np.ndarray, powers: Powers) -> np.ndarray:
    """``FACTS`` (a row each) of the lines at ``start`` (ascending) of ``length`` (1 at least), which line feeds part.

    An edit of a code point changes four bits of a mark at most, an edit of a word two of the marks of words.
    """
    out = np.zeros((len(start), len(FACTS)), np.uint64)
    out[:, 0] = length
    bits = np.zeros(len(points), np.uint64)
    bits[:-1] = np.uint64(1) << (_mixed(points[1:].astype(np.uint64) * np.uint64(0x1F123BB5) + points[:-1]) & np.uint64(63))
    feed = points == 10
    bits[feed] = 0
    bits[:-1][feed[1:]] = 0
    if len(start):
        out[:, 2] = np.bitwise_xor.reduceat(bits, start)
    line, words = line_words(points, start, length, powers)
    count = np.bincount(line, minlength=len(start))
    out[:, 1] = count
    some = np.flatnonzero(count)
    if len(some):
        first, bit = (np.cumsum(count) - count)[some], np.uint64(1) << (words & np.uint64(63))
        for k in range(4):
            out[some, 3 + k] = np.bitwise_xor.reduceat(np.where(words >> np.uint64(62) == k, bit, np.uint64(0)), first)
    return out


def screened(a: np.ndarray, b: np.ndarray, alike: Alike) -> np.ndarray:
    """For pairs of rows of facts (of the two one may be a single row): 1 if edits of code points may lead from one to the other, 2 if edits of words may, 3 if both may, else 0."""
    apart = np.bitwise_count(a[..., 2:] ^ b[..., 2:])
    size, count = a[..., :2].view(np.int64), b[..., :2].view(np.int64)
    difference = np.abs(size - count)
    most = alike.words(np.maximum(size[..., 1], count[..., 1]))
    close = (difference[..., 0] <= alike.edits) & (apart[..., 0] <= 4 * alike.edits)
    by_words = (most > 0) & (difference[..., 1] <= most) & (apart[..., 1:].sum(-1, dtype=np.int64) <= 2 * most)
    return close + 2 * by_words


def confirmed(x: str, y: str, how: int, alike: Alike) -> bool:
    """Whether two lines that the screen let through are alike; words come first, as there are fewer of them."""
    if how & 2:
        a, b = x.split(), y.split()
        if within(a, b, int(alike.words(max(len(a), len(b))))):
            return True
    return bool(how & 1) and within(x, y, alike.edits)


class Bags:
    """Of those lines that are asked for, the distinct words, as numbers, and how often each is there."""

    def __init__(self, texts: list[str]):
        self.texts, self.numbers, self.known = texts, {}, {}

    def _bag(self, x: int) -> tuple[np.ndarray, np.ndarray]:
        if x not in self.known:
            counts = Counter(self.texts[x].split())
            words = [self.numbers.setdefault(w, len(self.numbers)) for w in counts]
            self.known[x] = np.array(words, np.int32), np.fromiter(counts.values(), np.int32, len(words))
        return self.known[x]

    def may(self, x: int, others: np.ndarray, alike: Alike) -> np.ndarray:
        """Whether edits of words may lead from line ``x`` to each of the lines ``others``: each edit leaves all but one word of the longer one in common, wherever it is.

        The marks of ``line_facts`` are parities, so lines that repeat a few words again and again pass them whatever their counts.
        """
        out = [np.zeros(0, bool)]
        for first in range(0, len(others), 256):
            bags = [self._bag(y) for y in others[first : first + 256].tolist()]
            words, counts = self._bag(x)
            own = np.zeros(len(self.numbers), np.int32)
            own[words] = counts
            all_words, all_counts = (np.concatenate(c) for c in zip(*bags))
            begin = np.cumsum([0] + [len(w) for w, _ in bags[:-1]])
            longer = np.maximum(np.add.reduceat(all_counts, begin), counts.sum())
            out.append(np.add.reduceat(np.minimum(own[all_words], all_counts), begin) >= longer - alike.words(longer))
        return np.concatenate(out)


def _crowd_links(run: pa.Table, alike: Alike) -> Iterator[tuple[int, int]]:
    """Links (a, b) that join what is alike in a run (i, j, tile, id, facts..., line): a forest. Some rows at a time are screened against the run's other
    rows that aren't joined with them yet; what passes has its words counted."""
    tile, ids = run.column("tile").to_numpy(), run.column("id").to_pylist()
    facts = np.column_stack([run.column(f).to_numpy() for f in FACTS]).view(np.uint64)
    across, texts, m = run.column("i")[0] != run.column("j")[0], run.column("line").to_pylist(), run.num_rows
    parent, bags = list(range(m)), Bags(texts)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    block = max(1, BLOCK // m)
    for first in range(0, m, block):
        label = np.array([root(x) for x in range(m)])
        if (label == label[0]).all():
            return
        rows = np.arange(first, min(first + block, m))
        how = screened(facts[rows, None], facts[None, first:], alike)
        how[(label[rows, None] == label[None, first:]) | (np.arange(first, m) <= rows[:, None])] = 0
        if across:
            how[tile[rows, None] == tile[None, first:]] = 0
        for x in np.flatnonzero(how.any(1)).tolist():
            others = np.array([y for y in np.flatnonzero(how[x]).tolist() if root(first + y) != root(first + x)], np.int64)
            by_words = others[how[x, others] >= 2]
            how[x, by_words[~bags.may(first + x, first + by_words, alike)]] &= 1
            for y in others[how[x, others] > 0].tolist():
                p, q = root(first + x), root(first + y)
                if p != q and confirmed(texts[first + x], texts[first + y], int(how[x, y]), alike):
                    parent[q] = p
                    yield ids[first + x], ids[first + y]


def _pairs(rows: np.ndarray, alike: Alike) -> Iterator[tuple[np.ndarray, ...]]:
    """(a, b, how) of the pairs within runs that the screen lets through; ``rows`` are (key, id, facts...) sorted by key, then id."""
    key, facts = rows[:, 0], rows[:, 2:].view(np.uint64)
    at = np.arange(len(rows))
    for apart in range(1, len(rows)):
        at = at[at + apart < len(rows)]
        at = at[key[at + apart] == key[at]]
        if not len(at):
            return
        how = screened(facts[at], facts[at + apart], alike)
        some = how > 0
        yield rows[at[some], 1], rows[at[some] + apart, 1], how[some]


# ---------------------------------------------------------------- Spark

def _identified(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, text, doc_: hash of both) with null texts empty."""
    table = docs.select("doc_id", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return table.withColumn("doc_", F.xxhash64("doc_id", "text"))


def _fewest_crowds(crowds: DataFrame) -> DataFrame:
    """Runs (key, id, tile: of about ``TILE``) in which the lines of each of the runs ``crowds`` (key, id) meet, fewer of them where runs overlap.

    Lines alike share most of their keys, but need one test. Runs with the same smallest id are put together if that leaves at most ``WIDER`` times their pairs to screen; of the
    others, those of the same lines are kept once.
    """
    runs = crowds.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.bit_xor(F.xxhash64("id")).alias("ids"))
    runs = stored(runs, "line-crowd-runs")
    met = stored(crowds.join(runs.select("key", "least"), "key").select("least", "id").distinct(), "line-crowds-met")
    apart = runs.groupBy("least").agg(F.sum(F.pow("n", F.lit(2))).alias("pairs"))
    sizes = met.groupBy("least").agg(F.count("*").alias("n")).join(apart, "least")
    together = stored(sizes.where(F.pow("n", F.lit(2)) <= WIDER * F.col("pairs")).select("least", F.ceil(F.col("n") / TILE).alias("tiles")), "line-crowds-together")
    tile = F.pmod(F.xxhash64("id"), F.col("tiles")).alias("tile")
    whole = met.join(together, "least").select(F.col("least").alias("key"), "id", tile)
    once = runs.join(together, "least", "left_anti").groupBy("n", "least", "ids").agg(F.min("key").alias("key"))
    return whole.union(crowds.join(once.select("key", F.ceil(F.col("n") / TILE).alias("tiles")), "key").select("key", "id", tile))


def line_links(docs: DataFrame, edits: int | Alike, least: int) -> DataFrame:
    """Links (a, b) between ids (XXH64) of distinct lines of ``least`` code points or more that join all that are alike: at most ``edits`` edits apart.

    Lines send hashes of their segments and probes, and of runs of their words, in buckets; keys that two lines share are kept. Each candidate line's size and
    parities are computed once. In runs of up to ``FEW`` lines of a key, these select pairs, which are made distinct and verified once
    each, whatever number of keys they share. Longer runs that overlap are compared as one; there, lines already joined are not
    compared again, and only a forest of links is kept.
    Exact copies are not compared.
    """
    alike = edits if isinstance(edits, Alike) else Alike(edits)
    if least < 2 * alike.edits + 2:
        raise ValueError("lines must be longer than their segments' shifts")

    buckets, few, held, many = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), FEW, HELD, MANY

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, found, n = Powers(), [], 0
        for batch in batches:
            for points, starts, length, texts in _line_slices(batch, "text"):
                long = np.flatnonzero(length >= least)
                ids = np.array([xxhash.xxh64_intdigest(texts[i], 42) for i in long.tolist()], np.uint64).view(np.int64)
                first = np.sort(np.unique(ids, return_index=True)[1])
                ids, long = ids[first], long[first]
                if len(long):
                    at, key = keys_of(points, starts[long], length[long], alike, powers)
                    found.append((key, ids[at]))
                    n += len(key)
                if n >= SENT:
                    yield from dealt_keys(found, buckets)
                    found, n = [], 0
        if n:
            yield from dealt_keys(found, buckets)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            at = 0
            for points, starts, length, _ in _line_slices(batch, "line"):
                facts = line_facts(points, starts, length, powers).view(np.int64)
                ids = batch.column("id").slice(at, len(starts))
                at += len(starts)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(f, pa.int64()) for f in facts.T)], ["id", *FACTS])

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parted(batches, ["key", "id", *FACTS]):
            found = list(_pairs(rows, alike))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)], ["a", "b", "how"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [confirmed(x, y, how, alike) for x, y, how in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "how")))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    sent = bounded_scan(docs, "text").mapInArrow(members, "bucket int, pairs binary").repartition("bucket").sortWithinPartitions("bucket")
    multi = stored(sent.mapInArrow(lambda batches: shared_keys(batches, few, held, many), "key long, id long, large boolean"), "line-runs")
    wanted = stored(multi.select("id").distinct(), "line-candidates")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line")).where(F.length("line") >= least).withColumn("id", F.xxhash64("line"))
    texts = stored(lines.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("line").alias("line")), "line-texts")
    facts = stored(texts.mapInArrow(known, "id long, " + ", ".join(f"{f} long" for f in FACTS)), "line-facts")

    small = multi.where("NOT large").select("key", "id").join(facts, "id").select("key", "id", *FACTS)
    pairs = stored(small.repartition("key").sortWithinPartitions("key", "id").mapInArrow(paired, "a long, b long, how long").distinct(), "line-pairs")
    both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b").select("a", "b", "how", "x", "y")
    links = both.mapInArrow(verified, "a long, b long")
    crowds = stored(multi.where("large").select("key", "id").distinct(), "line-crowds")
    tiles = tile_pairs(stored(_fewest_crowds(crowds), "line-crowds"))
    order = ["key", "i", "j", "tile", "id"]
    dealt = tiles.join(facts, "id").join(texts, "id").select(*order, *FACTS, "line").repartition("key", "i", "j").sortWithinPartitions(*order)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in whole_runs(batches, ("key", "i", "j")):
            found = list(_crowd_links(run, alike))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return links.union(dealt.mapInArrow(compared, "a long, b long"))


def _line_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """(code points, starts, lengths, lines) of the lines of the texts of a batch, a slice of it at a time."""
    for _, texts in text_slices(batch, column):
        joined = b"\n".join(texts)
        points = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
        ends = np.append(np.flatnonzero(points == 10), len(points))
        starts = np.concatenate([[0], ends[:-1] + 1])
        yield points, starts, ends - starts, joined.split(b"\n")


def _parted(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[np.ndarray]:
    """The rows of longs of batches sorted by the first column, some ``ROWS`` at a time, never parting equal values of it."""
    held, n = [], 0
    for batch in batches:
        held.append(np.column_stack([batch.column(c).to_numpy() for c in columns]))
        n += batch.num_rows
        if n >= ROWS:
            rows = np.concatenate(held)
            other = np.flatnonzero(rows[:, 0] != rows[-1, 0])
            cut = other[-1] + 1 if len(other) else 0
            if cut:
                yield rows[:cut]
            held, n = [rows[cut:]], len(rows) - cut
    if n:
        yield np.concatenate(held)


def _cleaned(docs: DataFrame, edits: int | Alike, least: int, text: str, spread: int, words: int) -> DataFrame:
    """(in_: the given row, text: freed of repeated lines, n_lines, n_removed) for each row of ``docs``."""
    table = _identified(docs, text)
    places = table.select("doc_id", "doc_", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    short = F.length("line") < least
    places = places.where(~short | F.col("line").rlike(rf"(?U)(\S+\s+){{{words - 1}}}\S" if words else ""))
    owner = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    places = stored(places.select(F.struct(owner.alias("owner"), "doc_", "at").alias("place"), F.xxhash64("line").alias("id"), short.alias("short")), "line-places")
    classes = stored(components(line_links(table, edits, least), "line-classes"), "line-classes").withColumnsRenamed({"node": "id", "component": "class"})
    classed = places.join(classes, "id", "left").select("place", F.coalesce("class", "id").alias("class"), "short")
    firsts = classed.groupBy("class").agg(F.min("place").alias("first"), F.count("*").alias("n"), F.max("short").alias("short")).where("n > 1").drop("n")
    common = places.where("short").select(F.col("id").alias("class"), "place.doc_").distinct().groupBy("class").count().where(F.col("count") >= spread)
    firsts = firsts.join(common, "class", "left").where("NOT short OR count IS NOT NULL").drop("short", "count")
    firsts = stored(firsts, "line-firsts")  # read by itself, so that Spark can split the partition of a common class in the join
    removed = classed.join(firsts, "class").where(F.col("place") != F.col("first"))
    removed = removed.select("place.*").distinct().groupBy("owner", "doc_").agg(F.collect_list("at").alias("removed_"))
    given = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    keyed = packed(docs, owner.alias("owner"), "doc_id", given)
    keyed = keyed.withColumn("doc_", F.xxhash64("doc_id", "text")).drop("doc_id")
    return _without(keyed.join(removed, ["owner", "doc_"], "left").select("in_", "text", "removed_"))


def _given(name: str):
    return F.col(f"in_.`{name}`").alias(name)


def dedupe_lines(docs: DataFrame, edits: int | Alike = EDITS, least: int = LEAST, text: str = "text", spread: int = SPREAD, words: int = WORDS) -> DataFrame:
    """``docs`` with its texts freed of repeated lines, and columns n_lines and n_removed.

    Lines of at least ``least`` code points form a class if edits lead from one to the next, at most ``edits`` at a step (``Alike``: or its share of words); the first line of
    each class, by doc_id (nulls last), then place, stays, all others go. A shorter line is a class of its exact copies if it has ``words`` words or more and is in ``spread`` documents or more;
    other short lines stay always. With ``spread`` 1 and ``words`` 0 every exact copy goes, blank lines included. Lines are split at line feeds, and
    what stays is joined by them. Texts and lines of any length are handled whole.

    A null text is empty and has one empty line. Rows that are alike in doc_id and text are one document and get the same text. An empty table gives
    an empty result. Other columns are passed on, whatever their names; columns n_lines and n_removed of ``docs`` are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    cleaned = _cleaned(docs, edits, least, text, spread, words)
    return cleaned.select(*(F.col("text").alias(c) if c == text else _given(c) for c in kept), "n_lines", "n_removed")


def _without(marked: DataFrame) -> DataFrame:
    """(in_, text, n_lines, n_removed) of (in_, text, removed_): the text without the lines whose places are in removed_."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, counts, gone = [], [], []
            for t, r in zip(batch.column("text"), batch.column("removed_")):
                lines, drop = t.as_py().split("\n"), set(r.as_py() or ())
                out.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else t.as_py())
                counts.append(len(lines))
                gone.append(len(drop))
            yield pa.RecordBatch.from_arrays(
                [batch.column("in_"), pa.array(out, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], ["in_", "text", "n_lines", "n_removed"])

    schema = marked.select("in_", "text").withColumns({"n_lines": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long")}).schema
    return bounded_scan(marked, "in_", "text", "removed_").mapInArrow(scan, schema)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedupe_lines(docs).select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat; n_chars follows, all other columns, n_lines and n_removed included, are those given."""
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long").alias("n_chars")}
    return _cleaned(docs, EDITS, LEAST, "text", SPREAD, WORDS).select(*(new.get(c, _given(c)) for c in docs.columns))
