"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.llm.common import bounded_scan, packed, text_slices

#: Bounds of the labelled sample that the model is fitted on: documents, and lines of one of them. At most some 100 MB reach the driver.
TRAIN_DOCS, TRAIN_LINES = 10_000, 200
ROUNDS, RATE, PENALTY = 200, 0.1, 1e-4
BAD, GOOD = 0, 1

_UPPER, _LOWER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_SENTENCE, _SPACE = b".,;:?'\"()-", b" \t\r\x0b\x0c"
_MARKS = bytes(c for c in range(33, 127) if c not in _UPPER + _LOWER + _DIGITS + _SENTENCE)


# ---------------------------------------------------------------- features

def lines_of(text: bytes) -> list[bytes]:
    """The lines with something on them; one empty line if there is none."""
    return [s for line in text.split(b"\n") if (s := line.strip(_SPACE))] or [b""]


def _own(line: bytes) -> tuple[float, ...]:
    n = len(line)
    if not n:
        return (1.0,) + (0.0,) * 12
    words = line.split()
    k = len(words)
    share = lambda drop: (n - len(line.translate(None, drop))) / n
    upper, lower = share(_UPPER), share(_LOWER)
    return (
        0.0, np.log1p(n), share(_MARKS), upper, upper / (upper + lower + 1e-9), share(_DIGITS), share(_SENTENCE), len(b"".join(words)) / k,
        sum(map(eq, words, words[1:])) / k, 1 - len(set(words)) / k, float(line[-1:] in b".!?"), sum(w[-1:] in b"!*$#%&|~^" for w in words) / k, np.log1p(k),
    )


OWN = 13
#: A line's own features, those of the line before and after (zeros at the ends), whether it is first or last, and a constant.
WIDTH = 3 * OWN + 3


def own_features(lines: list[bytes]) -> np.ndarray:
    return np.array([_own(x) for x in lines], np.float32)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    out = np.zeros((len(own), WIDTH), np.float32)
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN : 3 * OWN] = own[1:]
    out[0, -3] = out[-1, -2] = out[:, -1] = 1
    return out


# ---------------------------------------------------------------- the chain

@dataclass
class Chain:
    """Weights on the standardised features in favour of the good label, and the transitions' scores from label to label."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights


class Padded:
    """Sequences of several lengths side by side, longest first: at step t the first ``active[t]`` rows have a line."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        starts = (np.cumsum(lengths) - lengths)[self.order]
        steps = int(self.lengths[0])
        self.active = np.searchsorted(-self.lengths, -np.arange(steps), "left")
        self.at = [starts[: self.active[t]] + t for t in range(steps)]


def marginals(good: np.ndarray, steps: np.ndarray, shape: Padded) -> tuple[np.ndarray, np.ndarray, float]:
    """(probability of the good label for each line, expected transitions summed over all, log partition) by forward-backward.

    ``good`` are the lines' scores for the good label against 0 for the bad one.
    """
    n, last = len(good), len(shape.at) - 1
    unary = np.stack([np.zeros(n), good], axis=1)
    move = np.exp(steps)
    local = np.exp(unary - unary.max(axis=1, keepdims=True))
    forward, norm = np.empty((n, 2)), np.empty(n)
    for t, at in enumerate(shape.at):
        a = local[at] if not t else forward[shape.at[t - 1][: len(at)]] @ move * local[at]
        norm[at] = a.sum(axis=1)
        forward[at] = a / norm[at, None]
    backward = np.ones((n, 2))
    pairs = np.zeros((2, 2))
    for t in range(last - 1, -1, -1):
        after = shape.at[t + 1]
        at = shape.at[t][: len(after)]
        carried = backward[after] * local[after] / norm[after, None]
        backward[at] = carried @ move.T
        pairs += forward[at].T @ carried * move
    both = forward * backward
    return both[:, GOOD] / both.sum(axis=1), pairs, float(np.log(norm).sum() + unary.max(axis=1).sum())


def fit(x: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> Chain:
    """The chain of greatest penalised likelihood, by Adam over the whole sample. A line's label is its document's."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale = 0, np.where(scale > 1e-6, scale, 1)
    z = ((x - mean) / scale).astype(np.float64)
    shape = Padded(lengths)
    y = np.repeat(labels, lengths).astype(float)
    seen = np.zeros((2, 2))
    for label in (BAD, GOOD):
        seen[label, label] = (lengths - 1)[labels == label].sum()
    theta, m, v = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for k in range(1, ROUNDS + 1):
        p, pairs, _ = marginals(z @ theta[:WIDTH], theta[WIDTH:].reshape(2, 2), shape)
        slope = np.concatenate([z.T @ (y - p), (seen - pairs).ravel()]) / len(lengths) - PENALTY * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Chain(mean, scale, theta[:WIDTH], theta[WIDTH:].reshape(2, 2))


def document_scores(texts: list[bytes], chain: Chain | None) -> list[float]:
    """The mean marginal of the good label over a document's lines, weighted by their bytes."""
    if chain is None:
        return [0.5] * len(texts)
    lines = [lines_of(t) for t in texts]
    lengths = np.array([len(x) for x in lines])
    x = np.concatenate([with_neighbours(own_features(part)) for part in lines])
    p, _, _ = marginals(chain.scores(x), chain.steps, Padded(lengths))
    weight = np.array([len(s) + 1 for part in lines for s in part], float)
    begins = np.cumsum(lengths) - lengths
    return np.clip(np.add.reduceat(p * weight, begins) / np.add.reduceat(weight, begins), 0, 1).tolist()


# ---------------------------------------------------------------- Spark

def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learnt: crc32 of the id as text leaves 1 when divided by 3. A null id is not one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Chain | None:
    """The chain fitted on the labelled rows that are not held out, ``TRAIN_DOCS`` at most; None without any.

    The sample is drawn from the ids that ``docs`` really holds, those with the smallest hashes, so labels of other documents take no place in
    it. Of a document of more than ``TRAIN_LINES`` lines the middle ones count. Of contradictory labels the lower counts.
    """
    labelled = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    )
    present = docs.select("doc_id").join(labelled, "doc_id").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch, "text"):
                part = batch.slice(first, len(texts))
                found = [lines_of(t) for t in texts]
                data = [own_features(x)[max(0, len(x) - TRAIN_LINES) // 2:][:TRAIN_LINES].tobytes() for x in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(data, pa.binary())], ["doc_id", "quality", "x"])

    rows = bounded_scan(marked, "doc_id", "quality", "text").mapInArrow(scan, "doc_id long, quality int, x binary")
    rows = rows.orderBy(F.xxhash64("doc_id", "x")).limit(TRAIN_DOCS).collect()
    if not rows:
        return None
    x = [with_neighbours(np.frombuffer(r.x, np.float32).reshape(-1, OWN)) for r in rows]
    return fit(np.concatenate(x), np.array([len(a) for a in x]), np.array([r.quality for r in rows]))


def score(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """``docs`` with columns score (0 to 1, higher: good likelier) and predicted (1 from 0.5 on).

    Empty and null texts are scored as one empty line; without a chain all scores are 0.5; repeated rows get equal scores; an
    empty table gives an empty result. Columns score and predicted of ``docs`` are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(chain)
    docs = docs.drop("score", "predicted")
    names = docs.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [s for _, texts in text_slices(batch, "text") for s in document_scores(texts, held.value)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, "score"])

    plain = [F.col(f"`{c}`").alias(c if c == "text" else f"c{i}") for i, c in enumerate(names)]  # a scan takes no names with dots
    scored = bounded_scan(docs, *plain).mapInArrow(scan, docs.withColumn("score", F.lit(0.0)).schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    chain = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, chain).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier doesn't reject."""
    chain = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    whole = packed(docs, "text")
    return score(whole, chain).where("predicted = 1").select("in_.*")
