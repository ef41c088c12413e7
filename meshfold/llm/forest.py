"""Near duplicates by an LSH forest over MinHash signatures.

A document's set of word shingles gives 128 smallest hashes; each order of the forest sorts the documents by eight of them. Documents next to
each other in an order share a prefix, and how long a prefix makes them candidates depends on how crowded its region is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshfold.llm.common import Forest, bounded_scan, components, multi_runs, packed, stored, text_slices, whole_runs

#: Words of a shingle, and the share (percent) of all their shingles that two linked documents have in common at least.
WIDTH, SHARE = 5, 85
#: Values of a signature; orders of the forest, each of LEVELS values.
VALUES, ORDERS, LEVELS = 128, 32, 8
#: Depths at which a region's documents are candidates of each other; a region of more than REGION goes on to the next depth, and at
#: the last one is compared in tiles of REGION whatever its size.
DEPTHS, REGION = (4, 6, 8), 256
#: Orders compared first: what they link needn't be compared in the others.
FIRST = 4
#: Standard deviations below the expected number of equal values at which a pair is let through to the test of the full sets.
SPARE = 5.5
#: Rows that are picked by a broadcast of their numbers; more are picked by a shuffle.
BROADCAST_IDS = 1_000_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _seeds(n: int, salt: int) -> np.ndarray:
    return _mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt)) * _ODD)


def _orders() -> np.ndarray:
    """Which values each order sorts by: neighbouring ones in the first half of the orders, ones far apart in the other, so that two orders share one at most."""
    near = np.arange(VALUES).reshape(-1, LEVELS)
    return np.concatenate([near, near.T.reshape(LEVELS, -1, LEVELS).reshape(-1, LEVELS)])


# ---------------------------------------------------------------- sets and signatures

def shingle_set(text: bytes, width: int, known: dict[bytes, int]) -> np.ndarray:
    """Distinct 64-bit hashes, sorted, of the runs of ``width`` words of the lower-cased text; of all its words if there are fewer. ``known`` holds hashes of words."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > 1 << 18:
        known.clear()
    hashes = np.array([known.get(w) or known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words], np.uint64)
    take = min(width, len(words))
    n = len(words) - take + 1
    sums = np.full(n, take, np.uint64)
    for j in range(take):
        sums = sums * _ODD + hashes[j : j + n]
    return np.unique(_mixed(sums))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``VALUES`` smallest hashes (16 bits of each) of a set that isn't empty."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    factor, shift = _seeds(VALUES, 0) | np.uint64(1), _seeds(VALUES, 1 << 20)
    for at in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[at : at + 2048, None] * factor + shift).min(axis=0), out=least)
    return (least >> np.uint64(48)).astype("<u2")


def prefix_keys(signatures: np.ndarray, depth: int) -> np.ndarray:
    """For each signature (a row) and order, a key of the order's first ``depth`` values; its top bits are the order."""
    orders = _orders()
    steps = _seeds(LEVELS, 1 << 24)
    keys = np.broadcast_to(_seeds(ORDERS, depth << 8), (len(signatures), ORDERS))
    for level in range(depth):
        keys = _mixed(keys ^ (signatures[:, orders[:, level]].astype(np.uint64) + steps[level]))
    return (keys >> np.uint64(5)) | (np.arange(ORDERS, dtype=np.uint64) << np.uint64(59))


_FACTS = {"id": "long", "n_shingles": "long", "signature": "binary"}


def signed(docs: DataFrame, width: int, *beside: str) -> DataFrame:
    """(beside..., id, n_shingles, signature) of ``docs`` (beside..., text): the set's own hash, its size and its signature. Without words, id and signature are null.

    The sets themselves are larger than the texts, and few are needed again: they are made anew from these."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            for first, texts in text_slices(batch, "text"):
                sets = [shingle_set(t, width, known) for t in texts]
                ids = [np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)) if len(s) else None for s in sets]
                columns = [pa.array(ids, pa.int64()), pa.array(map(len, sets), pa.int64()),
                           pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, len(texts)) for c in beside), *columns], [*beside, *_FACTS])

    schema = docs.select(*beside).withColumns({c: F.lit(None).cast(t) for c, t in _FACTS.items()}).schema
    return bounded_scan(docs, *beside, "text").mapInArrow(scan, schema)


# ---------------------------------------------------------------- regions

def _prefixes(signatures: DataFrame, depth: int) -> DataFrame:
    """(key, id) for each of ``signatures`` (id, signature) and order."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("signature").to_pylist()
            if held:
                keys = prefix_keys(np.frombuffer(b"".join(held), "<u2").reshape(-1, VALUES), depth)
                ids = np.repeat(batch.column("id").to_numpy(), ORDERS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64), pa.int64()), pa.array(ids, pa.int64())], ["key", "id"])

    return bounded_scan(signatures, "id", "signature").mapInArrow(scan, "key long, id long")


def _order(key: str = "key"):
    return F.shiftrightunsigned(key, 59)


def regions(signatures: DataFrame) -> DataFrame:
    """(key, id, tile): members of regions of two or more. A region that is too crowded at one depth is split by the next values of its order;
    at the last depth it has as many tiles as it needs."""
    parts, at = [], signatures
    for depth in DEPTHS:
        members = _prefixes(at, depth)
        if depth > DEPTHS[0]:  # of these documents, the orders in which they are crowded
            members = members.withColumn("order", _order()).join(crowded, ["id", "order"], "left_semi")
        found = multi_runs(members, "forest-regions", REGION)
        if depth == DEPTHS[-1]:
            parts.append(found)
            break
        full = stored(found.where("tile > 0").select("key").distinct(), "forest-crowded")
        if full.isEmpty():
            parts.append(found)
            break
        parts.append(found.join(full, "key", "left_anti"))
        crowded = stored(found.join(full, "key", "left_semi").select("id", _order().alias("order")), "forest-crowded")
        at = signatures.join(crowded.select("id").distinct(), "id", "left_semi")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return stored(whole, "forest-regions") if len(parts) > 1 else whole


# ---------------------------------------------------------------- links

def _compared(run: pa.Table, sets: list[np.ndarray], share: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (a, b) between labels that join what is linked in a run, whose rows have ``sets``; members of one label are joined already."""
    ids, tile, label = (run.column(c).to_numpy() for c in ("id", "tile", "label"))
    across = run.column("i")[0] != run.column("j")[0]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    elements, dense = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(elements), np.int32)
    forest = Forest(len(ids))
    forest.label = np.unique(label, return_inverse=True)[1]
    for x in range(len(ids) - 1):
        others = np.arange(x + 1, len(ids))
        fit = (forest.label[others] != forest.label[x]) & (100 * np.minimum(sizes[others], sizes[x]) >= share * np.maximum(sizes[others], sizes[x]))
        if across:
            fit &= tile[others] != tile[x]
        others = others[fit]
        if not len(others):
            continue
        own = dense[starts[x] : starts[x] + sizes[x]]
        mark[own] = 1
        if 8 * len(others) < len(ids):
            shared = np.array([mark[dense[starts[y] : starts[y] + sizes[y]]].sum() for y in others])
        else:
            shared = np.add.reduceat(mark[dense], starts)[others]
        mark[own] = 0
        found = others[100 * shared >= share * (sizes[others] + sizes[x] - shared)]
        if len(found):
            _, first = np.unique(forest.label[found], return_index=True)
            yield np.full(len(first), label[x]), label[found[first]]
            forest.join(x, found)


def _each_run(members: DataFrame, columns: list[str], scan, schema: str) -> DataFrame:
    """``scan`` over the rows (key, i, j, tile, id, label, columns...) of each (key, i, j)."""
    order = ["key", "i", "j", "tile", "id"]
    dealt = members.select(*order, "label", *columns).repartition("key", "i", "j").sortWithinPartitions(*order)
    return dealt.mapInArrow(lambda batches: (out for run in whole_runs(batches, ("key", "i", "j")) for out in scan(run)), schema)


def _screened(members: DataFrame, share: int) -> DataFrame:
    """Those of ``members`` (key, i, j, tile, id, label, n_shingles, signature) whose signature and size let them be linked with a member of another label.

    Of ``VALUES`` values a pair of the least share has that share in common on average; ``SPARE`` standard deviations fewer are let through, so one of
    some ten million such pairs is lost.
    """
    least = VALUES * share / 100 - SPARE * (VALUES * share * (100 - share)) ** 0.5 / 100

    def scan(run: pa.Table) -> Iterator[pa.RecordBatch]:
        values = np.frombuffer(b"".join(run.column("signature").to_pylist()), "<u2").reshape(-1, VALUES)
        label, tile, sizes = (run.column(c).to_numpy() for c in ("label", "tile", "n_shingles"))
        across, keep = run.column("i")[0] != run.column("j")[0], np.zeros(len(label), bool)
        for x in range(len(label) - 1):
            fit = (label[x + 1 :] != label[x]) & (100 * np.minimum(sizes[x + 1 :], sizes[x]) >= share * np.maximum(sizes[x + 1 :], sizes[x]))
            if across:
                fit &= tile[x + 1 :] != tile[x]
            others = x + 1 + np.flatnonzero(fit)
            others = others[(values[others] == values[x]).sum(axis=1) >= least]
            keep[others] = True
            keep[x] |= len(others) > 0
        if keep.any():
            yield from run.select(["key", "i", "j", "tile", "id", "label"]).filter(pa.array(keep)).combine_chunks().to_batches()

    return _each_run(members, ["n_shingles", "signature"], scan, "key long, i long, j long, tile long, id long, label long")


def _confirmed(members: DataFrame, width: int, share: int) -> DataFrame:
    """Links (a, b) between labels of ``members`` (key, i, j, tile, id, label, text) of each (key, i, j), tested on the full sets of the texts."""
    known: dict[bytes, int] = {}

    def scan(run: pa.Table) -> Iterator[pa.RecordBatch]:
        sets = [shingle_set(t, width, known) for t in run.column("text").cast(pa.binary()).to_pylist()]
        found = list(_compared(run, sets, share))
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return _each_run(members, ["text"], scan, "a long, b long")


def _rest(members: DataFrame) -> DataFrame:
    """``members`` (key, id, label) dealt so that any two of a key whose labels differ meet in one (key, i, j).

    A label with ``REGION`` members or more has tiles of its own, which don't meet each other; members of other labels share tiles and meet all. So a
    few strays beside a large component cost a pass over it, not its square.
    """
    sizes = members.groupBy("key", "label").agg(F.count("*").alias("n"))
    groups = sizes.groupBy("key", F.when(F.col("n") >= REGION, F.col("label")).alias("own")).agg(F.ceil(F.sum("n") / REGION).alias("tiles"))
    order = Window.partitionBy("key").orderBy("own")
    groups = groups.withColumn("start", F.sum("tiles").over(order) - F.col("tiles")).withColumn("all", F.sum("tiles").over(Window.partitionBy("key")))
    groups = stored(groups, "forest-tiles")
    own = sizes.where(F.col("n") >= REGION).select("key", "label", F.col("label").alias("own"))
    dealt = members.join(own, ["key", "label"], "left").alias("m").join(groups.alias("g"), F.expr("m.key = g.key AND m.own <=> g.own"))
    dealt = dealt.select("m.*", "start", "tiles", "all")
    tile = F.col("start") + F.pmod(F.xxhash64("id"), F.col("tiles"))
    others = F.expr("filter(sequence(0L, all - 1), t -> own IS NULL OR t < start OR t >= start + tiles)")
    dealt = dealt.select("key", "id", "label", tile.alias("tile"), F.explode(others).alias("other"))
    return dealt.select("key", "id", "label", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))


def _chained(found: DataFrame) -> DataFrame:
    """``found`` with tiles as pairs (i, i); the last member of a tile is in the next tile too, so that alike members of a region of many tiles become one component."""
    last = found.where("tile > 0").select("key").distinct()
    ends = found.join(last, "key", "left_semi").groupBy("key", "tile").agg(F.max("id").alias("id"), F.max("label").alias("label"))
    beyond = found.where("tile > 0").select("key", "tile").distinct()
    ends = ends.withColumn("tile", F.col("tile") + 1).join(beyond, ["key", "tile"], "left_semi")
    whole = found.select("key", "tile", "id", "label").union(ends.select("key", "tile", "id", "label"))
    return whole.withColumns({"i": F.col("tile"), "j": F.col("tile")})


def _fewest_runs(members: DataFrame) -> DataFrame:
    """Runs (key, i, j, tile, id, label) in which the members of each of the runs ``members`` meet, fewer of them where many runs overlap.

    Two alike documents meet in most orders, but need one test. Runs that share members form a group; where its documents, in tiles that all meet, are sent
    less often than by its runs, they take the place of these. A large, loose group keeps its runs.
    """
    members = stored(members.select("key", "i", "j", "tile", "id", "label"), "forest-runs")
    first = members.groupBy("key", "i", "j").agg(F.min("id").alias("least"))
    near = members.join(first, ["key", "i", "j"]).select(F.col("id").alias("a"), F.col("least").alias("b"))
    groups = stored(components(near, "forest-groups"), "forest-groups").withColumnsRenamed({"node": "id", "component": "group"})
    placed = stored(members.join(groups, "id"), "forest-grouped")
    sent = placed.groupBy("group").agg(F.count("*").alias("sent"))
    each = placed.select("group", "id", "label").distinct()
    sizes = each.groupBy("group").agg(F.ceil(F.count("*") / REGION).alias("tiles"), F.count("*").alias("n"))
    better = stored(sizes.join(sent, "group").where("n * tiles <= sent").select("group", "tiles"), "forest-better")
    kept = placed.join(better, "group", "left_anti").select("key", "i", "j", "tile", "id", "label")
    whole = each.join(better, "group").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")))
    whole = whole.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    key = F.xxhash64(F.lit("group"), "group")  # apart from the keys of orders but by a chance that joins two runs, which does no harm
    return kept.union(whole.select(key.alias("key"), F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "id", "label"))


def set_links(rows: DataFrame, texts: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """(id, root) of the ids of ``rows`` (a stored table: row_, id, n_shingles, signature; an id may come more than once, with the same set): two ids have the same
    root if links of at least ``share`` percent join them; ids that no region holds are left out. ``texts`` (row_, text) are the rows' texts; a row that repeats has the same one.

    The first orders are compared at once, a crowded region's members in neighbouring tiles. Of the regions of all orders, then, only those are looked at
    in which components still meet, crowded ones as a whole, and only members of different components are compared. Each time signatures come first, and only
    texts of what they let through are sent. The links of a run are a forest, never all pairs.
    """
    facts = [F.min("row_").alias("row_"), *(F.first(c).alias(c) for c in ("n_shingles", "signature"))]
    sets = stored(rows.where("id IS NOT NULL").groupBy("id").agg(*facts), "forest-sets")
    found = regions(sets.select("id", "signature"))
    wanted = stored(found.select("id").distinct(), "forest-wanted")
    sketches = sets.select("id", "n_shingles", "signature").join(_sent(wanted), "id", "left_semi")

    def joined(members: DataFrame) -> DataFrame:
        runs = stored(_fewest_runs(_screened(members.join(sketches, "id"), share)), "forest-fewest")
        picked = stored(sets.select("row_", "id").join(runs.select("id").distinct(), "id", "left_semi"), "forest-picked")
        whole = texts.join(_sent(picked), "row_").groupBy("id").agg(F.first("text").alias("text"))
        links = _confirmed(runs.join(whole, "id"), width, share)
        return components(links, "forest-components").withColumnRenamed("component", "joined")

    def renamed(table: DataFrame, column: str, by: DataFrame) -> DataFrame:
        return table.join(by.withColumnRenamed("node", column), column, "left").withColumn(column, F.coalesce("joined", column)).drop("joined")

    first = found.where(_order() < FIRST).withColumn("label", F.col("id"))
    labels = stored(renamed(wanted.select("id", F.col("id").alias("label")), "label", joined(_chained(first))), "forest-labels")
    crowded = stored(found.where("tile > 0").select("key").distinct(), "forest-crowded")
    at = found.join(labels, "id")
    mixed = stored(at.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key"), "forest-mixed")
    at = stored(at.join(mixed, "key", "left_semi"), "forest-members")
    others = at.where(_order() >= FIRST).join(crowded, "key", "left_anti").select("key", "id", "label", "tile", F.col("tile").alias("i"), F.col("tile").alias("j"))
    if not crowded.isEmpty():
        others = others.union(_rest(at.join(crowded, "key", "left_semi")))
    return renamed(labels, "label", joined(others)).withColumnRenamed("label", "root")


def _sent(picked: DataFrame) -> DataFrame:
    """A stored table of numbers, to be broadcast if it is small enough."""
    return F.broadcast(picked) if picked.count() <= BROADCAST_IDS else picked


def near_duplicates(docs: DataFrame, width: int = WIDTH, share: int = SHARE, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``: the smallest doc_id that is reachable over documents whose sets of ``width``-word shingles have
    at least ``share`` percent of their union in common, and whether that is the row's own.

    A document of fewer words has the whole sequence as its one shingle; one without words, or with null text, has none and is linked with nothing.
    Equal sets are one node. Links are confirmed on the full sets; a pair of share s is met in one order with probability s^depth, so at 0.85 and the
    first depth it is missed by all orders with one of 10^10, and at the last depth, within crowded regions, with 10^-4, unless others join them. Repeated rows come
    out as often as they are; a null doc_id never names a component unless all are null; texts are handled whole, one by one, and a task holds two tiles of
    ``REGION`` sets; an empty table gives an empty result; other columns are not read.
    """
    table = docs.select("doc_id", F.col(f"`{text}`").alias("text")).withColumn("row_", F.xxhash64("doc_id", "text"))
    rows = stored(signed(table, width, "doc_id", "row_"), "forest-rows")
    links = set_links(rows, table.select("row_", "text"), width, share)
    least = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("least")).join(links, "id", "left")
    rooted = stored(least.select("id", "least", F.coalesce("root", "id").alias("root")), "forest-roots")
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    result = rows.select("doc_id", "n_shingles", "id").join(rooted.join(lowest, "root").select("id", "component_id"), "id", "left")
    component = F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """``docs`` (doc_id, text and others) with one row of each component: that of the smallest doc_id, nulls last; of rows that share it, one. Documents
    without words all stay."""
    held = stored(packed(docs, "doc_id", "text").withColumn("row_", F.monotonically_increasing_id()), "forest-docs")
    rows = stored(signed(held, width, "doc_id", "row_"), "forest-rows")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_")
    first = rows.where("id IS NOT NULL").groupBy("id").agg(F.min(order).alias("o")).join(set_links(rows, held.select("row_", "text"), width, share), "id", "left")
    stays = first.groupBy(F.coalesce("root", "id").alias("root")).agg(F.min("o").alias("o")).select("o.row_").union(rows.where("id IS NULL").select("row_"))
    return held.join(stays, "row_", "left_semi").select("in_.*")


def op11_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_UPPER, _LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LETTERS}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) >= {WIDTH} THEN list_transform(range(1, len(w) - {WIDTH - 2}), lambda i: array_to_string(w[i:i + {WIDTH - 1}], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
e AS (SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= {SHARE} * (x.n + y.n - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
t AS (SELECT r AS a, r AS b FROM d UNION SELECT t.a, l.b FROM t JOIN l ON t.b = l.a),
m AS (SELECT a AS r, min(doc_id) AS component_id FROM t JOIN d ON d.r = b GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM d JOIN m USING (r) LEFT JOIN n USING (r)
"""
