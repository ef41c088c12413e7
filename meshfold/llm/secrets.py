"""Secret scan with multipart credential linking, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.llm.common import stored


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _any(*names: str) -> str:
    return "(?:" + "|".join(map(_either, names)) + ")"


_SIGN = r"""["']?\x20*[:=]\x20*["']?"""
# The patterns of each kind, and the least length of the group that counts (0: the whole match).
KINDS = ("assign", "access", "hex", "wid", "wsecret", "endpoint")
PATTERNS = {
    "assign": "(" + "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key"))) + ")" + _SIGN + "([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "wid": _any("access[_-]?key[_-]?id", "client[_-]?id", "account", "username", "user", "login") + _SIGN + "[A-Za-z0-9@._-]{3,}",
    "wsecret": "[A-Za-z0-9+/]{32,}",
    "endpoint": "https?://[A-Za-z0-9.-]+(?::[0-9]+)?[A-Za-z0-9._~/-]*",
}
#: Parts of a credential by kind. The base kinds are reported always, the weak ones only beside complementary parts.
BASE, IDENTIFIERS, SECRETS = ("assign", "access", "hex"), ("access", "wid"), ("assign", "hex", "wsecret")
#: A weak kind is reported if each of these groups has a part that starts at most ``SCOPE`` code points away in the same document.
NEEDS = {"wid": [SECRETS], "wsecret": [IDENTIFIERS], "endpoint": [IDENTIFIERS, SECRETS]}
SCOPE = 256


def _found(kind: str):
    """Array of (gap, size, kept) of the matches of a kind, leftmost and non-overlapping: the code points between the match before and this
    one, those of the match, and whether it counts."""
    text, pattern = F.col("text"), PATTERNS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else whole
    kept = {"assign": "length(x.value) >= 6", "wsecret": "x.value RLIKE '[0-9]' AND x.value RLIKE '[A-Z]' AND x.value RLIKE '[a-z]'"}.get(kind, "true")
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))
    named = f"transform(filter(parts_{kind}, x -> x.whole IS NOT NULL), x -> named_struct('gap', length(x.gap), 'size', length(x.whole), 'kept', {kept}))"
    return F.when(text.rlike(pattern), parts), F.coalesce(F.expr(named), F.expr("CAST(array() AS array<struct<gap: int, size: int, kept: boolean>>)"))


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the stored rows (row_, doc_id) and the matches (row_, kind, start, end) in code points, end exclusive.

    Positions are running sums over the matches of a document, so a text with many matches costs in proportion.
    """
    scan = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row_"))
    scan = scan.withColumns({f"parts_{k}": _found(k)[0] for k in KINDS}).select("row_", "doc_id", *(_found(k)[1].alias(k) for k in KINDS))
    rows = stored(scan, "secret-parts")
    found = None
    for kind in KINDS:
        one = rows.where(F.size(kind) > 0).select("row_", F.lit(kind).alias("kind"), F.posexplode(kind).alias("at", "m")).select("row_", "kind", "at", "m.*")
        found = one if found is None else found.union(one)
    end = F.expr("sum(CAST(gap + size AS long)) OVER (PARTITION BY row_, kind ORDER BY at)")
    placed = found.withColumn("end", end).select("row_", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "kept")
    return rows.select("row_", "doc_id"), placed.where("kept").drop("kept")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans of ``found`` beside which complementary parts lie.

    An interval join: each weak span looks into the stretches of ``scope`` code points around its start, and a semi-join keeps it if a
    part of the needed group starts within the scope there. No pair is ever emitted, and a stretch holds a bounded number of parts.
    """
    def beside(weak: DataFrame, group: tuple[str, ...]) -> DataFrame:
        parts = found.where(F.col("kind").isin(*group)).select(F.col("row_").alias("p_row"), F.col("start").alias("p_start"), F.expr(f"start DIV {scope}").alias("p_stretch"))
        around = weak.withColumn("stretch", F.explode(F.expr(f"sequence(start DIV {scope} - 1, start DIV {scope} + 1)")))
        near = (F.col("row_") == F.col("p_row")) & (F.col("stretch") == F.col("p_stretch")) & (F.abs(F.col("start") - F.col("p_start")) <= scope)
        return around.join(parts, near, "left_semi").select("row_", "kind", "start", "end").distinct()

    out = None
    for kind, groups in NEEDS.items():
        weak = found.where(F.col("kind") == kind)
        for group in groups:
            weak = beside(weak, group)
        out = weak if out is None else out.union(weak)
    return out


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, spans) for each row of ``docs``: array of (start, rank, kind, end) by start, then kind as in ``KINDS``; base spans and linked
    weak ones.

    Null or empty texts have none; repeated rows come out as often as they are; null doc_ids are kept; an empty table gives an
    empty result; further columns are not read.
    """
    rows, found = spans(docs)
    found = stored(found, "secret-spans")
    kept = found.where(F.col("kind").isin(*BASE)).union(linked(found, scope))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    lists = kept.groupBy("row_").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans"))
    empty = F.expr("CAST(array() AS array<struct<start: long, rank: int, kind: string, end: long>>)")
    return rows.join(lists, "row_", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _sql() -> str:
    quoted = {k: "'" + p.replace("'", "''") + "'" for k, p in PATTERNS.items()}
    kept = {"assign": "len(v) >= 6", "wsecret": "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]')"}
    found = " UNION ALL ".join(
        f"SELECT r, {i} AS rank, '{k}' AS kind, unnest(range(len(m))) AS pos, unnest(m) AS m, unnest(v) AS v, unnest(g[1:len(m)]) AS g FROM (SELECT r, "
        f"regexp_extract_all(text, {quoted[k]}, 0) AS m, regexp_extract_all(text, {quoted[k]}, {2 if k == 'assign' else 0}) AS v, string_split_regex(text, {quoted[k]}) AS g FROM d)"
        for i, k in enumerate(KINDS))
    counts = " OR ".join(f"(kind = '{k}' AND ({kept.get(k, 'true')}))" for k in KINDS)
    near = lambda group: f"EXISTS (FROM s p WHERE p.r = s.r AND p.kind IN ({', '.join(map(repr, group))}) AND abs(p.start_ - s.start_) <= {SCOPE})"
    weak = " OR ".join(f"(kind = '{k}' AND {' AND '.join(map(near, groups))})" for k, groups in NEEDS.items())
    base = f"kind IN ({', '.join(map(repr, BASE))})"
    text = "string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, rank)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({found}),
e AS (SELECT r, rank, kind, m, v, sum(len(g) + len(m)) OVER (PARTITION BY r, kind ORDER BY pos) AS end_ FROM f),
s AS (SELECT r, rank, kind, CAST(end_ - len(m) AS BIGINT) AS start_, CAST(end_ AS BIGINT) AS end_ FROM e WHERE {counts}),
k AS (SELECT * FROM s WHERE {base} OR {weak}),
g AS (SELECT r, {', '.join(f"count(*) FILTER (kind = '{b}') AS n_{b}" for b in BASE)}, {text} FILTER ({base}) AS base, {text} AS spans FROM k GROUP BY r)
SELECT doc_id, {', '.join(f"CAST(coalesce(n_{b}, 0) AS BIGINT) AS n_{b}" for b in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


SQL = _sql()
