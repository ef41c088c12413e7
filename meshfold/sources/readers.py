"""Loading geometry from text files: CSV, TSV, WKT and GeoJSON, one object per line.

``offset`` is the 0-based column where the geometry starts. Every row keeps its input line as ``user_data``. Rows
get a running ``id`` unless ``id_column`` names the column of the line that holds one. The parsing
is Column expressions throughout, so it runs in the scan.

``malformed='fail'`` stops on a line that cannot be read, ``'drop'`` leaves it out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.functions import geometry as g

# Field separators per text format; WKT sits in a column of a tab-separated line (fixed values).
SEPARATORS = {"csv": ",", "tsv": "\t", "wkt": "\t"}
FORMATS = ("csv", "tsv", "wkt", "geojson")
_NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
# A position: x and y, and further ordinates that are passed over.
_POSITION = {
    "wkt": rf"({_NUMBER})\s+({_NUMBER})(?:\s+{_NUMBER})*",
    "geojson": rf"\[\s*({_NUMBER})\s*,\s*({_NUMBER})(?:\s*,\s*{_NUMBER})*\s*\]",
}
_POSITIONS = "array<array<double>>"


def _lines(
    spark: SparkSession, path: str, fmt: str, id_column: int | None, partitions: int | None, malformed: str,
) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"input format must be one of {FORMATS}, not {fmt!r}")
    _check_malformed(malformed)
    lines = spark.read.text(path).withColumnRenamed("value", "user_data")
    if id_column is None:
        lines = lines.withColumn("id", F.monotonically_increasing_id())
    elif fmt == "geojson":
        raise ValueError("a GeoJSON line has no columns to take the id from")
    else:
        lines = lines.withColumn("id", _field(fmt, id_column).try_cast("bigint"))
    return lines.repartition(partitions) if partitions else lines


def _field(fmt: str, at: int | Column) -> Column:
    at = F.lit(at) if isinstance(at, int) else at
    return F.get(F.split("user_data", SEPARATORS[fmt]), at)


def _double(fmt: str, at: int) -> Column:
    return F.trim(_field(fmt, at)).try_cast("double")


def _checked(df: DataFrame, columns: list[str], malformed: str) -> DataFrame:
    """Every column in ``columns`` must have been read. The check is a filter: it runs whatever columns are read later."""
    bad = F.lit(False)
    for name in columns:
        bad = bad | F.col(name).isNull()
    if malformed == "drop":
        return df.where(~bad)
    message = F.concat(F.lit("cannot read a geometry from line: "), F.substring("user_data", 1, 200))
    return df.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True))


def _coordinate_text(fmt: str, offset: int) -> Column:
    """The part of the line that holds coordinates, for geometries of any type, collections included."""
    if fmt == "wkt":
        return _field("wkt", offset)
    parts = (F.get_json_object("user_data", f"$.{key}") for key in ("coordinates", "geometries"))
    return F.coalesce(*parts)


def _text_box(fmt: str, offset: int) -> g.Box:
    """Bounds of all positions of a WKT or GeoJSON geometry in x and y."""
    text = _coordinate_text(fmt, offset)
    xs, ys = (F.transform(F.regexp_extract_all(text, F.lit(_POSITION[fmt]), F.lit(i)), lambda n: n.try_cast("double")) for i in (1, 2))
    return g.Box(F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys))


def load_points(
    spark: SparkSession, path: str, fmt: str = "csv", offset: int = 0, id_column: int | None = None,
    partitions: int | None = None, malformed: str = "fail",
) -> DataFrame:
    """(id, x, y, user_data). CSV/TSV: x, y at ``offset``; WKT: lower left corner of the geometry's bounds."""
    lines = _lines(spark, path, fmt, id_column, partitions, malformed)
    if fmt == "geojson":
        json = F.from_json("user_data", "type STRING, coordinates ARRAY<DOUBLE>")
        is_point = json["type"] == "Point"
        x, y = (F.when(is_point, F.get(json["coordinates"], F.lit(i))) for i in (0, 1))
    elif fmt == "wkt":
        b = _text_box(fmt, offset)
        x, y = b.xmin, b.ymin
    else:
        x, y = _double(fmt, offset), _double(fmt, offset + 1)
    return _checked(lines.select("id", x.alias("x"), y.alias("y"), "user_data"), ["x", "y"], malformed)


def load_rectangles(
    spark: SparkSession, path: str, fmt: str = "csv", offset: int = 0, id_column: int | None = None,
    partitions: int | None = None, malformed: str = "fail",
) -> DataFrame:
    """(id, xmin, xmax, ymin, ymax, user_data).

    CSV/TSV: x1, y1, x2, y2 at ``offset``, any two opposite corners; WKT/GeoJSON: bounds of the geometry.
    """
    lines = _lines(spark, path, fmt, id_column, partitions, malformed)
    if fmt in ("csv", "tsv"):
        x1, y1, x2, y2 = (_double(fmt, offset + i) for i in range(4))
        # least and greatest skip nulls; adding the pair keeps a missing corner missing.
        b = g.Box(*(F.when((p + q).isNotNull(), pick(p, q)) for pick, p, q in (
            (F.least, x1, x2), (F.greatest, x1, x2), (F.least, y1, y2), (F.greatest, y1, y2))))
    else:
        b = _text_box(fmt, offset)
    return _checked(lines.select("id", *g.box_columns(b), "user_data"), list(g.BOX), malformed)


def _vertex(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _complete(df: DataFrame) -> DataFrame:
    """Closes the rings; null when a coordinate is missing or a ring has fewer than three vertices."""
    broken = "exists(rings, r_ -> size(r_) < 3 OR exists(r_, v_ -> v_.x IS NULL OR v_.y IS NULL))"
    closed = f"transform(rings, r_ -> {g.closed_ring('r_')})"
    return df.withColumn("rings", F.expr(f"CASE WHEN size(rings) > 0 AND NOT {broken} THEN {closed} END"))


def _paired(numbers: Column) -> Column:
    """x, y, x, y, ... as vertices; an odd number leaves the last y missing."""
    starts = F.sequence(F.lit(0), F.size(numbers) - 1, F.lit(2))
    return F.transform(starts, lambda i: _vertex(F.get(numbers, i), F.get(numbers, i + 1)))


def load_polygons(
    spark: SparkSession, path: str, fmt: str = "csv", offset: int = 0, id_column: int | None = None,
    partitions: int | None = None, malformed: str = "fail",
) -> DataFrame:
    """(id, rings, user_data). CSV/TSV: x, y pairs from ``offset`` to the end of the line, a shell without holes.

    WKT/GeoJSON: one Polygon, holes kept; other geometry types count as malformed.
    """
    lines = _lines(spark, path, fmt, id_column, partitions, malformed)
    if fmt == "geojson":
        json = F.from_json("user_data", "type STRING, coordinates ARRAY<ARRAY<ARRAY<DOUBLE>>>")
        rings = F.when(json["type"] == "Polygon", F.transform(json["coordinates"], lambda ring: F.transform(
            ring, lambda p: _vertex(F.get(p, F.lit(0)), F.get(p, F.lit(1))))))
    elif fmt == "wkt":
        body = F.regexp_extract(_field(fmt, offset), r"(?i)^\s*POLYGON\s*\(\s*\((.*)\)\s*\)\s*$", 1)
        rings = F.when(body != "", F.transform(F.split(body, r"\)\s*,\s*\("), lambda ring: F.transform(
            F.split(F.trim(ring), r"\s*,\s*"), _wkt_vertex)))
    else:
        fields = F.split("user_data", SEPARATORS[fmt])
        numbers = F.transform(F.slice(fields, F.lit(offset + 1), F.greatest(F.size(fields) - offset, F.lit(0))),
                              lambda n: F.trim(n).try_cast("double"))
        rings = F.when(F.size(numbers) > 1, F.array(_paired(numbers)))
    return _checked(_complete(lines.select("id", rings.alias("rings"), "user_data")), ["rings"], malformed)


def _wkt_vertex(text: Column) -> Column:
    parts = F.split(F.trim(text), r"\s+")
    return _vertex(F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double"))


def _step_lines(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    raw = spark.read.text(path).withColumnRenamed("value", "user_data")
    numbers = [_double("csv", i + 1).alias(n) for i, n in enumerate(names)]
    return raw.select("user_data", F.trim(_field("csv", 0)).try_cast("int").alias("t"), *numbers)


def _check_malformed(malformed: str) -> None:
    if malformed not in ("fail", "drop"):
        raise ValueError(f"malformed must be 'fail' or 'drop', not {malformed!r}")


def load_step_points(spark: SparkSession, path: str, malformed: str = "fail") -> DataFrame:
    """(t, x, y) from CSV lines ``t,x,y``."""
    _check_malformed(malformed)
    return _checked(_step_lines(spark, path, ["x", "y"]), ["t", "x", "y"], malformed).drop("user_data")


def load_step_rectangles(spark: SparkSession, path: str, malformed: str = "fail") -> DataFrame:
    """(t, xmin, xmax, ymin, ymax) from CSV lines ``t,x1,y1,x2,y2``, corners in any order."""
    _check_malformed(malformed)
    corners = ["x1", "y1", "x2", "y2"]
    raw = _checked(_step_lines(spark, path, corners), ["t", *corners], malformed)
    return raw.select(
        "t", F.least("x1", "x2").alias("xmin"), F.greatest("x1", "x2").alias("xmax"),
        F.least("y1", "y2").alias("ymin"), F.greatest("y1", "y2").alias("ymax"),
    )


def load_trips(
    spark: SparkSession, path: str, time: int = 1, lon: int = 5, lat: int = 6, header: bool = False, malformed: str = "fail",
) -> DataFrame:
    """(pickup, lon, lat) from CSV trip records; the numbers are column positions.

    With ``header``, lines equal to the first line of the first file are left out: each file may begin with it.
    """
    _check_malformed(malformed)
    raw = spark.read.text(path).withColumnRenamed("value", "user_data")
    if header:
        first = raw.first()
        raw = raw.where(F.col("user_data") != (first["user_data"] if first else ""))
    parsed = raw.select(
        "user_data", _field("csv", time).try_cast("timestamp").alias("pickup"),
        _double("csv", lon).alias("lon"), _double("csv", lat).alias("lat"),
    )
    return _checked(parsed, ["pickup", "lon", "lat"], malformed).drop("user_data")
