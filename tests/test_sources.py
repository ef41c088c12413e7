import json

import pytest
from shapes import Jts, boxes, points, polygons, square

from meshfold.sources import readers, writers


@pytest.fixture
def text(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def _rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_points_csv_and_tsv(spark, text):
    csv = text("p.csv", "a,1.5,-2,x", "b,1e2, 3 ,y")
    assert _rows(readers.load_points(spark, csv, "csv", 1), "x", "y", "user_data") == [(1.5, -2, "a,1.5,-2,x"), (100, 3, "b,1e2, 3 ,y")]
    tsv = text("p.tsv", "7\t1\t2", "8\t3\t4")
    found = readers.load_points(spark, tsv, "tsv", offset=1, id_column=0, partitions=3)
    assert _rows(found, "id", "x", "y") == [(7, 1, 2), (8, 3, 4)] and found.rdd.getNumPartitions() == 3
    assert len({r["id"] for r in readers.load_points(spark, tsv, "tsv", 1).collect()}) == 2


def test_points_wkt_and_geojson(spark, text):
    wkt = text("p.wkt", "POINT (1.5 -2)\ta", "LINESTRING (5 1, 3 7)\tb", "POLYGON ((0 9, 4 9, 4 8, 0 9))\tc")
    assert _rows(readers.load_points(spark, wkt, "wkt"), "x", "y") == [(0, 8), (1.5, -2), (3, 1)]
    geojson = text("p.json", '{"type":"Point","coordinates":[1.5,-2]}', '{"coordinates": [3, 4], "type": "Point"}')
    assert _rows(readers.load_points(spark, geojson, "geojson"), "x", "y") == [(1.5, -2), (3, 4)]


def test_rectangles(spark, text):
    csv = text("r.csv", "z,4,5,1,2", "z,-1,-2,-3,-4")
    assert _rows(readers.load_rectangles(spark, csv, "csv", 1), "xmin", "xmax", "ymin", "ymax") == [(-3, -1, -4, -2), (1, 4, 2, 5)]
    wkt = text("r.wkt", "id\tMULTIPOLYGON (((0 0, 2 0, 2 3, 0 0)), ((5 5, 6 5, 6 9, 5 5)))", "id\tPOINT (1 2)")
    assert _rows(readers.load_rectangles(spark, wkt, "wkt", 1), "xmin", "xmax", "ymin", "ymax") == [(0, 6, 0, 9), (1, 1, 2, 2)]
    geojson = text("r.json", '{"type":"Polygon","coordinates":[[[0,0],[1e1,0],[10,5.5],[0,0]]]}')
    assert _rows(readers.load_rectangles(spark, geojson, "geojson"), "xmin", "xmax", "ymin", "ymax") == [(0, 10, 0, 5.5)]


def _rings(df):
    return [[[(p["x"], p["y"]) for p in ring] for ring in r["rings"]] for r in df.orderBy("id").collect()]


def test_polygons(spark, text):
    shell, hole = [(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]
    csv = text("s.csv", "5,0,0,9,0,9,9,0,9,0,0", "6,0,0,9,0,9,9,0,9")  # the second ring is open
    assert _rings(readers.load_polygons(spark, csv, "csv", 1, id_column=0)) == [[shell], [shell]]
    wkt = text("s.wkt", "1\tPOLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 2 1, 2 2, 1 1))", "2\tpolygon((0 0,9 0,9 9,0 9,0 0))")
    assert _rings(readers.load_polygons(spark, wkt, "wkt", 1, id_column=0)) == [[shell, hole], [shell]]
    geojson = text("s.json", json.dumps({"type": "Polygon", "coordinates": [shell, hole]}))
    assert _rings(readers.load_polygons(spark, geojson, "geojson")) == [[shell, hole]]


@pytest.mark.parametrize("load, fmt, good, bad", [
    (readers.load_points, "csv", "1,2", "1,north"), (readers.load_points, "csv", "1,2", "1"),
    (readers.load_points, "geojson", '{"type":"Point","coordinates":[1,2]}', '{"type":"LineString","coordinates":[[1,2],[3,4]]}'),
    (readers.load_points, "wkt", "POINT (1 2)", "POINT EMPTY"),
    (readers.load_rectangles, "csv", "1,2,3,4", "1,2,3"),
    (readers.load_polygons, "csv", "0,0,1,0,1,1", "0,0,1,0,1"), (readers.load_polygons, "csv", "0,0,1,0,1,1", "0,0,1,0"),
    (readers.load_polygons, "wkt", "POLYGON ((0 0, 1 0, 1 1, 0 0))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))"),
    (readers.load_polygons, "geojson", '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}',
     '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]]]}'),
])
def test_malformed_lines(spark, text, load, fmt, good, bad):
    path = text("lines", good, bad)
    assert load(spark, path, fmt, malformed="drop").count() == 1
    with pytest.raises(Exception, match="cannot read a geometry"):
        load(spark, path, fmt).collect()


def test_unknown_format(spark, text):
    for load in (readers.load_points, readers.load_rectangles, readers.load_polygons):
        with pytest.raises(ValueError):
            load(spark, "nowhere", "shapefile")
    with pytest.raises(ValueError):
        readers.load_points(spark, "nowhere", "csv", malformed="guess")


def test_steps_and_trips(spark, text):
    assert _rows(readers.load_step_points(spark, text("t.csv", "3,1,2", "4,5.5,6")), "t", "x", "y") == [(3, 1, 2), (4, 5.5, 6)]
    rects = readers.load_step_rectangles(spark, text("tr.csv", "3,9,2,1,8"))
    assert _rows(rects, "t", "xmin", "xmax", "ymin", "ymax") == [(3, 1, 9, 2, 8)]
    trips = text("trips.csv", "id,pickup,a,b,c,lon,lat", "1,2015-01-13 08:00:00,x,1,2,-73.99,40.7")
    rows = readers.load_trips(spark, trips, header=True).collect()
    assert [(r["pickup"].day, r["lon"], r["lat"]) for r in rows] == [(13, -73.99, 40.7)]


def test_written_text(spark, tmp_path):
    pts = points(spark, [(1.5, -2), (1e-7, 12345678.25)])
    assert [json.loads(r["json"]) for r in writers.as_geojson(pts).collect()] == [
        {"type": "Point", "coordinates": [1.5, -2.0]}, {"type": "Point", "coordinates": [1e-7, 12345678.25]}]
    writers.save_geojson(pts, str(tmp_path / "out"))
    assert _rows(readers.load_points(spark, str(tmp_path / "out"), "geojson"), "x", "y") == [(1e-7, 12345678.25), (1.5, -2)]
    jts = Jts(spark)
    shapes = {0: square(0, 0, 2), 1: [*square(0, 0, 9), *square(1, 1, 2)]}
    table = polygons(spark, shapes)
    texts = {r["id"]: r["wkt"] for r in table.select("id", writers.wkt(table).alias("wkt")).collect()}
    assert all(jts.reader.read(texts[i]).equals(jts.polygon(s)) for i, s in shapes.items())
    rects = boxes(spark, [(0, 2, 1, 4)])
    outline = rects.select(writers.wkt(rects).alias("wkt")).first()["wkt"]
    assert jts.reader.read(outline).equals(jts.box((0, 2, 1, 4)))
    assert json.loads(writers.as_geojson(rects).first()["json"])["type"] == "Polygon"
    writers.save_lines(rects, str(tmp_path / "lines"), "\t")
    assert spark.read.text(str(tmp_path / "lines")).first()["value"] == "0\t0.0\t2.0\t1.0\t4.0"


@pytest.mark.parametrize("load, fmt, good, bad", [
    (readers.load_points, "csv", "1,2", "1,north"), (readers.load_rectangles, "tsv", "1\t2\t3\t4", "1\t2\t3"),
    (readers.load_polygons, "csv", "0,0,1,0,1,1", "0,0,1,0"),
    (readers.load_step_points, None, "1,2,3", "x,2,3"), (readers.load_step_rectangles, None, "1,2,3,4,5", "1,2,3,,5"),
    (readers.load_trips, None, "1,2015-01-13 08:00:00,x,1,2,-73.99,40.7", "header"),
])
def test_a_bad_line_stops_every_read(spark, text, load, fmt, good, bad):
    path = text("lines", good, bad)
    args = (spark, path) if fmt is None else (spark, path, fmt)
    found = load(*args)
    for read in (found.count, found.select(found.columns[-1]).collect, found.select(found.columns[0]).collect):
        with pytest.raises(Exception, match="cannot read a geometry"):
            read()
    assert load(*args, malformed="drop").count() == 1


def test_heights_and_collections(spark, text):
    lines = text("z.wkt", "POINT Z (1 2 99)", "POLYGON Z ((0 0 7, 4. 0 7, 4 .5 700, 0 0 7))", "GEOMETRYCOLLECTION (POINT (9 8), LINESTRING (1 -1, 2 2))")
    expected = [(0, 4, 0, 0.5), (1, 1, 2, 2), (1, 9, -1, 8)]
    assert _rows(readers.load_rectangles(spark, lines, "wkt"), "xmin", "xmax", "ymin", "ymax") == expected
    assert _rows(readers.load_points(spark, lines, "wkt"), "x", "y") == [(0, 0), (1, -1), (1, 2)]
    json_lines = text("z.json", '{"type":"Point","coordinates":[1,2,99]}', '{"type":"LineString","coordinates":[[0,0.5,9],[4,0,9]]}',
                      '{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[9,8]},{"type":"Point","coordinates":[1,-1,5]}]}')
    assert _rows(readers.load_rectangles(spark, json_lines, "geojson"), "xmin", "xmax", "ymin", "ymax") == expected
