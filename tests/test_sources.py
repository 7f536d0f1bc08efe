"""Raw readers, the corrupt gate, names, archives and GeoJSON."""

import bz2
import io
import json
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from tablelog.sources import geojson
from pyspark.errors import PySparkException

from tablelog import (
    CorruptRecords,
    archive_members,
    corrupt_records,
    normalise_columns,
    parse_geojson,
    read_geojson,
    read_raw,
    reject_corrupt,
    to_back,
    to_front,
)
from tests.conftest import ordered, rows


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("schema", ["id INT, n STRING", ["id INT", "n STRING"]])
def test_csv_with_schema(spark, tmp_path, schema):
    path = write(tmp_path / "a.csv", "1,x\n3,z\n")
    df = reject_corrupt(read_raw(spark, path, "csv", schema=schema))
    assert df.columns == ["id", "n"]
    assert rows(df) == [(1, "x"), (3, "z")]


def test_bad_csv_field(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1,x\nbad,y\n3,z\n")
    df = read_raw(spark, path, "csv", schema=["id INT", "n STRING"])
    assert [r["_corrupt_record"] for r in corrupt_records(df).collect()] == ["bad,y"]
    assert corrupt_records(df).count() == corrupt_records(df).select("n").count() == 1
    with pytest.raises(CorruptRecords, match="bad,y"):
        reject_corrupt(df)
    with pytest.raises(PySparkException, match="Corrupt records detected"):
        reject_corrupt(df, eager=False).collect()
    # The check is part of the plan: pruning columns does not prune it.
    with pytest.raises(PySparkException, match="Corrupt records detected"):
        reject_corrupt(df, eager=False).select("n").collect()
    # Nor does a filter on good columns keep it from being seen.
    with pytest.raises(PySparkException, match="Corrupt records detected"):
        reject_corrupt(df, eager=False).filter("n = 'x'").collect()
    # Without the added column the bad field is silently NULL.
    loose = read_raw(spark, path, "csv", schema=["id INT", "n STRING"], strict=False)
    assert rows(reject_corrupt(loose)) == ordered([(1, "x"), (None, "y"), (3, "z")])


def test_declared_corrupt_column(spark, tmp_path):
    path = write(tmp_path / "a.csv", "bad,y\n")
    df = read_raw(spark, path, "csv", schema="id INT, n STRING, oops STRING", corrupt_column="oops")
    with pytest.raises(CorruptRecords):
        reject_corrupt(df, "oops")


def test_bad_json_line(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"a":1}\n{"a":\n')
    df = read_raw(spark, path, "json")
    assert "_corrupt_record" in df.columns
    with pytest.raises(CorruptRecords):
        reject_corrupt(df)
    clean = read_raw(spark, write(tmp_path / "b.json", '{"a":1}\n'), "json")
    assert reject_corrupt(clean) is clean


def test_preview_is_bounded(spark, tmp_path):
    path = write(tmp_path / "a.csv", "".join(f"bad{i:03d},y\n" for i in range(100)))
    with pytest.raises(CorruptRecords) as e:
        reject_corrupt(read_raw(spark, path, "csv", schema="id INT, n STRING"))
    assert str(e.value).count("bad") == 20


def test_options_and_parquet(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id;n\n1;x\n")
    df = read_raw(spark, path, "csv", {"header": "true", "sep": ";", "inferSchema": "true"})
    assert rows(df) == [(1, "x")]
    df.write.parquet(str(tmp_path / "p"))
    assert rows(read_raw(spark, str(tmp_path / "p"), "parquet")) == [(1, "x")]


def test_changed_file_is_read_again(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1,x\n")
    read_raw(spark, path, "csv", schema="id INT, n STRING").collect()
    write(tmp_path / "a.csv", "2,y\n3,z\n")
    assert read_raw(spark, path, "csv", schema="id INT, n STRING").count() == 2


def test_normalise(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["a b", "x(y)=z", "p\tq", "d{e};f,\r\ng"])
    assert normalise_columns(df).columns == ["a_b", "x_y__z", "pq", "d_e__f_g"]
    with pytest.raises(ValueError, match="'a b' and 'a,b'"):
        normalise_columns(spark.createDataFrame([(1, 2)], ["a b", "a,b"]))
    with pytest.raises(ValueError):
        normalise_columns(spark.createDataFrame([(1, 2)], ["a b", "A,b"]))


def test_column_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b.c", "d"])
    assert to_front(df, "d").columns == ["d", "a", "b.c"]
    assert to_back(df, "a").columns == ["b.c", "d", "a"]


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("dir/", b"")
        for name, text in members.items():
            z.writestr(name.replace("_", "/").replace("0", "."), text)
    return out.getvalue()


@pytest.mark.parametrize("wrapped", [False, True])
def test_archives(spark, tmp_path, wrapped):
    pack = bz2.compress if wrapped else bytes
    (tmp_path / "one.zip").write_bytes(pack(zipped(dir_a0shp="A", b0dbf="B")))
    (tmp_path / "two.zip").write_bytes(pack(zipped(a0shp="C", empty0shp="")))
    out = archive_members(spark, str(tmp_path), bz2=wrapped)
    got = ordered([(r.path.rsplit("/", 1)[1], r.member, bytes(r.content)) for r in out.collect()])
    assert got == ordered(
        [
            ("one.zip", "dir/a.shp", b"A"),
            ("one.zip", "b.dbf", b"B"),
            ("two.zip", "a.shp", b"C"),
            ("two.zip", "empty.shp", b""),
        ]
    )
    # The pattern has to match the whole name.
    some = archive_members(spark, str(tmp_path), r"[a-z]+\.shp", bz2=wrapped)
    assert {r.member for r in some.collect()} == {"a.shp", "empty.shp"}


GEOMETRIES = [
    ({"type": "Point", "coordinates": [30, 10.50]}, "POINT (30 10.5)"),
    ({"type": "Point", "coordinates": [30, 10, 5]}, "POINT (30 10 5)"),
    ({"type": "LineString", "coordinates": [[30, 10], [10, 30]]}, "LINESTRING (30 10, 10 30)"),
    (
        {"type": "Polygon", "coordinates": [[[0, 0], [9, 0], [0, 9], [0, 0]], [[1, 1], [2, 1], [1, 2], [1, 1]]]},
        "POLYGON ((0 0, 9 0, 0 9, 0 0), (1 1, 2 1, 1 2, 1 1))",
    ),
    ({"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}, "MULTIPOINT ((1 2), (3 4))"),
    (
        {"type": "MultiLineString", "coordinates": [[[1, 2], [3, 4]], [[5, 6], [7, 8]]]},
        "MULTILINESTRING ((1 2, 3 4), (5 6, 7 8))",
    ),
    (
        {"type": "MultiPolygon", "coordinates": [[[[0, 0], [9, 0], [0, 9], [0, 0]]], [[[5, 5], [6, 5], [5, 6], [5, 5]]]]},
        "MULTIPOLYGON (((0 0, 9 0, 0 9, 0 0)), ((5 5, 6 5, 5 6, 5 5)))",
    ),
    (
        {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}]},
        "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (1 2, 3 4))",
    ),
    ({"type": "Polygon", "coordinates": []}, "POLYGON EMPTY"),
    ({"type": "Polygon", "coordinates": [[[0, -1.25, 3], [9, 0, 1], [0, 9, 1], [0.0, -1.25, 4]]]}, "POLYGON ((0 -1.25 3, 9 0 1, 0 9 1, 0.0 -1.25 4))"),
    ({"type": "GeometryCollection", "geometries": []}, "GEOMETRYCOLLECTION EMPTY"),
    (None, None),
]


def features():
    return [
        {"type": "Feature", "properties": {"n": i, "name": f"f{i}"} if i else None, "geometry": g}
        for i, (g, _) in enumerate(GEOMETRIES)
    ]


def expected_features():
    return ordered(
        [(w, str(i) if i else None, f"f{i}" if i else None) for i, (_, w) in enumerate(GEOMETRIES)]
    )


def test_geojson_collection(spark, tmp_path):
    text = json.dumps({"type": "FeatureCollection", "features": features()}, indent=1)
    df = read_geojson(spark, write(tmp_path / "a.geojson", text))
    assert df.columns == ["geometry", "n", "name", "_corrupt_record"]
    assert rows(reject_corrupt(df)) == expected_features()


def test_features_do_not_carry_their_collection(spark, tmp_path):
    point = {"type": "Feature", "properties": {"n": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}
    path = write(tmp_path / "a.geojson", json.dumps({"type": "FeatureCollection", "features": [point] * 9}))
    df = read_geojson(spark, path, properties=["n"])
    assert rows(df) == [("POINT (1 2)", "1", None)] * 9
    # What each row takes along from its document; with the list the work grows with its square.
    carried = re.findall(r"Generate explode\(.*\), \[([^\[\]]*)\], (?:true|false), \[", df._jdf.queryExecution().sparkPlan().toString())
    assert len(carried) == 1
    assert "features" not in carried[0] and "geometry" not in carried[0]


def test_geojson_lines(spark, tmp_path):
    text = "\n".join(json.dumps(f) for f in features())
    path = write(tmp_path / "a.geojson", text)
    assert rows(reject_corrupt(read_geojson(spark, path, lines=True))) == expected_features()
    named = read_geojson(spark, path, lines=True, properties=["name"])
    assert named.columns == ["geometry", "name", "_corrupt_record"]


def test_geojson_column(spark):
    df = spark.createDataFrame([(json.dumps(f),) for f in features()], "doc string")
    assert rows(reject_corrupt(parse_geojson(df, "doc"))) == expected_features()


TRICKY = [
    {"type": "Feature", "properties": {"n": 1, "s": '{"type": "Feature", "x": [}]} \\\\'}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
    {"type": "Feature", "properties": {"n": 2, "s": "}, ]}"}, "geometry": None},
    {"type": "Feature", "properties": None, "geometry": {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [3, 4]}]}},
]


@pytest.mark.parametrize("indent", [None, 1])
def test_split_collections(spark, tmp_path, indent):
    """Split and whole reads agree; large files are read by several tasks, odd ones as wholes."""
    base = tmp_path / "c"
    base.mkdir()
    many = [TRICKY[i % 3] | {"id": i} for i in range(3000)]
    write(base / "large.geojson", json.dumps({"type": "FeatureCollection", "features": many}, indent=indent))
    write(base / "small.geojson", json.dumps({"type": "FeatureCollection", "features": TRICKY}) + "\n")
    nested = TRICKY[0] | {"properties": {"n": 9, "s": "x", "inner": TRICKY[1]}}
    write(base / "nested.geojson", json.dumps({"type": "FeatureCollection", "features": [nested, TRICKY[1]]}))
    write(base / "other.geojson", json.dumps({"features": [{"geometry": None, "type": "Feature", "properties": {"n": 5}}], "type": "FeatureCollection"}))
    write(base / "more.geojson", json.dumps({"type": "FeatureCollection", "features": TRICKY, "name": "m"}))
    write(base / "one.geojson", json.dumps(TRICKY[0]))
    write(base / "none.geojson", json.dumps({"type": "FeatureCollection", "features": []}))
    write(base / "cut.geojson", json.dumps({"type": "FeatureCollection", "features": TRICKY})[:-1])
    options = dict(properties=["n", "s"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        split, plain = read_geojson(spark, str(base), split=True, **options), read_geojson(spark, str(base), **options)
        assert rows(split) == rows(plain)
        assert split.filter("_corrupt_record is not null").count() == 1
        tasks = read_geojson(spark, str(base / "large.geojson"), split=True, **options)
        assert tasks.select(F.spark_partition_id().alias("p")).distinct().count() > 3
        assert rows(reject_corrupt(tasks), "n") == rows(spark.createDataFrame([(str(f["properties"]["n"]) if f["properties"] else None,) for f in many], "n string"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


BROKEN = [
    '{"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}',
    '{"type": "Fixture", "geometry": null, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "Circle", "coordinates": [1, 2]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, null]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "Point", "coordinates": [1]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[1, 2], null]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "Point", "coordinates": ["a", 2]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "GeometryCollection", "geometries": [{"type": "Blob"}]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "Point", "coordinates": ["1", "2"]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "Point", "coordinates": [[1, 2]]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[1, 2]]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "LineString", "coordinates": [1, 2]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 1]]]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [9, 0], [0, 9], [1, 1]]]}, "properties": {}}',
    '{"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [9, 0], [0, 0]]]]}, "properties": {}}',
    '{"type": "FeatureCollection", "features": null}',
    "[1, 2]",
    "nonsense",
]


@pytest.mark.parametrize("text", BROKEN)
def test_broken_geojson_is_refused(spark, tmp_path, text):
    sound = json.dumps(features()[0])
    path = write(tmp_path / "lines.json", f"{sound}\n{text}\n{sound}\n")
    read = read_geojson(spark, path, lines=True, properties=["n"])
    assert corrupt_records(read).count() == 1 and read.count() == 3
    with pytest.raises(CorruptRecords):
        reject_corrupt(read)
    column = spark.createDataFrame([(sound,), (text,), (None,)], "doc string")
    assert corrupt_records(parse_geojson(column, "doc", ["n"])).count() == 2
    whole = write(tmp_path / "whole.json", text)
    assert corrupt_records(read_geojson(spark, whole, properties=["n"])).count() >= 1


def test_geojson_of_too_many_properties(spark, monkeypatch):
    monkeypatch.setattr(geojson, "MOST_PROPERTIES", 3)
    df = spark.createDataFrame([('{"type": "Feature", "geometry": null, "properties": {"a": 1, "b": 2, "c": 3, "d": 4}}',)], "doc string")
    with pytest.raises(ValueError, match="Over 3 property names"):
        parse_geojson(df, "doc")
    assert parse_geojson(df, "doc", properties=["d"]).first()["d"] == "4"


def test_wkt_names_each_part_once(spark):
    plan = parse_geojson(spark.createDataFrame([("{}",)], "doc string"), "doc", ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("forall(") < 60 and plan.count("regexp_replace(") < 30


def test_geojson_properties_with_names_of_other_columns(spark):
    df = spark.createDataFrame([('{"type": "Feature", "geometry": null, "properties": {"Geometry": 1}}',)], "doc string")
    with pytest.raises(ValueError, match="Geometry"):
        parse_geojson(df, "doc")
