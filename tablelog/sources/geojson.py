"""GeoJSON features as rows: the geometry as WKT plus one column per property.

What cannot be read is kept in the corrupt column, as Spark's own readers do, and is for
``reject_corrupt`` to refuse: text that is no JSON or no GeoJSON, a feature without the type, and
a geometry that is unknown, broken or incomplete, such as an open ring.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelog.functions.columns import folded, ref
from tablelog.functions.wkt import wkt
from tablelog.vocab import DEFAULT_VOCABULARY

_FEATURE = "type string, geometry string, properties string"
# A file holds a collection of features, a single feature, or one of either per line.
_DOCUMENT = f"{_FEATURE}, features array<struct<type: string, geometry: string, properties: string>>"
_CORRUPT = "__corrupt"
#: Property names that become columns without being asked for. A table of more is hardly meant.
MOST_PROPERTIES = 10_000


def read_geojson(
    spark: SparkSession,
    path: str,
    lines: bool = False,
    properties: Sequence[str] | None = None,
    corrupt_column: str = DEFAULT_VOCABULARY.corrupt_record,
    split: bool = False,
) -> DataFrame:
    """Read GeoJSON files; with ``lines`` every line is a document and files are split.

    With ``split`` collections that span lines are split as well, between features, so that a large
    one is read by many tasks. That takes one more scan, and files whose features do not begin
    alike, or that do not come apart cleanly, are read as wholes. Naming the ``properties`` saves
    the scan that finds them.
    """
    spark.catalog.refreshByPath(path)
    if split and not lines:
        return feature_rows(_split_documents(spark, path), properties, corrupt_column)
    reader = spark.read.schema(f"{_DOCUMENT}, {_CORRUPT} string").option("columnNameOfCorruptRecord", _CORRUPT)
    return feature_rows(reader.option("multiLine", not lines).json(path), properties, corrupt_column)


# How a feature begins that can be told in the middle of a file. A quotation mark inside a string has a
# backslash before it, so that these signs never stand in one.
_BEGIN = re.compile(rb'\{\s*"type"\s*:\s*"Feature"(?=\s*[,}])')
_HEAD = r'(?s)^\s*\{.*"features"\s*:\s*\[\s*$'
_TAIL = r"\s*\]\s*\}\s*$"
#: Bytes of each file that are searched for its first feature.
_SEARCHED = 1 << 16


def _beginnings(spark: SparkSession, path: str) -> dict[str | None, list[str]]:
    """The files at ``path`` by the text with which their features begin, None if it is not found."""
    hadoop, out = spark._jvm.org.apache.hadoop.fs, {}
    conf = spark._jsc.hadoopConfiguration()
    where = hadoop.Path(path)
    files = where.getFileSystem(conf)
    for top in files.globStatus(where) or []:
        for f in files.listStatus(top.getPath()) if top.isDirectory() else [top]:
            if f.isDirectory() or f.getPath().getName()[:1] in "._":
                continue
            with_head = files.open(f.getPath())
            try:
                head = bytes(with_head.readNBytes(_SEARCHED))
            finally:
                with_head.close()
            found = _BEGIN.search(head)
            out.setdefault(found.group().decode() if found else None, []).append(f.getPath().toString())
    return out


def _split_documents(spark: SparkSession, path: str) -> DataFrame:
    """Features as documents of their own, from files that are cut where one begins."""
    fields = f"{_DOCUMENT}, {_CORRUPT} string"
    whole: list[str] = []
    parts: list[DataFrame] = []
    for begin, files in _beginnings(spark, path).items():
        if begin is None:
            whole += files
            continue
        pieces = spark.read.option("lineSep", begin).text(files).select(F.col("_metadata.file_path").alias("file"), "value")
        parsed = pieces.select("file", *_parsed_piece(F.col("value"), begin, fields))
        # A file is cut well if it has one head, one end, and features between.
        sums = parsed.groupBy("file").agg(
            F.count_if("head").alias("heads"), F.count_if("tail").alias("tails"), F.count_if(~F.col("head") & ~F.col("sound")).alias("bad")
        )
        spoilt = [r["file"] for r in sums.filter("heads <> 1 or tails <> 1 or bad > 0").collect()]  # names of odd files
        whole += spoilt
        if len(spoilt) < len(files):
            parts.append(parsed.filter(~F.col("file").isin(spoilt) & ~F.col("head")).select("d.*"))
    if whole or not parts:
        reader = spark.read.schema(fields).option("columnNameOfCorruptRecord", _CORRUPT).option("multiLine", True)
        parts.append(reader.json(whole or path))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _parsed_piece(value: Column, begin: str, fields: str) -> list[Column]:
    """What a piece between two beginnings is: the head of a collection, or a feature without its beginning."""
    head = value.rlike(_HEAD)
    tail = ~head & value.rlike(_TAIL)
    text = F.when(tail, F.regexp_replace(value, _TAIL, "")).otherwise(F.regexp_replace(value, r",\s*$", ""))
    document = F.from_json(F.concat(F.lit(begin), text), fields, {"columnNameOfCorruptRecord": _CORRUPT})
    opened = F.from_json(F.concat(value, F.lit("]}")), "type string")["type"] == "FeatureCollection"
    sound = (document["type"] == "Feature") & document[_CORRUPT].isNull() & (tail | value.rlike(r"\}\s*,\s*$"))
    return [
        (head & F.coalesce(opened, F.lit(False))).alias("head"),
        F.coalesce(tail, F.lit(False)).alias("tail"),
        F.coalesce(sound, F.lit(False)).alias("sound"),
        document.alias("d"),
    ]


def parse_geojson(
    documents: DataFrame,
    column: str,
    properties: Sequence[str] | None = None,
    corrupt_column: str = DEFAULT_VOCABULARY.corrupt_record,
) -> DataFrame:
    """The same for documents already in a text column; a NULL document is corrupt."""
    parsed = F.from_json(ref(column), f"{_DOCUMENT}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = documents.select(parsed.alias("d"), ref(column).alias("text"))
    # A document that is JSON but no object parses to NULLs without a complaint.
    return feature_rows(
        parsed.select("d.type", "d.geometry", "d.properties", "d.features", F.coalesce(f"d.{_CORRUPT}", F.when(F.col("d.type").isNull(), F.coalesce("text", F.lit("NULL")))).alias(_CORRUPT)),
        properties,
        corrupt_column,
    )


def feature_rows(
    documents: DataFrame,
    properties: Sequence[str] | None = None,
    corrupt_column: str = DEFAULT_VOCABULARY.corrupt_record,
) -> DataFrame:
    """``geometry``, the properties, and the text of what is corrupt, NULL for sound features."""
    own = F.array(F.struct("type", "geometry", "properties"))
    collection = F.col("type") == "FeatureCollection"
    whole = F.coalesce(_CORRUPT, F.to_json(F.struct("type", "geometry", "properties", "features")))
    # A document is one bad record if it did not parse or is neither kind; so is a collection without a list.
    broken = F.col(_CORRUPT).isNotNull() | F.coalesce(collection & F.col("features").isNull(), F.lit(False))
    # Both before the features come apart: a row of its own for each must not carry the whole document.
    made = documents.select(
        F.when(broken, own).when(collection, F.col("features")).otherwise(own).alias("all"),
        F.when(broken, whole).alias("bad"),
    )
    features = made.select(F.explode("all").alias("f"), "bad")
    rows = features.select(
        wkt(F.col("f.geometry")).alias("geometry"),
        F.from_json("f.properties", "map<string,string>").alias("properties"),
        F.col("f.geometry").alias("source"),
        F.col("f").alias("f"),
        "bad",
    )
    kind = F.coalesce(F.col("f.type") == "Feature", F.lit(False))
    shape = F.col("source").isNull() | F.col("geometry").isNotNull()
    named = F.col("f.properties").isNull() | F.col("properties").isNotNull()
    rows = rows.withColumn("bad", F.coalesce("bad", F.when(~(kind & shape & named), F.coalesce(F.to_json("f"), F.lit("NULL")))))
    if properties is None:
        # Distinct property names: as many as the table has columns.
        found = rows.select(F.explode(F.map_keys("properties")).alias("name")).distinct().limit(MOST_PROPERTIES + 1)
        properties = sorted(r["name"] for r in found.collect())
        if len(properties) > MOST_PROPERTIES:
            where = ", ".join(documents.inputFiles()[:3]) or "the documents"
            raise ValueError(f"Over {MOST_PROPERTIES} property names in {where}: name the ones to read")
    fold = folded(documents.sparkSession)
    clash = [p for p in properties if fold(p) in (fold("geometry"), fold(corrupt_column))]
    if clash:
        raise ValueError(f"Properties are called like columns of their own: {', '.join(clash)}")
    return rows.select(
        "geometry", *[F.col("properties")[p].alias(p) for p in properties], F.col("bad").alias(corrupt_column)
    )
