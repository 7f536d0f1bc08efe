"""Well-known text from GeoJSON geometries, as Spark expressions.

The text of the coordinates becomes the WKT by replacing brackets and commas, so numbers stay as
Spark's JSON reader gives them, to the last digit. Whether it is sound is tested once on the parsed numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a geometry's coordinates are made of, outermost first.
PARTS = {
    "Point": (),
    "MultiPoint": ("positions",),
    "LineString": ("line",),
    "Polygon": ("rings", "ring"),
    "MultiLineString": ("lines", "line"),
    "MultiPolygon": ("polygons", "rings", "ring"),
}
# Positions that a part has at least.
_LEAST = {"line": 2, "ring": 4}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _sound(value: Column, parts: tuple[str, ...]) -> Column:
    """Whether all is there: two numbers to a position, two positions to a line, closed rings of four."""
    if not parts:
        return (F.size(value) >= 2) & F.forall(value, lambda x: x.isNotNull())
    inner = F.forall(value, lambda x: _sound(x, parts[1:]))
    every = (F.size(value) >= _LEAST.get(parts[0], 1)) & inner
    if parts[0] == "ring":
        first, last = value[0], F.element_at(value, -1)
        every = every & (first[0] == last[0]) & (first[1] == last[1])
    return F.coalesce(every, F.lit(False))


def _empty_or_sound(parts: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda value: (F.size(value) == 0) | _sound(value, parts)


def _simple(geometry: Column) -> Column:
    """WKT of one geometry that is not a collection; NULL for anything else."""
    return _let(F.from_json(geometry, "type string, coordinates string"), lambda head: _of_type(head["type"], head["coordinates"]))


def _of_type(name: Column, written: Column) -> Column:
    sound = F.lit(False)
    for kind, parts in PARTS.items():
        depth = len(parts) + 1
        numbers = F.from_json(written, "array<" * depth + "double" + ">" * depth)
        sound = F.when(name == kind, _let(numbers, _empty_or_sound(parts))).otherwise(sound)
    # Nothing but numbers: what is in quotation marks, or a word, is none.
    plain = ~written.rlike(r"[^\[\]\d.,eE+\-\s]")
    together = F.regexp_replace(F.regexp_replace(written, r"\s+", ""), r"(?<=\d),(?=[-\d])", " ")
    bare = F.when(name.isin("Point", "MultiPoint"), together).otherwise(F.regexp_replace(together, r"\[([^\[\],]+)\]", "$1"))
    text = F.translate(F.replace(bare, F.lit(","), F.lit(", ")), "[]", "()")
    whole = F.when(text == "()", F.concat(F.upper(name), F.lit(" EMPTY"))).otherwise(F.concat(F.upper(name), F.lit(" "), text))
    return _let(whole, lambda w: F.when(F.coalesce(sound & plain, F.lit(False)), w))


def wkt(geometry: Column) -> Column:
    """WKT of a GeoJSON geometry given as JSON text; collections may hold any simple type.

    NULL for an unknown type, a position of fewer than two numbers, a number in quotation marks, a line of
    one position, a ring that is open or has fewer than four, and anything missing inside.
    """

    def collected(members: Column) -> Column:
        text = F.concat(F.lit("GEOMETRYCOLLECTION ("), F.array_join(members, ", "), F.lit(")"))
        return F.when(F.size(members) == 0, F.lit("GEOMETRYCOLLECTION EMPTY")).when(F.forall(members, lambda x: x.isNotNull()), text)

    def either(head: Column) -> Column:
        collection = _let(F.transform(head["geometries"], _simple), collected)
        return F.when(head["type"] == "GeometryCollection", collection).otherwise(_of_type(head["type"], head["coordinates"]))

    return _let(F.from_json(geometry, "type string, coordinates string, geometries array<string>"), either)
