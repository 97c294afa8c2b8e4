"""Zone polygons: GeoJSON geometry text to the outlines a map layer draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_POLYGON = "array<array<array<double>>>"
_PARTS = f"array<{_POLYGON}>"


def _parts(geometry: Column) -> Column:
    """The polygons of a geometry, each a list of rings; a single polygon is one part."""
    coordinates = F.get_json_object(geometry, "$.coordinates")
    single = F.get_json_object(geometry, "$.type") == F.lit("Polygon")
    return F.when(single, F.array(F.from_json(coordinates, _POLYGON))).otherwise(
        F.from_json(coordinates, _PARTS)
    )


def rings_json(geometry: Column) -> Column:
    """The outer ring of each part as JSON text; holes are dropped, NULL stays NULL."""
    outlines = F.transform(_parts(geometry), lambda rings: F.element_at(rings, 1))
    return F.when(geometry.isNotNull(), F.to_json(outlines))


def _list(items: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(items, ", "), F.lit(")"))


def _number(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def well_known_text(geometry: Column) -> Column:
    """`POLYGON ((x y, ...), (hole))` or `MULTIPOLYGON (((...)), ((...)))`."""
    parts = F.transform(
        _parts(geometry),
        lambda rings: _list(
            F.transform(
                rings,
                lambda ring: _list(
                    F.transform(ring, lambda p: F.concat_ws(" ", F.transform(p, _number)))
                ),
            )
        ),
    )
    single = F.get_json_object(geometry, "$.type") == F.lit("Polygon")
    text = F.when(single, F.concat(F.lit("POLYGON "), F.element_at(parts, 1))).otherwise(
        F.concat(F.lit("MULTIPOLYGON "), _list(parts))
    )
    return F.when(geometry.isNotNull(), text)


def zone_geometry(zones: DataFrame) -> DataFrame:
    """Published zone records (`geometry` as GeoJSON text) to the staged polygon table."""
    return zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("borough").cast("string").alias("borough"),
        F.col("zone").cast("string").alias("zone"),
        F.col("Shape_Area").cast("double").alias("shape_area"),
        well_known_text(F.col("geometry")).alias("geometry_wkt"),
        rings_json(F.col("geometry")).alias("geometry_json"),
    )
