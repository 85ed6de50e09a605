"""Content-addressed ids: MD5 of a text that names the record. Java's formatter does the rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def round_half_up(x: Column) -> Column:
    """floor(x + 0.5), also for negative numbers."""
    return F.floor(x + F.lit(0.5)).cast("long")


def intersection_id(lon: Column, lat: Column, node_id: Column) -> Column:
    place = F.format_string("Intersection %.5f %.5f", lon, lat)
    return content_id(F.when(node_id.isNull(), place).otherwise(F.concat(place, F.lit(" "), node_id.cast("string"))))


def geometry_id(points: Column) -> Column:
    """Of an array of (lon, lat) structs; the direction matters."""
    each = F.transform(points, lambda p: F.format_string(" %.5f %.5f", p["lon"], p["lat"]))
    return content_id(F.concat(F.lit("Geometry"), F.array_join(each, "")))


def reference_id(form_of_way: Column, lprs: Column) -> Column:
    """Of a form-of-way code and an array of (lon, lat, outbound, distance) structs."""

    def one(p: Column) -> Column:
        onward = F.concat(F.lit(" "), round_half_up(p["outbound"]).cast("string"), F.lit(" "), round_half_up(p["distance"]).cast("string"))
        return F.concat(F.format_string(" %.5f %.5f", p["lon"], p["lat"]), F.when(p["outbound"].isNull(), F.lit("")).otherwise(onward))

    return content_id(F.concat(F.lit("Reference "), form_of_way.cast("string"), F.array_join(F.transform(lprs, one), "")))


def id_bytes(hex_id: Column) -> Column:
    """16 bytes of an id in hex; null where it is not one."""
    return F.when(F.length(hex_id) == 32, F.unhex(hex_id))


def id_text(data: Column) -> Column:
    return F.lower(F.hex(data))
