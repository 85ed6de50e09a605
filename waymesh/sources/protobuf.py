"""Records as length-delimited proto3 messages, and intersections read back.

Messages are built from their field numbers alone: numbers in ascending order, defaults left out, repeated
numbers packed. Encoding runs in Arrow batches.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from waymesh.functions import ids
from waymesh.functions.types import kind

# Field numbers of the messages.
INTERSECTION = {"id": 1, "node_id": 2, "lon": 3, "lat": 4, "inbound": 5, "outbound": 6}
REFERENCE = {"id": 1, "geometry_id": 2, "form_of_way": 3, "location_references": 4}
LOCATION_REFERENCE = {"intersection_id": 1, "lon": 2, "lat": 3, "inbound": 4, "outbound": 5, "distance": 6}
GEOMETRY = {"id": 1, "from_intersection_id": 2, "to_intersection_id": 3, "forward_reference_id": 4, "back_reference_id": 5, "road_class": 6, "lonlats": 7}
METADATA = {"geometry_id": 1, "osm_metadata": 2, "gis_metadata": 3}
OSM_METADATA = {"way_sections": 1, "name": 2}
WAY_SECTION = {"way_id": 1, "road_class": 2, "one_way": 3, "roundabout": 4, "link": 5, "node_ids": 6, "name": 7}


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _sized(number: int, data: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(data)) + data


def string(number: int, text: str | None) -> bytes:
    return _sized(number, text.encode()) if text else b""


def integer(number: int, value: int | None, always: bool = False) -> bytes:
    """Left out where 0, unless the field tells absence apart."""
    return varint(number << 3) + varint(int(value)) if value is not None and (value or always) else b""


def double(number: int, value: float | None) -> bytes:
    return varint(number << 3 | 1) + struct.pack("<d", value) if value else b""


def packed_doubles(number: int, values: Iterable[float]) -> bytes:
    data = b"".join(struct.pack("<d", v) for v in values)
    return _sized(number, data) if data else b""


def packed_integers(number: int, values: Iterable[int]) -> bytes:
    data = b"".join(varint(int(v)) for v in values)
    return _sized(number, data) if data else b""


def delimited(message: bytes) -> bytes:
    return varint(len(message)) + message


def messages(data: bytes) -> Iterable[bytes]:
    """The length-delimited messages of a file, each with its length."""
    at = 0
    while at < len(data):
        start, size, shift = at, 0, 0
        while True:
            byte = data[at]
            at += 1
            size |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                break
        at += size
        if at > len(data):
            raise ValueError("truncated file")
        yield data[start:at]


def fields(data: bytes) -> list[tuple[int, int | bytes]]:
    """(number, value) of every field of a message, in order."""
    out, at = [], 0

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            out.append((key >> 3, number()))
            continue
        size = {1: 8, 5: 4}.get(wire)
        if size is None:
            if wire != 2:
                raise ValueError(f"unknown wire type {wire}")
            size = number()
        if at + size > len(data):
            raise ValueError("truncated message")
        out.append((key >> 3, data[at : at + size]))
        at += size
    return out


def _intersection(m: dict) -> bytes:
    n = INTERSECTION
    body = string(n["id"], m["intersection_id"]) + integer(n["node_id"], m["node_id"]) + double(n["lon"], m["lon"]) + double(n["lat"], m["lat"])
    return body + b"".join(string(n[k], x) for k in ("inbound", "outbound") for x in m[k])


def _lpr(m: dict) -> bytes:
    n = LOCATION_REFERENCE
    body = string(n["intersection_id"], m["intersection_id"]) + double(n["lon"], m["lon"]) + double(n["lat"], m["lat"])
    return body + b"".join(integer(n[k], m[k], always=True) for k in ("inbound", "outbound", "distance"))


def _reference(m: dict) -> bytes:
    n = REFERENCE
    return string(n["id"], m["reference_id"]) + string(n["geometry_id"], m["geometry_id"]) + integer(n["form_of_way"], m["form_of_way"]) + b"".join(_sized(n["location_references"], _lpr(x)) for x in m["location_references"])


def _geometry(m: dict) -> bytes:
    n = GEOMETRY
    named = {"id": "geometry_id", "from_intersection_id": "start_intersection_id", "to_intersection_id": "end_intersection_id", "forward_reference_id": "forward_reference_id", "back_reference_id": "back_reference_id"}
    body = b"".join(string(n[k], m[v]) for k, v in named.items()) + integer(n["road_class"], m["road_class"])
    return body + packed_doubles(n["lonlats"], [x for p in m["points"] for x in (p["lon"], p["lat"])])


def _metadata(m: dict) -> bytes:
    w = WAY_SECTION
    one = lambda s: integer(w["way_id"], s["way_id"]) + integer(w["road_class"], s["road_class"]) + b"".join(integer(w[k], s[k]) for k in ("one_way", "roundabout", "link")) + packed_integers(w["node_ids"], s["node_ids"]) + string(w["name"], s["name"])
    osm = b"".join(_sized(OSM_METADATA["way_sections"], one(s)) for s in m["metadata"]["way_sections"]) + string(OSM_METADATA["name"], m["metadata"]["name"])
    return string(METADATA["geometry_id"], m["geometry_id"]) + _sized(METADATA["osm_metadata"], osm)


def _udf(make):
    @F.pandas_udf(kind("binary"))
    def encode(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([delimited(make(r)) for r in rows.to_dict("records")], dtype=object)

    return encode


_ENCODERS = {k: _udf(f) for k, f in {"intersection": _intersection, "reference": _reference, "geometry": _geometry, "metadata": _metadata}.items()}


def _apply(of: str, **columns: Column) -> Column:
    return _ENCODERS[of](F.struct(*(c.alias(k) for k, c in columns.items())))


def encode_intersection() -> Column:
    return _apply("intersection", **{k: F.col(k) for k in ("intersection_id", "node_id", "lon", "lat", "inbound", "outbound")})


def encode_reference() -> Column:
    """Bearings in whole degrees, distances in whole centimetres."""
    whole = lambda p: F.struct(p["intersection_id"].alias("intersection_id"), p["lon"].alias("lon"), p["lat"].alias("lat"), ids.round_half_up(p["inbound"]).alias("inbound"), ids.round_half_up(p["outbound"]).alias("outbound"), ids.round_half_up(p["distance"] * 100).alias("distance"))
    # Arrow hands integers with nulls over as floats in a frame, but as Python numbers inside structs.
    return _apply("reference", reference_id=F.col("reference_id"), geometry_id=F.col("geometry_id"), form_of_way=F.col("form_of_way"), location_references=F.transform("location_references", whole))


def encode_geometry() -> Column:
    return _apply("geometry", **{k: F.col(k) for k in ("geometry_id", "start_intersection_id", "end_intersection_id", "forward_reference_id", "back_reference_id", "road_class", "points")})


def encode_metadata() -> Column:
    return _apply("metadata", geometry_id=F.col("geometry_id"), metadata=F.col("metadata"))


@F.pandas_udf(kind("id string, node_id long, lon double, lat double, inbound array<string>, outbound array<string>"))
def decode_intersection(data: pd.Series) -> pd.DataFrame:
    rows, name = [], {v: k for k, v in INTERSECTION.items()}
    for x in data:
        ((_, message),) = fields(b"\x0a" + bytes(x))
        row = {"id": "", "node_id": 0, "lon": 0.0, "lat": 0.0, "inbound": [], "outbound": []}
        for number, value in fields(message):
            key = name[number]
            if isinstance(row[key], list):
                row[key].append(value.decode())
            else:
                row[key] = value if key == "node_id" else value.decode() if key == "id" else struct.unpack("<d", value)[0]
        rows.append(row)
    return pd.DataFrame(rows, columns=list(INTERSECTION))
