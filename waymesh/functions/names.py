"""Ids and tiles of whole Arrow batches: the values of the column functions in ``ids`` and ``tiles``, without a pass of
the interpreter of lambda functions over each row."""

from __future__ import annotations

import functools
from decimal import ROUND_HALF_UP, Decimal
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from waymesh.functions import lines as L
from waymesh.functions import tiles as T
from waymesh.functions.types import kind

# Fixed value: the unit of the fifth decimal.
_UNIT = Decimal("0.00001")


def _slow(x: float) -> str:
    if np.isnan(x) or np.isinf(x):
        return "NaN" if np.isnan(x) else "Infinity" if x > 0 else "-Infinity"
    text = f"{Decimal(repr(float(x))).quantize(_UNIT, ROUND_HALF_UP):f}"
    return text if text.startswith("-") or not np.signbit(x) else f"-{text}"


def five_decimals(x: np.ndarray) -> pa.Array:
    """Numbers as Java's %.5f shows them. Where no tie is near, the nearest integer of the fifth decimal is it; ties, zeros
    with a sign and what is no coordinate go by the decimal digits of the number, rounded half up."""
    x = np.asarray(x, float)
    with np.errstate(invalid="ignore"):
        units = x * 1e5
        nearest = np.floor(units + 0.5)
        plain = (np.abs(x) < 1e4) & (np.abs(np.abs(units - nearest) - 0.5) > 1e-4) & ((nearest != 0) | ~np.signbit(x))
        whole = np.where(plain, nearest, 0).astype(np.int64)
    data = np.stack([whole, whole >> 63], axis=1)
    texts = pa.Array.from_buffers(pa.decimal128(18, 5), len(x), [None, pa.py_buffer(data.tobytes())]).cast(pa.string())
    if plain.all():
        return texts
    return pc.replace_with_mask(texts, pa.array(~plain), pa.array([_slow(v) for v in x[~plain]], pa.string()))


def _lists(n: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), values)


def _digests(texts: pa.Array) -> pa.Array:
    return pa.array([md5(x).digest() for x in texts.cast(pa.binary()).to_pylist()], pa.binary())


def geometry_ids(n: np.ndarray, lon: np.ndarray, lat: np.ndarray) -> pa.Array:
    """The 16 bytes of ``ids.geometry_id`` of lines of n vertices each."""
    places = pc.binary_join_element_wise(five_decimals(lon), five_decimals(lat), " ")
    return _digests(pc.binary_join_element_wise("Geometry", pc.binary_join(_lists(n, places), " "), " "))


def reference_ids(form: pa.Array, found: dict) -> pa.Array:
    """The 16 bytes of ``ids.reference_id``; ``found`` is of ``lines.measured``."""
    last = pa.array(found["no_outbound"])
    whole = lambda x: pc.if_else(last, None, pa.array(np.floor(np.nan_to_num(x) + 0.5).astype(np.int64)).cast(pa.string()))
    told = pc.binary_join_element_wise(five_decimals(found["lons"]), five_decimals(found["lats"]), whole(found["outbound"]), whole(np.repeat(found["distance"], found["n"])), " ", null_handling="skip")
    return _digests(pc.binary_join_element_wise("Reference", form.cast(pa.string()), pc.binary_join(_lists(found["n"], told), " "), " "))


def tile_xy(zoom: int, lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``tiles.tile_xy``."""
    pixels = float(T.TILE_PIXELS << min(zoom, T.MAX_ZOOM))
    across = (np.clip(lon, -T.MAX_LON, T.MAX_LON) + 180.0) / 360.0
    sine = np.sin(np.clip(lat, -T.MAX_LAT, T.MAX_LAT) * np.pi / 180.0)
    down = 0.5 - np.log((1.0 + sine) / (1.0 - sine)) / (4 * np.pi)
    x, y = (np.floor(np.clip(share * pixels + 0.5, 0.0, pixels - 1)).astype(np.int64) // T.TILE_PIXELS for share in (across, down))
    return x, y


def tiles_of(zoom: int, n: np.ndarray, lon: np.ndarray, lat: np.ndarray) -> pa.Array:
    """Lists of the distinct tiles of lines of n vertices each."""
    x, y = tile_xy(zoom, lon, lat)
    row, code = np.repeat(np.arange(len(n)), n), x << 32 | y
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    first = np.append(True, (row[1:] != row[:-1]) | (code[1:] != code[:-1]))[: len(row)]
    every, at = np.unique(code[first], return_inverse=True)
    texts = pa.array([f"{zoom}-{c >> 32}-{c & 0xFFFFFFFF}" for c in every.tolist()], pa.string())
    return _lists(np.bincount(row[first], minlength=len(n)), texts.take(pa.array(at)))


_NAMES = "size int, geometry binary, tiles array<string>, forward binary, forward_tiles array<string>, back binary, back_tiles array<string>, start_node long, start_lon double, start_lat double, end_node long, end_lon double, end_lat double"


def names_of_lines(nodes: pa.Array, one_way: pa.Array, form: pa.Array, zoom: int, even: bool = False) -> pa.Array:
    """What names the records of each line: ids, tiles and ends. Nodes (node_id, lat, lon) that repeat the one before
    them are left out; ``size`` is the number of the others, and all else is null where that is below 2."""
    count, every = np.nan_to_num(nodes.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64), nodes.flatten()
    node, lat, lon = (every.field(k).to_numpy(zero_copy_only=False) for k in ("node_id", "lat", "lon"))
    row = np.repeat(np.arange(len(count)), count)
    kept = np.append(True, (row[1:] != row[:-1]) | (node[1:] != node[:-1]))[: len(row)]
    size = np.bincount(row[kept], minlength=len(count))
    good = size >= 2
    kept &= good[row]
    node, lat, lon, n = node[kept], lat[kept], lon[kept], size[good]
    both = ~one_way.fill_null(False).to_numpy(zero_copy_only=False)[good]
    form = form.filter(pa.array(good))
    lines = L.Lines(n, lon, lat)
    forward = L.measured(lines, even, inbound=False)
    back = L.turned_back(L.measured(L.back_of(lines, both), even, inbound=False))
    spread = pa.array(np.cumsum(both) - 1, mask=~both)
    places = lambda f: tiles_of(zoom, f["n"], f["lons"], f["lats"])
    columns = [
        geometry_ids(n, lon, lat), tiles_of(zoom, n, lon, lat), reference_ids(form, forward), places(forward), reference_ids(form.filter(pa.array(both)), back).take(spread), places(back).take(spread),
        *(pa.array(v[at]) for at in (lines.first, lines.last) for v in (node, lon, lat)),
    ]
    into = pa.array(np.cumsum(good) - 1, mask=~good)
    return pa.StructArray.from_arrays([pa.array(size.astype(np.int32)), *(c.take(into) for c in columns)], [f.name for f in kind(_NAMES)])


@functools.cache
def street_names(zoom: int, even: bool = False):
    @F.arrow_udf(kind(_NAMES))
    def names(nodes: pa.Array, one_way: pa.Array, form: pa.Array) -> pa.Array:
        return names_of_lines(nodes, one_way, form, zoom, even)

    # A filter on its results would otherwise be pushed below it, with a second run of it.
    return names.asNondeterministic()


_OF_MEASURED = "tiles array<string>, forward binary, forward_tiles array<string>, back binary, back_tiles array<string>"


def names_of_measured(points: pa.Array, form: pa.Array, measured: pa.Array, zoom: int) -> pa.Array:
    """The same of geometries that are measured already; points are lists of (lon, lat)."""
    number = lambda a: a.to_numpy(zero_copy_only=False)
    every = points.flatten()
    out = [tiles_of(zoom, number(points.value_lengths()).astype(np.int64), number(every.field("lon")), number(every.field("lat")))]
    for way in ("forward", "back"):
        held = pc.struct_field(measured, way)
        some = held.is_valid()
        held = held.filter(some)
        places = {k: pc.struct_field(held, k) for k in ("lons", "lats", "outbound")}
        onward = places["outbound"].flatten()
        found = {"n": number(places["lons"].value_lengths()).astype(np.int64), "lons": number(places["lons"].flatten()), "lats": number(places["lats"].flatten()), "outbound": number(onward), "no_outbound": number(onward.is_null()), "distance": number(pc.struct_field(held, "distance"))}
        some = number(some)
        into = pa.array(np.cumsum(some) - 1, mask=~some)
        out += [c.take(into) for c in (reference_ids(form.filter(pa.array(some)), found), tiles_of(zoom, found["n"], found["lons"], found["lats"]))]
    return pa.StructArray.from_arrays(out, [f.name for f in kind(_OF_MEASURED)])


@functools.cache
def measured_names(zoom: int):
    @F.arrow_udf(kind(_OF_MEASURED))
    def names(points: pa.Array, form: pa.Array, measured: pa.Array) -> pa.Array:
        return names_of_measured(points, form, measured, zoom)

    return names
