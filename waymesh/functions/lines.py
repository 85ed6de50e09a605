"""Geodesic functions of columns: Arrow batches through numpy, all lines of a batch at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymesh.functions import geodesic as G
from waymesh.functions.types import kind

# Spacing of location references and the distance at which bearings are taken, in metres.
SPACING, BEARING_OFFSET = 15_000.0, 20.0
_NEAR = 1e-10


@F.pandas_udf(kind("double"))
def geodesic_distance(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    return pd.Series(G.inverse(lon1, lat1, lon2, lat2)[0])


class Lines:
    """The lines of a batch, one behind another: vertices, and of every leg its length and azimuths."""

    def __init__(self, count, lon, lat, legs=None):
        self.count, self.lon, self.lat = np.asarray(count, np.int64), np.asarray(lon, float), np.asarray(lat, float)
        self.first = np.cumsum(self.count) - self.count
        self.last = self.first + self.count - 1
        if legs is None:
            legs = np.zeros((3, max(0, len(self.lon) - 1)))
            inside = np.ones(legs.shape[1], bool)
            # Between lines there is no leg; empty lines have no last vertex of their own.
            ends = self.last[self.count > 0][:-1]
            inside[ends] = False
            at = np.flatnonzero(inside)
            if len(at):
                legs[:, at] = G.inverse(self.lon[at], self.lat[at], self.lon[at + 1], self.lat[at + 1])
        self.leg, self.azimuth1, self.azimuth2 = legs
        self.run = np.append(0.0, np.cumsum(self.leg))
        self.length = np.where(self.count > 0, self.run[np.maximum(self.last, 0)] - self.run[np.minimum(self.first, len(self.run) - 1)], 0.0)

    @classmethod
    def of(cls, lons: list, lats: list) -> Lines:
        flat = lambda x: np.concatenate([*map(np.asarray, x), np.zeros(0)])
        return cls(np.fromiter(map(len, lons), np.int64, len(lons)), flat(lons), flat(lats))

    def turned(self) -> Lines:
        """All lines the other way, the last line first."""
        legs = np.stack([self.leg[::-1], self.azimuth2[::-1] + 180, self.azimuth1[::-1] + 180])
        return Lines(self.count[::-1], self.lon[::-1], self.lat[::-1], legs)

    def _legs(self, line: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The leg on which a running length lies."""
        a, b = self.first[line], self.last[line]
        return np.clip(np.searchsorted(self.run, goal, side="left") - 1, a, np.maximum(a, b - 1))

    def points(self, line: np.ndarray, fraction: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(lon, lat, azimuth there, leg) at fractions of lines; at and beyond the ends, the end vertices. The azimuth
        is that of the leg."""
        a, b = self.first[line], self.last[line]
        goal = self.run[a] + fraction * self.length[line]
        j = self._legs(line, goal)
        lon, lat, azimuth = self.lon[a].copy(), self.lat[a].copy(), np.full(len(line), np.nan)
        some = b > a
        end, start = fraction > 1 - _NEAR, fraction < _NEAR
        lon[end], lat[end] = self.lon[b[end]], self.lat[b[end]]
        azimuth[some & start] = self.azimuth1[a[some & start]]
        azimuth[some & end] = self.azimuth2[b[some & end] - 1]
        mid = ~end & ~start & some
        if mid.any():
            k = j[mid]
            lon[mid], lat[mid], azimuth[mid] = G.direct(self.lon[k], self.lat[k], self.azimuth1[k], goal[mid] - self.run[k])
        j = np.where(end, b - 1, np.where(start, a, j))
        return lon, lat, azimuth, j


@F.pandas_udf(kind("double"))
def line_length(lons: pd.Series, lats: pd.Series) -> pd.Series:
    return pd.Series(Lines.of(list(lons), list(lats)).length)


_ONE_WAY = "lons array<double>, lats array<double>, outbound array<double>, inbound array<double>, distance double"
_REFERENCE = T.StructType([T.StructField("length", T.DoubleType()), T.StructField("forward", kind(_ONE_WAY)), T.StructField("back", kind(_ONE_WAY))])


def _bearing(lines: Lines, line: np.ndarray, near: tuple, far: tuple) -> np.ndarray:
    """The azimuth at the far point of the geodesic from near to far (each lon, lat, azimuth, leg). Where both lie on
    one leg it is the leg's; elsewhere the inverse problem gives it."""
    out = np.where(near[3] == far[3], far[2], np.nan)
    # Of one place it is a constant, which ``inverse`` would give too.
    same = (near[0] == far[0]) & (near[1] == far[1])
    out[same] = np.where(far[1][same] >= 0, 180.0, 0.0)
    apart = ~same & ((near[3] != far[3]) | np.isnan(out))
    if apart.any():
        out[apart] = G.inverse(near[0][apart], near[1][apart], far[0][apart], far[1][apart])[2]
    return G.normal_azimuth(np.remainder(out + 180, 360) - 180)


def measured(lines: Lines, even: bool = False, inbound: bool = True) -> dict:
    """Places, bearings and spacing of the location references of each line: numbers of references, and flat arrays.

    ``even`` False places every reference but the first on the last vertex (ids depend on that); True spreads
    them evenly. Bearings are azimuths at the far point of a 20 m step, or, on shorter lines, of the line's end; the
    last reference has none onward, the first none inbound, and 0 stands there. ``inbound`` False leaves those out.
    """
    n = np.where(lines.length <= SPACING, 2, np.ceil(lines.length / SPACING)).astype(np.int64)
    line = np.repeat(np.arange(len(n)), n)
    i = np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)
    steps = (n - 1)[line]
    fraction = np.where(i == 0, 0.0, i / steps if even else steps // np.maximum(i, 1))
    here = lines.points(line, fraction)
    length = lines.length[line]
    long = length > BEARING_OFFSET
    shift = np.divide(BEARING_OFFSET, length, out=np.zeros_like(length), where=length > 0)

    def bearings(none: np.ndarray, other: np.ndarray, onward: bool) -> np.ndarray:
        out, at = np.zeros(len(line)), np.flatnonzero(~none)
        if len(at):
            own, step = tuple(x[at] for x in here), lines.points(line[at], other[at])
            out[at] = _bearing(lines, line[at], *((own, step) if onward else (step, own)))
        return out

    out = {"n": n, "lons": here[0], "lats": here[1], "no_outbound": i == steps, "no_inbound": i == 0, "distance": lines.length / (n - 1)}
    out["outbound"] = bearings(i == steps, np.where(long, fraction + shift, 1.0), True)
    if inbound:
        out["inbound"] = bearings(i == 0, np.where(long, np.maximum(fraction - shift, 0.0), 0.0), False)
    return out


def turned_back(found: dict) -> dict:
    """The lines of ``measured`` in opposite order; each line's own references stay in order."""
    n = found["n"][::-1]
    start = (np.cumsum(found["n"]) - found["n"])[::-1]
    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return {"n": n, "distance": found["distance"][::-1]} | {k: v[at] for k, v in found.items() if k not in ("n", "distance")}


def _struct(found: dict, rows: np.ndarray | None = None) -> pa.Array:
    """One direction as an Arrow array; with ``rows``, for the rows that are set, null elsewhere."""
    n = found["n"] if rows is None else np.zeros(len(rows), np.int64)
    if rows is not None:
        n[rows] = found["n"]
    offsets = pa.array(np.append(0, np.cumsum(n)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(found[k], mask=found.get(f"no_{k}"))) for k in ("lons", "lats", "outbound", "inbound")]
    distance = found["distance"]
    if rows is not None:
        distance = np.zeros(len(rows))
        distance[rows] = found["distance"]
    mask = None if rows is None else pa.array(~rows)
    return pa.StructArray.from_arrays([*lists, pa.array(distance)], ["lons", "lats", "outbound", "inbound", "distance"], mask=mask)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, values) of a list array."""
    return np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64), column.flatten().to_numpy(zero_copy_only=False)


def back_of(lines: Lines, both: np.ndarray) -> Lines:
    """The lines that are set, the other way and in opposite order; their legs are not measured again."""
    keep = np.repeat(both, lines.count)
    # The legs of the two-way lines; one between two lines is never read.
    inner = np.flatnonzero(keep)[:-1]
    legs = np.stack([x[np.minimum(inner, max(0, len(x) - 1))] if len(x) else np.zeros(len(inner)) for x in (lines.leg, lines.azimuth1, lines.azimuth2)])
    back = Lines(lines.count[both], lines.lon[keep], lines.lat[keep], legs)
    gap = back.last[back.count > 0][:-1]
    back.leg[gap] = 0.0
    return Lines(back.count, back.lon, back.lat, np.stack([back.leg, back.azimuth1, back.azimuth2])).turned()


def references_of_lines(lons: pa.Array, lats: pa.Array, one_way: pa.Array, even: bool = False) -> pa.Array:
    """length, forward and back (null on one-way lines) of each line. Legs are measured once for both directions."""
    (count, lon), (_, lat) = _flat(lons), _flat(lats)
    lines = Lines(count, lon, lat)
    both = ~one_way.fill_null(False).to_numpy(zero_copy_only=False)
    back = back_of(lines, both)
    forward = _struct(measured(lines, even))
    return pa.StructArray.from_arrays([pa.array(lines.length), forward, _struct(turned_back(measured(back, even)), both)], ["length", "forward", "back"])


def reference_of_lines(lons: list, lats: list, even: bool = False) -> pd.DataFrame:
    """The forward direction of lists of lines, as a frame."""
    found = _struct(measured(Lines.of(lons, lats), even)).to_pylist()
    return pd.DataFrame(found, columns=["lons", "lats", "outbound", "inbound", "distance"])


@F.arrow_udf(_REFERENCE)
def linear_reference(lons: pa.Array, lats: pa.Array, one_way: pa.Array) -> pa.Array:
    return references_of_lines(lons, lats, one_way)


@F.arrow_udf(_REFERENCE)
def linear_reference_even(lons: pa.Array, lats: pa.Array, one_way: pa.Array) -> pa.Array:
    return references_of_lines(lons, lats, one_way, even=True)


def interpolate(lon1: Column, lat1: Column, lon2: Column, lat2: Column, fraction: Column) -> Column:
    return _interpolate(lon1, lat1, lon2, lat2, fraction)


@F.pandas_udf(kind("lon double, lat double"))
def _interpolate(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series, fraction: pd.Series) -> pd.DataFrame:
    length, azimuth, _ = G.inverse(lon1, lat1, lon2, lat2)
    lon, lat, _ = G.direct(lon1, lat1, azimuth, length * fraction.to_numpy())
    return pd.DataFrame({"lon": lon, "lat": lat})


@F.pandas_udf(kind("lon double, lat double"))
def line_point(lons: pd.Series, lats: pd.Series, fraction: pd.Series) -> pd.DataFrame:
    lon, lat, _, _ = Lines.of(list(lons), list(lats)).points(np.arange(len(fraction)), fraction.to_numpy(float))
    return pd.DataFrame({"lon": lon, "lat": lat})


@F.pandas_udf(kind("double"))
def azimuth(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series, fraction: pd.Series) -> pd.Series:
    f = fraction.to_numpy(float)
    length, first, last = G.inverse(lon1, lat1, lon2, lat2)
    between = G.direct(lon1, lat1, first, length * f)[2]
    return pd.Series(G.normal_azimuth(np.where(np.abs(f) < _NEAR, first, np.where(np.abs(f - 1) < _NEAR, last, between))))


@F.pandas_udf(kind("double"))
def line_azimuth(lons: pd.Series, lats: pd.Series, fraction: pd.Series) -> pd.Series:
    lines = Lines.of(list(lons), list(lats))
    f = fraction.to_numpy(float)
    found = lines.points(np.arange(len(f)), f)[2]
    # A line without length has a direction at its ends only.
    return pd.Series(np.where((lines.length > 0) | (f < _NEAR) | (f > 1 - _NEAR), G.normal_azimuth(np.remainder(found + 180, 360) - 180), np.nan))


@F.pandas_udf(kind("double"))
def intercept(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series, lon: pd.Series, lat: pd.Series) -> pd.Series:
    return pd.Series(G.fractions_on(*(x.to_numpy(float) for x in (lon1, lat1, lon2, lat2, lon, lat))))


@F.pandas_udf(kind("double"))
def line_intercept(lons: pd.Series, lats: pd.Series, lon: pd.Series, lat: pd.Series) -> pd.Series:
    return pd.Series(fractions_of_lines(Lines.of(list(lons), list(lats)), lon.to_numpy(float), lat.to_numpy(float)))


def fractions_of_lines(lines: Lines, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Fraction of each line's length at the point of it that is nearest to its (x, y); the first of equally near."""
    n = np.maximum(lines.count - 1, 0)
    line = np.repeat(np.arange(len(n)), n)
    k = np.repeat(lines.first - (np.cumsum(n) - n), n) + np.arange(len(line))
    out = np.zeros(len(n))
    if not len(k):
        return out
    lon1, lat1, lon2, lat2 = lines.lon[k], lines.lat[k], lines.lon[k + 1], lines.lat[k + 1]
    f = np.clip(G.fractions_on(lon1, lat1, lon2, lat2, x[line], y[line]), 0, 1)
    lon, lat, _ = G.direct(lon1, lat1, lines.azimuth1[k], lines.leg[k] * f)
    far = G.inverse(lon, lat, x[line], y[line])[0]
    order = np.lexsort((np.arange(len(k)), far, line))
    best = order[np.append(True, line[order][1:] != line[order][:-1])]
    own = line[best]
    some = lines.length[own] > 0
    best, own = best[some], own[some]
    out[own] = (lines.run[k[best]] - lines.run[lines.first[own]] + f[best] * lines.leg[k[best]]) / lines.length[own]
    return out


@F.pandas_udf(kind("min_lon double, min_lat double, max_lon double, max_lat double"))
def envelope(lon: pd.Series, lat: pd.Series, radius: pd.Series) -> pd.DataFrame:
    north, east, south, west = (G.direct(lon, lat, np.full(len(lon), a), radius)[:2] for a in (0.0, 90.0, 180.0, 270.0))
    x, y = np.stack([north[0], east[0], south[0], west[0]]), np.stack([north[1], east[1], south[1], west[1]])
    return pd.DataFrame({"min_lon": x.min(0), "min_lat": y.min(0), "max_lon": x.max(0), "max_lat": y.max(0)})


@F.pandas_udf(kind("lon double, lat double"))
def intersect(a_lon: pd.Series, a_lat: pd.Series, b_lon: pd.Series, b_lat: pd.Series, c_lon: pd.Series, c_lat: pd.Series, d_lon: pd.Series, d_lat: pd.Series) -> pd.DataFrame:
    lon, lat = G.crossings(*((x.to_numpy(float), y.to_numpy(float)) for x, y in ((a_lon, a_lat), (b_lon, b_lat), (c_lon, c_lat), (d_lon, d_lat))))
    return pd.DataFrame({"lon": lon, "lat": lat})


def vector_add(a: Column, b: Column) -> Column:
    return F.struct(*((a[k] + b[k]).alias(k) for k in "xyz"))


def vector_multiply(a: Column, factor: Column) -> Column:
    return F.struct(*((a[k] * factor).alias(k) for k in "xyz"))


def vector_dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def vector_cross(a: Column, b: Column) -> Column:
    part = lambda p, q: a[p] * b[q] - a[q] * b[p]
    return F.struct(part("y", "z").alias("x"), part("z", "x").alias("y"), part("x", "y").alias("z"))
