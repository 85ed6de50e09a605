"""Text codecs: tag maps, Base64 and Base58."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from waymesh.functions.tags import stripped
from waymesh.functions.types import kind

# The Base58 alphabet used for addresses.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def map_to_string(tags: Column) -> Column:
    """k=v joined by |, in the order of keys; null values and a null map are empty."""
    pairs = F.transform(F.array_sort(F.map_entries(tags)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.coalesce(F.array_join(pairs, "|"), F.lit(""))


def string_to_map(text: Column) -> Column:
    """The inverse: parts without = are skipped, the last of equal keys wins, a blank text is null."""
    parts = F.filter(F.split(text, r"\|"), lambda p: F.contains(p, F.lit("=")))
    pairs = F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.substr(p, F.instr(p, "=") + 1).alias("v")))
    last = F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["k"] == e["k"]))
    return F.when(stripped(text) != "", F.map_from_entries(last))


def to_ascii(data: Column) -> Column:
    return F.base64(data)


def from_ascii(text: Column) -> Column:
    return F.unbase64(text)


_DIGITS = np.frombuffer(BASE58.encode(), np.uint8)
_VALUES = np.full(256, 58, np.uint8)
_VALUES[_DIGITS] = np.arange(58)
_GROUP = 58**5


def _encode58(data: np.ndarray) -> list[str]:
    """Rows of equal length as text: long division by 58**5 of all rows at once, two bytes at a time."""
    n, size = data.shape
    limbs = np.zeros((n, -(-size // 2)), np.uint64)
    padded = np.zeros((n, 2 * limbs.shape[1]), np.uint64)
    padded[:, 2 * limbs.shape[1] - size :] = data
    limbs[:] = padded[:, ::2] << np.uint64(8) | padded[:, 1::2]
    digits = []
    while limbs.any():
        rest = np.zeros(n, np.uint64)
        for k in range(limbs.shape[1]):
            rest = rest << np.uint64(16) | limbs[:, k]
            limbs[:, k], rest = rest // np.uint64(_GROUP), rest % np.uint64(_GROUP)
        for _ in range(5):
            digits.append((rest % np.uint64(58)).astype(np.uint8))
            rest //= np.uint64(58)
    every = np.stack([*digits, np.zeros(n, np.uint8)], axis=1)[:, ::-1]
    filled = every != 0
    lead = np.where(filled.any(axis=1), filled.argmax(axis=1), every.shape[1])
    other = data != 0
    zeros = np.where(other.any(axis=1), other.argmax(axis=1), size)
    text = _DIGITS[every].tobytes().decode()
    wide = every.shape[1]
    return ["1" * z + text[i * wide + a : (i + 1) * wide] for i, (z, a) in enumerate(zip(zeros.tolist(), lead.tolist(), strict=True))]


def _decode58(text: np.ndarray) -> list[bytes]:
    """The inverse, for rows of equal length."""
    n, size = text.shape
    value = _VALUES[text]
    if (value > 57).any():
        raise ValueError(f"not a Base58 character: {chr(int(text[value > 57][0]))!r}")
    limbs = np.zeros((n, -(-size * 3 // 8) + 1), np.uint64)
    for k in range(size):
        carry = value[:, k].astype(np.uint64)
        for j in range(limbs.shape[1] - 1, -1, -1):
            carry = limbs[:, j] * np.uint64(58) + carry
            limbs[:, j], carry = carry & np.uint64(0xFFFF), carry >> np.uint64(16)
    data = limbs.astype(">u2").view(np.uint8).reshape(n, -1)
    filled, other = data != 0, value != 0
    lead = np.where(filled.any(axis=1), filled.argmax(axis=1), data.shape[1])
    zeros = np.where(other.any(axis=1), other.argmax(axis=1), size)
    return [b"\0" * z + row[a:].tobytes() for row, z, a in zip(data, zeros.tolist(), lead.tolist(), strict=True)]


def _by_length(column: pd.Series, convert, empty) -> pd.Series:
    """``convert`` applied to all values of each length at once."""
    out = pd.Series([None] * len(column), index=column.index, dtype=object)
    raw = column.dropna().map(lambda x: x.encode() if isinstance(x, str) else bytes(x))
    for size, rows in raw.groupby(raw.map(len)):
        if not size:
            out.loc[rows.index] = empty
            continue
        out.loc[rows.index] = pd.Series(convert(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), size)), index=rows.index, dtype=object)
    return out


@F.pandas_udf(kind("string"))
def base58(data: pd.Series) -> pd.Series:
    return _by_length(data, _encode58, "")


@F.pandas_udf(kind("binary"))
def base58_bytes(text: pd.Series) -> pd.Series:
    return _by_length(text, _decode58, b"")


def polyline_shape(points: Column) -> Column:
    """The shape record of an array of (lon, lat): type 3, box, one part, points; little-endian."""
    return _polyline_shape(F.transform(points, lambda p: p["lon"]), F.transform(points, lambda p: p["lat"]))


@F.pandas_udf(kind("binary"))
def _polyline_shape(lons: pd.Series, lats: pd.Series) -> pd.Series:
    def one(x, y) -> bytes:
        box = [min(x), min(y), max(x), max(y)] if len(x) else [0.0] * 4
        return struct.pack("<i4d3i", 3, *box, 1, len(x), 0) + np.stack([x, y], axis=1).astype("<f8").tobytes()

    return pd.Series([one(x, y) for x, y in zip(lons, lats, strict=True)], dtype=object)


@F.pandas_udf(kind("lons array<double>, lats array<double>"))
def polyline_from_shape(data: pd.Series) -> pd.DataFrame:
    """lons and lats of the points of a shape record of a polyline, all parts in order; null for null."""
    rows = []
    for x in data:
        if x is None:
            rows.append((None, None))
            continue
        x = bytes(x)
        if len(x) < 44 or struct.unpack_from("<i", x)[0] not in (3, 13, 23):
            raise ValueError("not a shape record of a polyline")
        parts, n = struct.unpack_from("<2i", x, 36)
        if n < 0 or parts < 0 or len(x) < 44 + 4 * parts + 16 * n:
            raise ValueError("a truncated shape record")
        place = np.frombuffer(x, "<f8", 2 * n, 44 + 4 * parts).reshape(n, 2)
        rows.append((place[:, 0].tolist(), place[:, 1].tolist()))
    return pd.DataFrame(rows, columns=["lons", "lats"])


def polyline_from_ascii(text: Column) -> Column:
    """The points of a polyline whose shape record is given as Base64."""
    return polyline_from_shape(from_ascii(text))
