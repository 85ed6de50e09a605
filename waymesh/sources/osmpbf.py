"""OSM-PBF files as a Spark data source.

    spark.dataSource.register(OsmPbf)
    spark.read.format("osmpbf").option("kind", "way").load(path)

``kind`` is node, way or relation. The driver walks the block headers of each file (a path, a folder, a glob or
several, separated by commas) and groups blocks to about ``partitionBytes``; tasks read and decode their range.
Blocks that are not data are skipped. Truncated files and unknown compressions are errors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from waymesh.sources.files import filesystem
from waymesh.sources.protobuf import fields

SCHEMAS = {
    "node": "id long, tags map<string,string>, lon double, lat double",
    "way": "id long, tags map<string,string>, refs array<long>",
    "relation": "id long, tags map<string,string>, members array<struct<ref:long,role:string,type:string>>",
}
# Field numbers of the format's messages, and its member types.
_HEADER = {"type": 1, "datasize": 3}
_BLOB = {"raw": 1, "raw_size": 2, "zlib": 3}
_BLOCK = {"strings": 1, "group": 2, "granularity": 17, "lat_offset": 19, "lon_offset": 20}
_GROUP = {"node": 1, "dense": 2, "way": 3, "relation": 4}
_MEMBER_TYPES = ("node", "way", "relation")
_NANO = 0.000000001


def coordinate(value: Column, granularity: Column, offset: Column) -> Column:
    """Degrees of a stored number."""
    return (granularity * value + offset).cast("double") * _NANO


def _signed(n: int) -> int:
    """Two's complement of 64 bits."""
    return n - (1 << 64) if n >> 63 else n


def _zigzag(n: int) -> int:
    return n >> 1 ^ -(n & 1)


def numbers(data: bytes) -> np.ndarray:
    """The packed varints of a field, as uint64."""
    own = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(own < 128)
    if not len(ends):
        return np.zeros(0, np.uint64)
    start = np.append(0, ends[:-1] + 1)
    own = own[: ends[-1] + 1]
    place = np.arange(len(own)) - np.repeat(start, ends - start + 1)
    return np.add.reduceat((own & 127).astype(np.uint64) << (7 * place).astype(np.uint64), start)


def deltas(data: bytes) -> np.ndarray:
    """The running sums of packed signed differences, as int64."""
    n = numbers(data)
    return np.cumsum((n >> np.uint64(1)).view(np.int64) ^ -(n & np.uint64(1)).view(np.int64))


def _fields(message: bytes) -> dict[int, list]:
    out: dict[int, list] = {}
    for number, value in fields(message):
        out.setdefault(number, []).append(value)
    return out


def _one(message: dict[int, list], number: int, default=b""):
    return message.get(number, [default])[-1]


@dataclass
class Blocks(InputPartition):
    """A range of one file that holds whole blocks."""

    uri: str
    start: int
    length: int


def block_ranges(source, size: int, most: int) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of blocks of about ``most`` bytes."""
    at = start = 0
    while at < size:
        source.seek(at)
        head = source.read(4)
        if len(head) < 4:
            raise ValueError(f"truncated file: header length at byte {at}")
        (n,) = struct.unpack(">i", head)
        header = source.read(n)
        if n <= 0 or len(header) < n:
            raise ValueError(f"truncated file: block header at byte {at}")
        end = at + 4 + n + _one(_fields(header), _HEADER["datasize"], 0)
        if end > size:
            raise ValueError(f"truncated file: block at byte {at} ends beyond the file")
        at = end
        if at - start >= most:
            yield start, at - start
            start = at
    if at > start:
        yield start, at - start


def data_blocks(data: bytes) -> Iterator[bytes]:
    """The decompressed data blocks of a range."""
    at = 0
    while at < len(data):
        (n,) = struct.unpack(">i", data[at : at + 4])
        header = _fields(data[at + 4 : at + 4 + n])
        at += 4 + n
        size = _one(header, _HEADER["datasize"], 0)
        if _one(header, _HEADER["type"]) == b"OSMData":
            blob = _fields(data[at : at + size])
            if _BLOB["raw"] in blob:
                yield _one(blob, _BLOB["raw"])
            elif _BLOB["zlib"] in blob:
                yield zlib.decompress(_one(blob, _BLOB["zlib"]))
            else:
                raise ValueError("unsupported compression of a block")
        at += size


class Block:
    """A data block and its entities, as Arrow batches."""

    def __init__(self, data: bytes):
        top = _fields(data)
        self.strings = [s.decode("utf-8", "replace") for s in _fields(_one(top, _BLOCK["strings"])).get(1, [])]
        self.granularity = _one(top, _BLOCK["granularity"], 100)
        self.lat_offset = _signed(_one(top, _BLOCK["lat_offset"], 0))
        self.lon_offset = _signed(_one(top, _BLOCK["lon_offset"], 0))
        self.groups = top.get(_BLOCK["group"], [])

    def _messages(self, kind: str) -> Iterator[dict[int, list]]:
        """Messages of a kind. A group holds one kind, told by its first byte; others are not read."""
        number = _GROUP[kind]
        for group in self.groups:
            if group and group[0] >> 3 == number:
                yield from map(_fields, (x for n, x in fields(group) if n == number))

    def text(self, i: int) -> str:
        return self.strings[i] if 0 <= i < len(self.strings) else ""

    def tags(self, keys, values) -> list[tuple[str, str]] | None:
        return list({self.text(k): self.text(v) for k, v in zip(keys, values, strict=False)}.items()) or None

    def _tags(self, m: dict[int, list]) -> list[tuple[str, str]] | None:
        return self.tags(numbers(_one(m, 2)).tolist(), numbers(_one(m, 3)).tolist()) if 2 in m else None

    def _places(self, ids, tags, lat, lon) -> pa.RecordBatch:
        degrees = lambda x, offset: (self.granularity * np.asarray(x, np.int64) + offset).astype(float) * _NANO
        return _batch("node", np.asarray(ids, np.int64), tags, degrees(lon, self.lon_offset), degrees(lat, self.lat_offset))

    def nodes(self) -> Iterator[pa.RecordBatch]:
        plain = [(_zigzag(_one(m, 1, 0)), self._tags(m), _zigzag(_one(m, 8, 0)), _zigzag(_one(m, 9, 0))) for m in self._messages("node")]
        if plain:
            yield self._places(*zip(*plain, strict=True))
        for m in self._messages("dense"):
            ids, lat, lon = deltas(_one(m, 1)), deltas(_one(m, 8)), deltas(_one(m, 9))
            if not len(ids) == len(lat) == len(lon):
                raise ValueError("a dense group with lists of different lengths")
            # One list of key, value, ..., 0 for each node; no list at all where no node has tags.
            flat = iter(numbers(_one(m, 10)).tolist())
            tags = [None] * len(ids)
            for i in range(len(ids) if 10 in m else 0):
                keys, values = [], []
                while (k := next(flat, 0)) != 0:
                    keys.append(k)
                    values.append(next(flat, 0))
                tags[i] = self.tags(keys, values)
            yield self._places(ids, tags, lat, lon)

    def ways(self) -> Iterator[pa.RecordBatch]:
        rows = [(_signed(_one(m, 1, 0)), self._tags(m), deltas(_one(m, 8)).tolist() or None) for m in self._messages("way")]
        if rows:
            yield _batch("way", *map(list, zip(*rows, strict=True)))

    def relations(self) -> Iterator[pa.RecordBatch]:
        rows = []
        for m in self._messages("relation"):
            members = zip(deltas(_one(m, 9)).tolist(), map(self.text, numbers(_one(m, 8)).tolist()), (_MEMBER_TYPES[t] for t in numbers(_one(m, 10)).tolist()), strict=True)
            rows.append((_signed(_one(m, 1, 0)), self._tags(m), [dict(zip(("ref", "role", "type"), x, strict=True)) for x in members] or None))
        if rows:
            yield _batch("relation", *map(list, zip(*rows, strict=True)))


_TAGS = pa.map_(pa.string(), pa.string())
_ARROW = {
    "node": pa.schema([("id", pa.int64()), ("tags", _TAGS), ("lon", pa.float64()), ("lat", pa.float64())]),
    "way": pa.schema([("id", pa.int64()), ("tags", _TAGS), ("refs", pa.list_(pa.int64()))]),
    "relation": pa.schema([("id", pa.int64()), ("tags", _TAGS), ("members", pa.list_(pa.struct([("ref", pa.int64()), ("role", pa.string()), ("type", pa.string())])))]),
}


def _batch(kind: str, *columns) -> pa.RecordBatch:
    schema = _ARROW[kind]
    return pa.RecordBatch.from_arrays([pa.array(list(c) if isinstance(c, tuple) else c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


class OsmPbf(DataSource):
    @classmethod
    def name(cls) -> str:
        return "osmpbf"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "node")]

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.kind = options.get("kind", "node")
        self.paths = [p for p in options.get("path", "").split(",") if p]
        self.most = int(options.get("partitionbytes", options.get("partitionBytes", 32 << 20)))

    def _files(self) -> Iterator[tuple[str, str]]:
        """(URI or path, path in its file system)"""
        import fnmatch

        for given in self.paths:
            files, path = filesystem(given)
            prefix = given[: len(given) - len(path)] if given.endswith(path) else ""
            if any(c in path for c in "*?["):
                folder = path[: min(path.find(c) for c in "*?[" if c in path)].rpartition("/")[0]
                found = [x.path for x in files.get_file_info(fs.FileSelector(folder, recursive=True)) if x.is_file and fnmatch.fnmatch(x.path, path)]
            elif files.get_file_info(path).type == fs.FileType.Directory:
                found = [x.path for x in files.get_file_info(fs.FileSelector(path)) if x.path.endswith(".pbf")]
            else:
                found = [path]
            yield from ((prefix + x, x) for x in sorted(found))

    def partitions(self) -> list[Blocks]:
        out = []
        for uri, path in self._files():
            files, _ = filesystem(uri)
            with files.open_input_file(path) as source:
                out += [Blocks(uri, a, n) for a, n in block_ranges(source, source.size(), self.most)]
        return out

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Blocks):
            return
        files, path = filesystem(partition.uri)
        with files.open_input_file(path) as source:
            source.seek(partition.start)
            data = source.read(partition.length)
        for raw in data_blocks(data):
            yield from getattr(Block(raw), f"{self.kind}s")()
