"""A map extract of the derived network: OSM-PBF files, one a task, that the data source reads back.

Blocks differ in what the format leaves open: dense and plain nodes, raw and zlib blobs, granularity and offsets.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.operators.durable import checkpointed, fresh_path
from waymesh.plans import fixture
from waymesh.sources.files import write_whole
from waymesh.sources.osmpbf import OsmPbf
from waymesh.sources.protobuf import packed_integers, string, varint

_BLOCK_ROWS = 500
_TYPES = {"node": 0, "way": 1, "relation": 2}


def _zig(n: int) -> int:
    return n << 1 if n >= 0 else (-n << 1) - 1


def _number(field: int, n: int) -> bytes:
    return varint(field << 3) + varint(n)


def _sub(field: int, data: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(data)) + data


def _deltas(values: list[int]) -> list[int]:
    return [_zig(b - a) for a, b in zip([0, *values[:-1]], values, strict=True)]


class _Strings:
    def __init__(self):
        self.at = {"": 0}

    def __call__(self, text: str) -> int:
        return self.at.setdefault(text, len(self.at))

    def tags(self, tags: list | None) -> bytes:
        return packed_integers(2, [self(k) for k, _ in tags]) + packed_integers(3, [self(v) for _, v in tags]) if tags else b""


def _framed(data: bytes, squeeze: bool, kind: str = "OSMData") -> bytes:
    blob = _number(2, len(data)) + _sub(3, zlib.compress(data)) if squeeze else _sub(1, data)
    header = string(1, kind) + _number(3, len(blob))
    return struct.pack(">i", len(header)) + header + blob


def _block(kind: str, rows: list[tuple], n: int) -> bytes:
    """One block; what the format leaves open goes by its number."""
    strings, group, extra = _Strings(), b"", b""
    if kind == "node":
        step, shift = (1000, 5_000_000) if n % 3 == 2 else (100, 0)
        stored = lambda x: (round(x * 1e7) * 100 - shift) // step
        extra = _number(17, step) + _number(19, shift) + _number(20, shift) if shift else b""
        if n % 2:
            group = b"".join(_sub(1, _number(1, _zig(i)) + strings.tags(t) + _number(8, _zig(stored(lat))) + _number(9, _zig(stored(lon)))) for i, t, lon, lat in rows)
        else:
            flat = [x for _, t, _, _ in rows for x in [*(strings(y) for pair in t or () for y in pair), 0]]
            lists = ([r[0] for r in rows], [stored(r[3]) for r in rows], [stored(r[2]) for r in rows])
            group = _sub(2, b"".join(packed_integers(f, _deltas(x)) for f, x in zip((1, 8, 9), lists, strict=True)) + packed_integers(10, flat))
    elif kind == "way":
        group = b"".join(_sub(3, _number(1, i) + strings.tags(t) + packed_integers(8, _deltas(refs))) for i, t, refs in rows)
    else:
        for i, t, members in rows:
            body = packed_integers(8, [strings(m["role"]) for m in members]) + packed_integers(9, _deltas([m["ref"] for m in members])) + packed_integers(10, [_TYPES[m["type"]] for m in members])
            group += _sub(4, _number(1, i) + strings.tags(t) + body)
    table = b"".join(_sub(1, x.encode()) for x in strings.at)
    return _framed(_sub(1, table) + _sub(2, group) + extra, squeeze=n % 2 == 0)


def write_extract(rows: DataFrame, kind: str, folder: str) -> DataFrame:
    """A file for each task; returns file, n_bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/{kind}-{TaskContext.get().partitionId():06d}.osm.pbf"

        def blocks() -> Iterator[bytes]:
            yield _framed(b"bounds", True, "OSMHeader")
            n = 0
            for batch in batches:
                for a in range(0, batch.num_rows, _BLOCK_ROWS):
                    yield _block(kind, list(zip(*(c.to_pylist() for c in batch.slice(a, _BLOCK_ROWS).columns), strict=True)), n)
                    n += 1

        yield pa.RecordBatch.from_pydict({"file": [name], "n_bytes": [write_whole(name, blocks())]})

    return checkpointed(rows.mapInArrow(run, "file string, n_bytes long"))


def read_extract(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The entities of a kind of the derived network, after a way through files."""
    spark.dataSource.register(OsmPbf)
    rows = {"node": fixture.nodes, "way": fixture.ways, "relation": fixture.relations}[kind](spark, sf_dir)
    if kind == "node":
        rows = rows.withColumn("tags", F.when(F.col("id") % 7 == 0, F.create_map(F.lit("k"), F.col("id").cast("string"))))
    folder = fresh_path(spark, "extract")
    write_extract(rows.select("id", "tags", *(("lon", "lat") if kind == "node" else ("refs",) if kind == "way" else ("members",))), kind, folder)
    # Small splits, so that a file has several.
    return spark.read.format("osmpbf").option("kind", kind).option("partitionBytes", 64_000).load(folder)
