"""The data source on files from a small encoder."""

import struct
import zlib

import pytest

from waymesh.plans.build import build
from waymesh.sources.osmpbf import OsmPbf
from waymesh.sources.protobuf import packed_integers, string, varint


def zig(n):
    return n << 1 if n >= 0 else (-n << 1) - 1


def num(field, n):
    return varint(field << 3) + varint(n)


def sub(field, data):
    return varint(field << 3 | 2) + varint(len(data)) + data


def deltas(values):
    return [zig(b - a) for a, b in zip([0, *values], values)]  # noqa: B905


class Encoder:
    def __init__(self):
        self.strings = [""]

    def s(self, text):
        if text not in self.strings:
            self.strings.append(text)
        return self.strings.index(text)

    def tags(self, tags):
        return packed_integers(2, [self.s(k) for k in tags]) + packed_integers(3, [self.s(v) for v in tags.values()]) if tags else b""

    def node(self, i, lon, lat, tags=None):
        return sub(1, num(1, zig(i)) + self.tags(tags) + num(8, zig(lat)) + num(9, zig(lon)))

    def dense(self, nodes):
        flat = [x for _, _, _, t in nodes for x in [*(v for k in (t or {}) for v in (self.s(k), self.s(t[k]))), 0]]
        body = b"".join(packed_integers(f, deltas([n[k] for n in nodes])) for f, k in ((1, 0), (8, 2), (9, 1)))
        return sub(2, body + (packed_integers(10, flat) if any(n[3] for n in nodes) else b""))

    def way(self, i, refs, tags=None):
        return sub(3, num(1, i) + self.tags(tags) + packed_integers(8, deltas(refs)))

    def relation(self, i, members, tags=None):
        return sub(4, num(1, i) + self.tags(tags) + packed_integers(8, [self.s(r) for _, r, _ in members]) + packed_integers(9, deltas([m for m, _, _ in members])) + packed_integers(10, [t for _, _, t in members]))

    def block(self, *groups, extra=b""):
        table = b"".join(sub(1, x.encode()) for x in self.strings)
        return sub(1, table) + b"".join(sub(2, g) for g in groups) + extra


def framed(data, kind="OSMData", how="zlib"):
    blob = {"zlib": num(2, len(data)) + sub(3, zlib.compress(data)), "raw": sub(1, data), "lzma": sub(4, data)}[how]
    header = string(1, kind) + num(3, len(blob))
    return struct.pack(">i", len(header)) + header + blob


def sample():
    a, b, c = Encoder(), Encoder(), Encoder()
    first = a.block(a.node(5, -740000000, 407000000, {"name": "é"}), a.dense([(10, -740010000, 407010000, None), (7, -740020000, 407020000, {"k": "v", "w": "x"}), (12, 1, -1, None)]))
    second = b.block(b.way(1, [10, 7, 5], {"highway": "residential"}), b.way(2, [], None), b.way(3, [5, 12], {"highway": "primary"}))
    third = c.block(c.relation(9, [(1, "outer", 1), (5, "", 0), (9, "part", 2)], {"type": "x"}), c.dense([(20, 100, 200, None)]), extra=num(17, 1000) + num(19, 5_000_000) + num(20, (1 << 64) - 7))
    return framed(b"bounds", "OSMHeader") + framed(first) + framed(second, how="raw") + framed(third)


@pytest.fixture
def read(spark, tmp_path):
    spark.dataSource.register(OsmPbf)
    path = tmp_path / "map.osm.pbf"

    def run(kind, data, **options):
        path.write_bytes(data)
        return spark.read.format("osmpbf").options(kind=kind, **options).load(str(path)).collect()

    return run


@pytest.mark.parametrize("size", ["1", "100000"])
def test_entities(read, size):
    nodes = {r.id: r for r in read("node", sample(), partitionBytes=size)}
    assert set(nodes) == {5, 10, 7, 12, 20}
    assert (nodes[5].tags, nodes[5].lon, nodes[5].lat) == ({"name": "é"}, -74.0, 40.7)
    assert nodes[10].tags is None and nodes[7].tags == {"k": "v", "w": "x"} and nodes[12].lat == -100 * 0.000000001
    assert nodes[20].lat == (1000 * 200 + 5_000_000) * 0.000000001 and nodes[20].lon == (1000 * 100 - 7) * 0.000000001
    ways = {r.id: r for r in read("way", sample(), partitionBytes=size)}
    assert ways[1].refs == [10, 7, 5] and ways[1].tags == {"highway": "residential"} and ways[2].refs is None and ways[2].tags is None
    (relation,) = read("relation", sample(), partitionBytes=size)
    assert [tuple(m) for m in relation.members] == [(1, "outer", "way"), (5, "", "node"), (9, "part", "relation")]


def test_odd_files(read):
    assert read("node", b"") == [] and read("node", framed(b"bounds", "OSMHeader")) == []
    for broken in (sample()[:-3], sample()[:2], sample() + b"\0\0\0\x40abc"):
        with pytest.raises(Exception, match="truncated"):
            read("node", broken)
    with pytest.raises(Exception, match="compression"):
        read("node", framed(b"x", how="lzma"))


def test_folders_and_globs(spark, tmp_path):
    spark.dataSource.register(OsmPbf)
    for name in ("a.osm.pbf", "b.osm.pbf"):
        (tmp_path / name).write_bytes(sample())
    (tmp_path / "c.txt").write_bytes(b"no")
    for path in (str(tmp_path), f"{tmp_path}/*.pbf", f"file://{tmp_path}", f"{tmp_path}/a.osm.pbf,{tmp_path}/b.osm.pbf"):
        assert spark.read.format("osmpbf").option("kind", "way").load(path).count() == 6


def test_build(spark, tmp_path):
    source = tmp_path / "map.osm.pbf"
    source.write_bytes(sample())
    manifest = build(spark, str(source), str(tmp_path / "tiles")).collect()
    assert manifest and all((tmp_path / "tiles" / r.file).stat().st_size == r.n_bytes for r in manifest)
    with pytest.raises(FileExistsError):
        build(spark, str(source), str(tmp_path / "tiles"))
    with pytest.raises(FileNotFoundError):
        build(spark, str(tmp_path / "none.pbf"), str(tmp_path / "x"))
    with pytest.raises(ValueError, match="pbf"):
        build(spark, str(tmp_path / "none.txt"), str(tmp_path / "x"))
