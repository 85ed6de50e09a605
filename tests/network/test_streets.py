"""Small drawn networks through every stage, and the sinks."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from waymesh.functions import tiles
from waymesh.operators import network, segments, streets
from waymesh.operators.durable import checkpointed
from waymesh.sources import json_tiles, protobuf, tile_files
from waymesh.sources.files import filesystem

ROAD = {"highway": "residential"}
PLACES = {i: (-74.0 + 0.001 * i, 40.0 + 0.0007 * (i % 7)) for i in range(200)}


def build(spark, ways, places=None, fix=True):
    """ways: id -> (refs, tags). Returns (sections, found, merged) at level 6."""
    rows = [(i, tags, refs) for i, (refs, tags) in ways.items()]
    w = network.highway_ways(spark.createDataFrame(rows, "id long, tags map<string,string>, refs array<long>"))
    n = spark.createDataFrame([(i, None, x, y) for i, (x, y) in (places or PLACES).items()], "id long, tags map<string,string>, lon double, lat double")
    links = network.way_node_links(w)
    kept = network.ways_at_level(w, network.way_nodes(network.way_points(links, network.node_positions(n))), (6,)).cache()
    found = network.intersections(network.filtered_links(links, kept)).cache()
    cuts = network.grouped_split_points(network.way_split_points(network.splitting(found)))
    sections = network.way_sections(kept, cuts).cache()
    merged = segments.merged_segments(segments.initial_segments(sections), network.merging(found), checkpointed, fix_last_last=fix)
    return sections, found, merged


def pieces(frame):
    nodes = F.transform("sections", lambda s: F.transform(s["nodes"], lambda p: p["node_id"])) if "sections" in frame.columns else F.array(F.transform("nodes", lambda p: p["node_id"]))
    return sorted([list(x) for x in r[0]] for r in frame.select(nodes).collect())


def plain(*lists, tags=ROAD):
    return {k + 1: (list(x), tags) for k, x in enumerate(lists)}


@pytest.mark.parametrize(
    "ways,sections",
    [
        (plain([1, 2, 3], [4, 2, 5]), [[1, 2], [2, 3], [2, 5], [4, 2]]),  # a crossing
        (plain([1, 2, 3], [2, 5]), [[1, 2], [2, 3], [2, 5]]),  # a tee
        (plain([1, 2], [2, 3], [2, 4]), [[1, 2], [2, 3], [2, 4]]),  # three ends: no cut, no merge
        (plain([1, 2, 3, 1]), [[1, 2, 3, 1]]),  # a closed way
        (plain([1, 2, 3, 2]), [[1, 2], [2, 3, 2]]),  # its end is its own inner node
        (plain([1, 2, 3, 2, 4]), [[1, 2], [2, 3, 2], [2, 4]]),  # passes a node twice
        (plain([1]), []),
        ({1: ([1, 2], None), 2: ([1, 2], {}), 3: ([3, 4], {"name": "x"})}, []),
        (plain([900, 1, 2, 3, 901], [4, 2, 5]), [[1, 2], [2, 3], [2, 5], [4, 2]]),  # ends without a position
    ],
)
def test_sections(spark, ways, sections):
    got, _, _ = build(spark, ways)
    assert [x[0] for x in pieces(got)] == sections


def test_uses_of_nodes(spark):
    _, found, _ = build(spark, plain([1, 2, 3, 1], [3, 5], [5, 6, 7], [6, 7, 6, 8]))
    got = {r.node_id: (list(r.terminating), list(r.intersecting)) for r in found.collect()}
    assert got == {1: ([1, 1], []), 3: ([2], [1]), 5: ([2, 3], []), 6: ([4], [3, 4]), 7: ([3], [4])}
    assert {r.node_id for r in network.splitting(found).collect()} == {3, 6, 7}
    assert {r.node_id for r in network.merging(found).collect()} == {1, 5}


CHAIN = plain([1, 2], [2, 3], [3, 4], [4, 5])
ONE_WAY = {"highway": "residential", "oneway": "yes"}


@pytest.mark.parametrize(
    "ways,sizes",
    [
        (CHAIN, [4]),
        (plain([1, 2], [2, 3], [3, 4], [4, 1]), [4]),  # a ring of joints
        (plain([1, 2, 3, 1]), [1]),  # a closed way does not merge with itself
        (plain([1, 2], [3, 2]), [1, 1]),  # drawn towards each other
        (plain([2, 1], [2, 3]), [1, 1]),
        (plain([1, 2], [3, 2], tags=ONE_WAY), [1, 1]),
        (plain([1, 2], [2, 3], tags=ONE_WAY), [2]),
        ({1: ([1, 2], ROAD), 2: ([2, 3], ONE_WAY)}, [1, 1]),
        ({1: ([1, 2], ROAD), 2: ([2, 3], {"highway": "primary_link"})}, [1, 1]),
        ({1: ([1, 2], ROAD), 2: ([2, 3], {"highway": "residential", "junction": "roundabout"})}, [1, 1]),
        ({1: ([1, 2], {"highway": "primary"}), 2: ([2, 3], {"highway": "secondary"})}, [2]),
    ],
)
def test_merging(spark, ways, sizes):
    _, _, merged = build(spark, ways)
    assert sorted(len(x) for x in pieces(merged)) == sizes


def test_merged_chains_run_through(spark):
    _, _, merged = build(spark, CHAIN)
    assert pieces(merged) == [[[1, 2], [2, 3], [3, 4], [4, 5]]]
    long = plain(*([k, k + 1] for k in range(60)))
    _, _, merged = build(spark, long)
    assert pieces(merged) == [[[k, k + 1] for k in range(60)]]


def test_last_meets_last(spark):
    """Two chains of unequal length that are drawn towards each other."""
    ways = plain([1, 2], [2, 3], [6, 5], [5, 4], [4, 3])
    for fix in (True, False):
        _, _, merged = build(spark, ways, fix=fix)
        total = sum(len(x) for x in pieces(merged))
        assert total == 5 if fix else total <= 5


def streets_of(spark, ways, places=None):
    _, _, merged = build(spark, ways, places)
    geometries = streets.segment_geometries(merged).cache()
    refs = streets.references(geometries).cache()
    return geometries, refs, streets.street_intersections(refs).cache()


def test_streets(spark):
    names = {1: ([1, 2], {**ROAD, "name": "A"}), 2: ([2, 3], {**ROAD, "name": "B"}), 3: ([3, 9], ONE_WAY), 4: ([3, 8], ROAD), 5: ([20, 20], ROAD)}
    geometries, refs, found = streets_of(spark, names)
    got = {tuple(s.way_id for s in r.metadata.way_sections): r for r in geometries.collect()}
    assert set(got) == {(1, 2), (3,), (4,)}
    merged = got[1, 2]
    assert merged.metadata.name is None and [s.name for s in merged.metadata.way_sections] == ["A", "B"] and merged.form_of_way == 3 and len(merged.points) == 3
    rows = refs.collect()
    assert sorted((r.seg_key, r.direction) for r in rows) == sorted((g.seg_key, d) for g in got.values() for d in (["forward"] if g.one_way else ["forward", "back"]))
    by_node = {r.node_id: r for r in found.collect()}
    assert set(by_node) == {1, 3, 8, 9} and (len(by_node[3].outbound), len(by_node[3].inbound)) == (3, 2) and (len(by_node[9].outbound), len(by_node[9].inbound)) == (0, 1)
    assert sum(len(r.inbound) + len(r.outbound) for r in by_node.values()) == 2 * len(rows)
    full = streets.street_geometries(geometries, refs).collect()
    assert all((r.back_reference_id is None) == r.one_way and r.forward_reference_id for r in full)
    assert streets.references(geometries, "even").count() == len(rows)


def test_mixed_classes_equal_lines_and_loops(spark):
    places = {**PLACES, 150: PLACES[1], 151: PLACES[2]}
    ways = {1: ([1, 2], {"highway": "primary"}), 2: ([2, 3], {"highway": "secondary"}), 3: ([150, 151], ROAD), 4: ([30, 31, 32, 30], ROAD)}
    geometries, refs, found = streets_of(spark, ways, places)
    mixed = geometries.where("size(metadata.way_sections) = 2").first()
    assert (mixed.road_class, mixed.form_of_way) == (8, 0)
    loop = [r for r in found.collect() if r.node_id == 30]
    assert [(len(r.outbound), len(r.inbound)) for r in loop] == [(4, 0)]
    twice = {1: ([1, 2], ROAD), 2: ([150, 151], ROAD)}
    geometries, refs, _ = streets_of(spark, twice, places)
    assert geometries.count() == 2 and streets.street_geometries(geometries).count() == 1 and refs.count() == 4


def test_files_and_messages(spark, tmp_path):
    geometries, refs, found = streets_of(spark, {**CHAIN, 9: ([3, 50], ONE_WAY)})
    full = streets.street_geometries(geometries, refs)
    records = tile_files.tile_records(full, refs, found).cache()
    manifest = tile_files.write_tiles(records, f"file://{tmp_path}/tiles").collect()
    assert {r.file.split(".")[1] for r in manifest} == {"geometry", "metadata", "reference", "intersection"}
    want = {(r.tile, r.type, r.level): sorted(bytes(x) for x in r.p) for r in records.groupBy("tile", "type", "level").agg(F.collect_list("payload").alias("p")).collect()}
    assert len(want) == len(manifest)
    for r in manifest:
        tile, kind, level, _ = r.file.split(".")
        data, out = (tmp_path / "tiles" / r.file).read_bytes(), []
        for _, message in protobuf.fields(b"".join(b"\x0a" + x for x in want[tile, kind, int(level)])):
            out.append(protobuf.delimited(message))
        assert len(data) == r.n_bytes == sum(map(len, out)) and all(x in data for x in out) and r.n_records == len(out)
    back = found.select("intersection_id", "node_id", "lon", "inbound", "outbound", protobuf.decode_intersection(protobuf.encode_intersection()).alias("m")).collect()
    assert all((r.m.id, r.m.node_id, r.m.lon, r.m.inbound, r.m.outbound) == (r.intersection_id, r.node_id, r.lon, r.inbound, r.outbound) for r in back)
    (one,) = geometries.where("one_way").select("geometry_id", "points").collect()
    row = full.where("one_way").select(protobuf.encode_geometry().alias("g"), protobuf.encode_metadata().alias("m")).first()
    message = dict(protobuf.fields(dict(protobuf.fields(b"\x0a" + bytes(row.g)))[1]))
    assert message[1].decode() == one.geometry_id and 5 not in message and struct.unpack("<4d", message[7]) == tuple(x for p in one.points for x in (p.lon, p.lat))
    osm = dict(protobuf.fields(dict(protobuf.fields(dict(protobuf.fields(b"\x0a" + bytes(row.m)))[1]))[2]))
    section = dict(protobuf.fields(osm[1]))
    assert (section[1], section[2], section[3]) == (9, 5, 1)


def test_json(spark, tmp_path):
    geometries, refs, found = streets_of(spark, CHAIN)
    full = streets.street_geometries(geometries, refs)
    for verbose, metadata in ((False, False), (True, True)):
        (row,) = json_tiles.tile_json(full, refs, found, verbose=verbose, metadata=metadata).collect()
        told = json.loads(row.json)
        assert set(told) == {"geometries", "references"} | ({"intersections"} if verbose else set())
        (geometry,) = told["geometries"].values()
        assert len(geometry["coordinates"]) == 5 and ("metadata" in geometry) == metadata and ("roadClass" in geometry) != metadata and ("startIntersectionId" in geometry) == verbose
        reference = next(iter(told["references"].values()))
        assert len(reference["locationReferences"]) == 2 and "inboundBearing" not in reference["locationReferences"][0]
    meta = json.loads(full.select(json_tiles.json_metadata()).first()[0])
    assert [s["wayId"] for s in meta["waySections"]] == [1, 2, 3, 4]
    (row,) = json_tiles.write_json(json_tiles.tile_json(full, refs, found), str(tmp_path / "json")).collect()
    (path,) = (tmp_path / "json").rglob("*.json")
    assert path.match(f"6/{row.tile}.json") and path.stat().st_size == row.n_bytes and set(json.loads(path.read_text())) == {"geometries", "references"}


def test_paths_of_files():
    assert filesystem("/a/b")[1] == "/a/b" and filesystem("file:///a/b")[1] == "/a/b"


def test_names_of_a_batch_are_those_of_rows(spark):
    """Texts of numbers (ties, signs, zeros, great and missing ones), tiles, ids of geometries and references."""
    import numpy as np
    import pyarrow as pa

    from waymesh.functions import names

    r = np.random.default_rng(5)
    x = np.concatenate([r.uniform(-180, 180, 3000), np.round(r.uniform(-1, 1, 3000), 6), r.integers(-400, 400, 3000) / 2 / 1e5, r.integers(-(10**6), 10**6, 3000) / 64, [0.0, -0.0, -1e-7, 1e-7, 1e9, -1e15, 123456.789, np.inf, -np.inf, np.nan]])
    want = [v.s for v in spark.createDataFrame([(float(v),) for v in x], "x double").select(F.format_string("%.5f", "x").alias("s")).collect()]
    assert names.five_decimals(x).to_pylist() == want
    lon, lat = r.uniform(-180, 180, 5000), r.uniform(-90, 90, 5000)
    places = spark.createDataFrame(list(zip(lon.tolist(), lat.tolist(), strict=True)), "lon double, lat double")
    for zoom in (0, 12, 22, 23):
        x, y = names.tile_xy(zoom, lon, lat)
        assert [v.t for v in places.select(tiles.tile_id(zoom, F.col("lon"), F.col("lat")).alias("t")).collect()] == [f"{zoom}-{a}-{b}" for a, b in zip(x, y, strict=True)]
    assert names.names_of_lines(pa.array([], pa.list_(pa.struct({"node_id": pa.int64(), "lat": pa.float64(), "lon": pa.float64()}))), pa.array([], pa.bool_()), pa.array([], pa.int32()), 12).to_pylist() == []


@pytest.mark.parametrize("mode", ["compat", "even"])
def test_names_are_those_of_records(spark, mode):
    """Lines of one to 60 nodes, some repeated, some in one place, some equal under two keys; the records with payload
    have the same names."""
    import random

    roll = random.Random(8)
    rows = []
    for k in range(400):
        step = roll.choice([0.0, 0.0001, 0.01, 0.2])
        nodes = [(j if roll.random() < 0.9 else j - 1, 50 + roll.random() * step, -0.2 + j * step) for j in range(1, 1 + roll.choice([1, 2, 2, 3, 5, 60]))]
        cut = roll.randrange(len(nodes)) if len(nodes) > 3 else 0
        parts = [nodes[: cut + 1], nodes[cut:]] if cut else [nodes]
        sections = [(k, 0, "a", False, False, False, roll.choice([3, 5]), p) for p in parts]
        for key in {f"{k:03}", f"{k - k % 7:03}x" if k % 7 == 0 else f"{k:03}"}:
            rows.append((roll.choice([4, 6]), key, k % 3 == 0, k % 11 == 0, k % 13 == 0, sections))
    of = "level int, seg_key string, one_way boolean, link boolean, roundabout boolean, sections array<struct<way_id: long, start_idx: int, name: string, one_way: boolean, roundabout: boolean, link: boolean, road_class: int, nodes: array<struct<node_id: long, lat: double, lon: double>>>>"
    merged = spark.createDataFrame(rows, of).cache()
    full = streets.measured(streets.segment_geometries(merged), mode).cache()
    refs = streets.references(full)
    want = tile_files.tile_records(streets.street_geometries(full), refs, streets.street_intersections(refs)).drop("payload").cache()
    got = tile_files.record_names(streets.named(merged, 12, mode).cache()).select(want.columns).cache()
    assert want.count() > 2000 and {r[0] for r in want.select("type").distinct().collect()} == set(tile_files.TYPES)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_bearings_that_are_not_there_cost_nothing(monkeypatch):
    """The first of two references has no inbound bearing, the last none onward; the inverse problem is not solved for them."""
    from waymesh.functions import geodesic, lines

    solved = []
    solve = geodesic.inverse
    monkeypatch.setattr(geodesic, "inverse", lambda *a: solved.append(len(a[0])) or solve(*a))
    found = lines.reference_of_lines([[0.0, 0.1], [0.0, 0.1]], [[10.0, 10.0], [20.0, 20.0]])
    assert sum(solved) == 2  # the leg of each line
    assert found.outbound.map(lambda x: x[1]).isna().all() and found.inbound.map(lambda x: x[0]).isna().all()


def test_names_are_made_once(spark):
    """The filter of short lines stays above the function: one pass in Python."""
    of = "level int, seg_key string, one_way boolean, link boolean, roundabout boolean, sections array<struct<way_id: long, start_idx: int, name: string, one_way: boolean, roundabout: boolean, link: boolean, road_class: int, nodes: array<struct<node_id: long, lat: double, lon: double>>>>"
    rows = streets.named(spark.createDataFrame([], of))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_batches_make_the_same_messages(spark):
    """Records of measured geometries in Arrow batches, to the byte those of tile_records; far-flung numbers too."""
    from waymesh.plans import catalog

    rows = catalog._measured(spark, "/root/testdata/sf0.001").where("level >= 4")
    odd = rows.limit(40).withColumns({"seg_key": F.concat("seg_key", F.lit("y")), "road_class": F.lit(0), "start_node": F.lit(-5).cast("long"), "end_node": F.lit(2**62), "points": F.transform("points", lambda p, i: F.struct((p["lon"] * 0 + i * 0.3).alias("lon"), (p["lat"] * 0).alias("lat")))})
    rows = checkpointed(streets.measured(rows.unionByName(odd).withColumn("geometry_id", F.when(F.col("seg_key").endswith("y"), F.md5("seg_key")).otherwise(F.col("geometry_id"))).drop("measured")))
    refs = streets.references(rows)
    want = tile_files.tile_records(streets.street_geometries(rows), refs, streets.street_intersections(refs)).cache()
    told = streets.measured_names(rows).cache()
    for kind, got in tile_files.street_records(told, streets.least_streets(told), 12, lambda tile: tile.isNotNull()).items():
        got, own = got.select(want.columns).cache(), want.where(F.col("type") == kind)
        assert own.count() > 200 and got.exceptAll(own).isEmpty() and own.exceptAll(got).isEmpty(), kind
