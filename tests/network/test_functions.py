"""Column functions: attributes, ids, tiles, texts, geodesics."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymesh.functions import geodesic, ids, lines, tags, texts, tiles


def attributes(spark, rows):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, tags map<string,string>")
    t = F.col("tags")
    got = frame.select("i", tags.road_class(t), tags.is_one_way(t), tags.is_link(t), tags.is_roundabout(t), tags.way_name(t)).orderBy("i").collect()
    return [tuple(r)[1:] for r in got]


def test_attributes(spark):
    rows = [
        {"highway": "motorway"}, {"highway": " Motorway_Link ", "oneway": "no"}, {"highway": "services"}, {"highway": "service", "service": "parking_aisle"}, {"highway": "service", "service": "alley"},
        {"highway": "living_street", "name": "  A B "}, {"highway": "residential", "junction": "Roundabout"}, {"highway": "primary", "oneway": "-1"}, {"highway": "footway", "oneway": "TRUE"}, {}, None,
    ]
    assert attributes(spark, rows) == [
        (0, True, False, False, ""), (0, False, True, False, ""), (7, False, False, False, ""), (8, False, False, False, ""), (7, False, False, False, ""),
        (5, False, False, False, "A B"), (5, True, False, True, ""), (2, False, False, False, ""), (8, True, False, False, ""), (8, False, False, False, ""), (8, False, False, False, ""),
    ]


def test_ids_of_known_texts(spark):
    known = {
        "Intersection 110.000000 45.000000": "71f34691f182a467137b3d37265cb3b6",
        "Intersection -74.003388 40.634538": "103c2dbe16d28cdcdcd5e5e253eaa026",
        "Intersection -74.004107 40.634060": "0f346cb98b5d8f0500e167cb0a390266",
        "Intersection -74.009094 40.726002": "6f1c08066370129f2f429f3c20f9e151",
    }
    frame = spark.createDataFrame(list(known.items()), "t string, want string")
    assert frame.where(ids.content_id(F.col("t")) != F.col("want")).count() == 0
    back = frame.select(ids.id_text(ids.id_bytes(F.col("want"))).alias("x"), "want", ids.id_bytes(F.col("t")).alias("none")).collect()
    assert all(r.x == r.want and r.none is None for r in back)
    place = spark.sql("select -74.0090917D lon, 40.7260025D lat, 123L node")
    assert place.select(ids.intersection_id(F.col("lon"), F.col("lat"), F.col("node"))).first()[0] == "2456bffd0ffca31eaaeb81f627415e29"


def test_rounding(spark):
    rows = spark.sql("select explode(array(0.5D, 1.5D, -0.5D, -1.5D, 359.6D, 2.4D)) x").select(ids.round_half_up(F.col("x"))).collect()
    assert [r[0] for r in rows] == [1, 2, 0, -1, 360, 2]
    # Ties of the decimal digits go up, whatever the binary value.
    assert spark.sql("select format_string('%.5f', 1.000025D)").first()[0] == "1.00003"


def test_tiles(spark):
    places = [(12, -74.0090917, 40.7260025, "12-1205-1539"), (0, 10.0, 10.0, "0-0-0"), (1, -180.0, 90.0, "1-0-0"), (1, 180.0, -90.0, "1-1-1"), (24, 0.0, 0.0, "24-2097152-2097152")]
    for zoom, lon, lat, want in places:
        assert spark.createDataFrame([(lon, lat)], "lon double, lat double").select(tiles.tile_id(zoom, F.col("lon"), F.col("lat"))).first()[0] == want
    order = spark.createDataFrame([("2-0-1",), ("1-1-0",), ("1-1-1",), ("1-0-0",)], "t string").orderBy(*tiles.tile_order(F.col("t"))).collect()
    assert [r.t for r in order] == ["1-1-1", "1-1-0", "1-0-0", "2-0-1"]


def test_texts(spark):
    rows = [("a=1|b=x=y|skip||a=2", {"a": "2", "b": "x=y"}), ("", None), ("   ", None), (None, None), ("k=", {"k": ""})]
    frame = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    assert [r[0] for r in frame.select(texts.string_to_map(F.col("t"))).collect()] == [w for _, w in rows]
    maps = spark.createDataFrame([({"b": None, "a": "1"},), (None,), ({},)], "m map<string,string>")
    assert [r[0] for r in maps.select(texts.map_to_string(F.col("m"))).collect()] == ["a=1|b=", "", ""]
    data = [b"", b"\0\0\x01", b"hello world", bytes(range(256))]
    coded = spark.createDataFrame([(d,) for d in data], "d binary").select(texts.base58(F.col("d")).alias("t"), "d")
    got = coded.select("t", texts.base58_bytes("t").alias("back")).collect()
    assert [bytes(r.back) for r in got] == data and got[1].t == "112" and got[2].t == "StV1DL6CwTryKyV"
    with pytest.raises(Exception, match="Base58"):
        spark.createDataFrame([("0",)], "t string").select(texts.base58_bytes("t")).collect()


def test_geodesics_of_known_places():
    length, _, azimuth = geodesic.inverse(-73.8, 40.6, -0.5, 51.6)
    assert length == pytest.approx(5551759.400319, abs=1e-4) and azimuth == pytest.approx(107.82177674, abs=1e-6)
    length, first, _ = geodesic.inverse(0, 0, 179.5, 0.5)
    assert length == pytest.approx(19936288.578965, abs=1e-3) and first == pytest.approx(25.67187286829, abs=1e-6)
    assert [float(x) for x in geodesic.inverse(5, 45, 5, 45)] == [0, 180, 180] and [float(x) for x in geodesic.inverse(5, -45, 5, -45)] == [0, 0, 0]


def test_direct_and_inverse_agree():
    rng = np.random.default_rng(1)
    lon, lat, azimuth, length = rng.uniform(-180, 180, 500), rng.uniform(-89, 89, 500), rng.uniform(-180, 180, 500), rng.uniform(1, 1.9e7, 500)
    lon2, lat2, last = geodesic.direct(lon, lat, azimuth, length)
    got = geodesic.inverse(lon, lat, lon2, lat2)
    assert np.abs(got[0] - length).max() < 1e-6
    for a, b in ((got[1], azimuth), (got[2], last)):
        assert np.abs((a - b + 180) % 360 - 180).max() < 1e-7


def test_points_azimuths_and_feet_on_lines():
    lon, lat = np.array([0.0, 0.01, 0.01]), np.array([0.0, 0.0, 0.01])
    assert geodesic.point_at(lon, lat, 0) == (0, 0) and geodesic.point_at(lon, lat, 1) == (0.01, 0.01)
    x, y = geodesic.point_at(lon, lat, 0.75)
    assert x == pytest.approx(0.01, abs=1e-9) and 0.004 < y < 0.006
    assert geodesic.azimuth_at(lon, lat, 0.1) == pytest.approx(90, abs=1e-3) and geodesic.azimuth_at(lon, lat, 0.9) == pytest.approx(0, abs=1e-6)
    assert np.isnan(geodesic.azimuth_at(np.zeros(2), np.zeros(2), 0.5)) and geodesic.point_at(np.zeros(2), np.zeros(2), 0.5) is None
    assert geodesic.fraction_on(0, 0, 1, 0, 0.25, 0.1) == pytest.approx(0.25, abs=1e-6)
    assert geodesic.fraction_on(0, 0, 1, 0, -0.25, 0.1) == pytest.approx(-0.25, abs=1e-6) and geodesic.fraction_on(3, 3, 3, 3, 1, 1) == 0
    assert geodesic.fraction_of_line(lon, lat, 0.02, 0.005) == pytest.approx(0.75, abs=0.01)
    assert geodesic.crossing((0, 0), (1, 1), (0, 1), (1, 0))[0] == pytest.approx(0.5)
    box = geodesic.envelope(10, 50, 1000)
    assert box[0] < 10 < box[2] and float(geodesic.inverse(10, 50, 10, box[3])[0]) == pytest.approx(1000)


def test_functions_of_columns(spark):
    row = spark.sql("select 0D a, 0D b, 1D c, 1D d, array(0D, 0.01D) x, array(0D, 0D) y")
    a, b, c, d, x, y = map(F.col, "abcdxy")
    got = row.select(
        lines.geodesic_distance(a, b, c, d).alias("m"), lines.line_length(x, y).alias("l"), lines.azimuth(a, b, c, b, F.lit(1.0)).alias("z"), lines.line_azimuth(x, y, F.lit(0.5)).alias("lz"),
        lines.line_point(x, y, F.lit(0.5)).alias("p"), lines.intercept(a, b, c, b, F.lit(0.5), F.lit(0.1)).alias("i"), lines.line_intercept(x, y, F.lit(0.005), F.lit(1.0)).alias("li"),
        lines.intersect(a, b, c, d, a, d, c, b).alias("cross"), lines.envelope(a, b, F.lit(10.0)).alias("box"), lines.interpolate(a, b, c, b, F.lit(0.5)).alias("mid"),
    ).first()
    assert got.m == pytest.approx(156899.568, abs=0.01) and got.l == pytest.approx(1113.195, abs=0.01) and got.z == pytest.approx(90) and got.lz == pytest.approx(90)
    assert got.p.lon == pytest.approx(0.005) and got.i == pytest.approx(0.5) and got.li == pytest.approx(0.5, abs=1e-6) and got.cross.lon == pytest.approx(0.5) and got.mid.lon == pytest.approx(0.5)
    v = spark.sql("select named_struct('x', 1D, 'y', 2D, 'z', 3D) a, named_struct('x', 4D, 'y', 5D, 'z', 6D) b")
    got = v.select(lines.vector_dot(a, b), lines.vector_cross(a, b), lines.vector_add(a, b), lines.vector_multiply(a, F.lit(2.0))).first()
    assert got[0] == 32 and tuple(got[1]) == (-3, 6, -3) and tuple(got[2]) == (5, 7, 9) and tuple(got[3]) == (2, 4, 6)


def test_reference_measures_of_lines():
    """Numbers of references by length, and where they stand."""
    rnd, east = random.Random(1), lambda metres: float(geodesic.direct(0, 0, 90, metres)[0])
    for metres, n in ((15, 2), (16_000, 2), (31_000, 3), (61_000, 5)):
        got = lines.reference_of_lines([[0.0, east(metres * rnd.random()), east(metres)]], [[0.0, 0.0, 0.0]]).iloc[0]
        assert len(got.lons) == n and got.lons[0] == 0 and all(x == pytest.approx(east(metres)) for x in got.lons[1:])
        assert got.outbound[-1] is None and got.inbound[0] is None and got.outbound[0] == pytest.approx(90) and got.inbound[-1] == pytest.approx(90)
        assert got.distance == pytest.approx(metres / (n - 1), rel=1e-6)
        even = lines.reference_of_lines([[0.0, east(metres)]], [[0.0, 0.0]], even=True).iloc[0]
        assert even.lons == pytest.approx([east(metres) * k / (n - 1) for k in range(n)], abs=1e-9)


def test_control_characters_around_tags(spark):
    rows = [{"highway": "\tprimary\n", "oneway": "yes\n", "junction": "roundabout\t", "name": "\x01 A\r"}, {"highway": "\x00primary_link\x1f"}]
    assert attributes(spark, rows) == [(2, True, False, True, "A"), (2, False, True, False, "")]


@pytest.mark.parametrize("shift", [0.0, 100.0, 180.0, -180.0])
def test_feet_and_crossings_at_any_longitude(shift):
    """What holds at longitude 0 holds everywhere, also across 180 degrees."""
    at = lambda x: float(np.remainder(x + shift + 180, 360) - 180)
    assert geodesic.fraction_on(at(-0.1), 0, at(0.1), 0, at(-0.05), 0.05) == pytest.approx(0.25, abs=1e-9)
    x, y = geodesic.crossing((at(-1.0), -1.0), (at(1.0), 1.0), (at(-1.0), 1.0), (at(1.0), -1.0))
    assert (x - at(0.0) + 180) % 360 - 180 == pytest.approx(0, abs=1e-9) and y == pytest.approx(0, abs=1e-9)
    line = lines.Lines.of([[at(-0.2), at(-0.1), at(0.3)]], [[0.0, 0.0, 0.0]])
    assert lines.fractions_of_lines(line, np.array([at(0.05)]), np.array([0.2]))[0] == pytest.approx(0.5, abs=1e-9)


def test_vectors_of_lines_against_single_ones():
    rng = np.random.default_rng(4)
    lons = [np.cumsum(rng.normal(0, 0.02, n)) - 74 for n in (2, 5, 1, 9, 3)]
    lats = [np.cumsum(rng.normal(0, 0.02, len(x))) + 40 for x in lons]
    every = lines.Lines.of(lons, lats)
    for f in (0.0, 0.3, 0.77, 1.0):
        lon, lat, azimuth, _ = every.points(np.arange(5), np.full(5, f))
        for k, (x, y) in enumerate(zip(lons, lats)):
            if len(x) > 1:
                assert (lon[k], lat[k]) == pytest.approx(geodesic.point_at(x, y, f), abs=1e-10)
                assert (azimuth[k] - geodesic.azimuth_at(x, y, f) + 180) % 360 - 180 == pytest.approx(0, abs=1e-7)
    px, py = rng.normal(-74, 0.05, 5), rng.normal(40, 0.05, 5)
    got = lines.fractions_of_lines(every, px, py)
    assert got == pytest.approx([geodesic.fraction_of_line(x, y, p, q) if len(x) > 1 else 0.0 for x, y, p, q in zip(lons, lats, px, py)], abs=1e-9)


def test_both_directions_at_once():
    """The way back equals the way there of the turned line; one-way lines have none."""
    rng = np.random.default_rng(5)
    lons = [(np.cumsum(rng.normal(0, s, n)) - 74).tolist() for n, s in ((2, 0.3), (5, 0.0001), (4, 0.05), (6, 0.4))]
    lats = [(np.cumsum(rng.normal(0, s, len(x))) + 40).tolist() for x, s in zip(lons, (0.3, 0.0001, 0.05, 0.4))]
    one_way = [False, False, True, False]
    for even in (False, True):
        got = lines.references_of_lines(pa.array(lons), pa.array(lats), pa.array(one_way), even).to_pylist()
        back = lines.reference_of_lines([x[::-1] for x in lons], [y[::-1] for y in lats], even).to_dict("records")
        for k, row in enumerate(got):
            assert (row["back"] is None) == one_way[k]
            if row["back"] is not None:
                for name in ("lons", "lats", "inbound", "outbound"):
                    assert [x is None for x in row["back"][name]] == [x is None for x in back[k][name]]
                    assert [x or 0 for x in row["back"][name]] == pytest.approx([x or 0 for x in back[k][name]], abs=1e-6)
                assert row["back"]["distance"] == pytest.approx(back[k]["distance"])
    empty = lines.references_of_lines(pa.array([], pa.list_(pa.float64())), pa.array([], pa.list_(pa.float64())), pa.array([], pa.bool_()))
    assert len(empty) == 0


def test_base58_against_whole_numbers(spark):
    rnd = random.Random(6)
    data = [rnd.randbytes(n) for n in (0, 1, 2, 3, 16, 16, 17, 31, 64) for _ in range(5)] + [b"\0" * 16, b"\0\0" + rnd.randbytes(14), b"\xff" * 16, None]
    def plain(x):
        n, out = int.from_bytes(x, "big"), ""
        while n:
            n, r = divmod(n, 58)
            out = texts.BASE58[r] + out
        return "1" * (len(x) - len(x.lstrip(b"\0"))) + out
    coded = spark.createDataFrame([(i, d) for i, d in enumerate(data)], "i int, d binary").select("i", texts.base58(F.col("d")).alias("t"))
    got = coded.select("i", "t", texts.base58_bytes("t").alias("back")).orderBy("i").collect()
    assert [r.t for r in got] == [None if d is None else plain(d) for d in data]
    assert [None if r.back is None else bytes(r.back) for r in got] == data


def test_polylines_as_text(spark):
    import base64
    import struct

    points = [(-74.0, 40.5), (-74.001, 40.25), (1.5, -2.0)]
    raw = struct.pack("<i4d3i", 3, -74.001, -2.0, 1.5, 40.5, 1, 3, 0) + b"".join(struct.pack("<2d", *p) for p in points)
    frame = spark.createDataFrame([([{"lon": x, "lat": y} for x, y in points], base64.b64encode(raw).decode()), (None, None)], "p array<struct<lon:double,lat:double>>, t string")
    rows = frame.select(texts.polyline_from_ascii(F.col("t")).alias("q")).collect()
    assert list(zip(rows[0].q.lons, rows[0].q.lats)) == points and rows[1].q.lons is None
    assert bytes(frame.where("p is not null").select(texts.polyline_shape(F.col("p"))).first()[0]) == raw
    with pytest.raises(Exception, match="shape"):
        spark.createDataFrame([(base64.b64encode(raw[:60]).decode(),), ("AAAA",)], "t string").select(texts.polyline_from_ascii(F.col("t"))).collect()
