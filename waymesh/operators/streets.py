"""Segments as streets: geometries, directed references, intersections, and the tiles they belong to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.functions import ids, lines, names, tiles
from waymesh.functions.tags import FORMS_OF_WAY, ROAD_CLASSES


def polyline(sections: Column) -> Column:
    """The nodes of all sections, without those that repeat the node before them."""
    every = F.flatten(F.transform(sections, lambda s: s["nodes"]))
    return F.filter(every, lambda p, i: (i == 0) | (p["node_id"] != F.get(every, i - 1)["node_id"]))


def classes(sections: Column) -> Column:
    return F.transform(sections, lambda s: s["road_class"])


def common_class(sections: Column) -> Column:
    """The class of all sections, Other where they differ."""
    return F.when(F.size(F.array_distinct(classes(sections))) == 1, F.get(classes(sections), F.lit(0))).otherwise(ROAD_CLASSES["Other"])


def leading_class(sections: Column) -> Column:
    """The least class before the first section of a higher one."""
    start = F.struct(F.get(classes(sections), F.lit(0)).alias("c"), F.lit(True).alias("go"))

    def step(acc: Column, c: Column) -> Column:
        go = acc["go"] & (c <= acc["c"])
        return F.struct(F.when(go, c).otherwise(acc["c"]).alias("c"), go.alias("go"))

    return F.aggregate(classes(sections), start, step)["c"]


def way_ids(sections: Column) -> Column:
    return F.transform(sections, lambda s: s["way_id"])


def contains_way(sections: Column, way_id: Column) -> Column:
    return F.array_contains(way_ids(sections), way_id)


def form_of_way(sections: Column, one_way: Column, link: Column, roundabout: Column) -> Column:
    c, f = common_class(sections), FORMS_OF_WAY
    mixed = F.size(F.array_distinct(classes(sections))) > 1
    return (
        F.when(link, f["SlipRoad"])
        .when(roundabout, f["Roundabout"])
        .when(mixed, f["Undefined"])
        .when(c == ROAD_CLASSES["Motorway"], f["Motorway"])
        .when(c.isin(ROAD_CLASSES["Trunk"], ROAD_CLASSES["Primary"]) & one_way, f["MultipleCarriageway"])
        .when((c >= ROAD_CLASSES["Trunk"]) & (c <= ROAD_CLASSES["Unclassified"]), f["SingleCarriageway"])
        .otherwise(f["Other"])
    )


def osm_metadata(sections: Column) -> Column:
    """Name on top where all sections share it; else a name on each section."""
    names = F.transform(sections, lambda s: s["name"])
    mixed = F.exists(names, lambda n: n != F.get(names, F.lit(0)))
    one = lambda s: F.struct(s["way_id"].alias("way_id"), s["road_class"].alias("road_class"), s["one_way"].alias("one_way"), s["roundabout"].alias("roundabout"), s["link"].alias("link"), F.transform(s["nodes"], lambda p: p["node_id"]).alias("node_ids"), F.when(mixed, s["name"]).alias("name"))
    return F.struct(F.when(~mixed, F.get(names, F.lit(0))).alias("name"), F.transform(sections, one).alias("way_sections"))


def segment_geometries(segments: DataFrame) -> DataFrame:
    """Segments of at least two distinct points with geometry id, classes and metadata. Column expressions only."""
    rows = segments.withColumn("line", polyline(F.col("sections"))).where(F.size("line") >= 2)
    rows = rows.withColumn("points", F.transform("line", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))))
    s = F.col("sections")
    return rows.select(
        "level", "seg_key", "one_way", "link", "roundabout", "points", ids.geometry_id(F.col("points")).alias("geometry_id"), common_class(s).alias("road_class"),
        form_of_way(s, F.col("one_way"), F.col("link"), F.col("roundabout")).alias("form_of_way"), osm_metadata(s).alias("metadata"),
        F.get("line", F.lit(0))["node_id"].alias("start_node"), F.element_at("line", -1)["node_id"].alias("end_node"),
    )


def named(segments: DataFrame, zoom: int = 12, lpr_mode: str = "compat") -> DataFrame:
    """Of segments of at least two distinct points only what names their records: ids of geometry and references (as
    bytes), their tiles, and both ends. A narrow row a segment, of one pass over its nodes."""
    s = F.col("sections")
    form = form_of_way(s, F.col("one_way"), F.col("link"), F.col("roundabout"))
    told = names.street_names(zoom, {"compat": False, "even": True}[lpr_mode])(F.flatten(F.transform(s, lambda x: x["nodes"])), F.col("one_way"), form)
    return segments.select("level", "seg_key", told.alias("n")).select("level", "seg_key", "n.*").where("size >= 2").drop("size")


def named_intersections(rows: DataFrame) -> DataFrame:
    """level, intersection_id, lon, lat of rows of ``named``: those of ``street_intersections``. An id is made once for
    each node, not for each use."""
    end = lambda which: F.struct(*(F.col(f"{which}_{k}").alias(a) for k, a in (("node", "node_id"), ("lon", "lon"), ("lat", "lat"))))
    places = rows.select("level", F.explode(F.array(end("start"), end("end"))).alias("p")).select("level", "p.*").distinct()
    found = places.select("level", ids.id_bytes(ids.intersection_id(F.col("lon"), F.col("lat"), F.col("node_id"))).alias("id"), "lon", "lat")
    return found.groupBy("level", "id").agg(F.min("lon").alias("lon"), F.min("lat").alias("lat")).select("level", ids.id_text(F.col("id")).alias("intersection_id"), "lon", "lat")


def _lprs(measured: Column, start: Column, end: Column) -> Column:
    """An array of location references; only the outer ones have an intersection."""
    n = F.size(measured["lons"])

    def one(lon: Column, i: Column) -> Column:
        lat = F.get(measured["lats"], i)
        node = F.when(i == 0, start).when(i == n - 1, end)
        return F.struct((i + 1).alias("sequence"), lon.alias("lon"), lat.alias("lat"), F.get(measured["inbound"], i).alias("inbound"), F.get(measured["outbound"], i).alias("outbound"), F.when(i < n - 1, measured["distance"]).alias("distance"), node.alias("node_id"), F.when(node.isNotNull(), ids.intersection_id(lon, lat, node)).alias("intersection_id"))

    return F.transform(measured["lons"], one)


def measured(geometries: DataFrame, lpr_mode: str = "compat") -> DataFrame:
    """With ``measured``: places, bearings and distances of the references of a geometry, of which all else follows."""
    measure = {"compat": lines.linear_reference, "even": lines.linear_reference_even}[lpr_mode]
    lon, lat = F.transform("points", lambda p: p["lon"]), F.transform("points", lambda p: p["lat"])
    return geometries.withColumn("measured", measure(lon, lat, F.col("one_way")))


def _directions() -> tuple[Column, Column]:
    return _lprs(F.col("measured.forward"), F.col("start_node"), F.col("end_node")), _lprs(F.col("measured.back"), F.col("end_node"), F.col("start_node"))


def measured_names(geometries: DataFrame, zoom: int = 12) -> DataFrame:
    """Measured geometries with their tiles, and ids (as bytes) and tiles of their references."""
    told = names.measured_names(zoom)(F.col("points"), F.col("form_of_way"), F.col("measured"))
    return geometries.withColumn("n", told).select("*", "n.*").drop("n")


def _named_ends() -> tuple[Column, Column]:
    """Structs of the first and last place of a measured geometry."""
    at = lambda p, node: F.struct(ids.intersection_id(p["lon"], p["lat"], F.col(node)).alias("intersection_id"), F.col(node).alias("node_id"), p["lon"].alias("lon"), p["lat"].alias("lat"))
    return at(F.get("points", F.lit(0)), "start_node"), at(F.element_at("points", -1), "end_node")


def outer_references(rows: DataFrame) -> DataFrame:
    """level, reference_id, location_references of rows of ``measured_names``; the first and the last place only, which is
    what intersections need."""
    start, end = _named_ends()
    rows = rows.select("level", "forward", "back", start.alias("a"), end.alias("z"))
    one = lambda way, a, z: F.struct(F.col(way).alias("id"), F.array(a, z).alias("location_references"))
    each = rows.select("level", F.explode(F.array(one("forward", "a", "z"), one("back", "z", "a"))).alias("r")).where("r.id is not null")
    return each.select("level", ids.id_text(F.col("r.id")).alias("reference_id"), "r.location_references")


def references(geometries: DataFrame, lpr_mode: str = "compat") -> DataFrame:
    """One row forward and, unless one-way, one row back: level, seg_key, geometry_id, direction, form_of_way,
    location_references, reference_id, length. Geometries may be measured already."""
    rows = geometries if "measured" in geometries.columns else measured(geometries, lpr_mode)
    forward, back = (F.struct(F.lit(name).alias("direction"), lprs.alias("lprs")) for name, lprs in zip(("forward", "back"), _directions(), strict=True))
    each = F.when(F.col("one_way"), F.array(forward)).otherwise(F.array(forward, back))
    rows = rows.select("level", "seg_key", "geometry_id", "form_of_way", F.col("measured.length").alias("length"), F.explode(each).alias("r"))
    rows = rows.select("level", "seg_key", "geometry_id", "form_of_way", "length", F.col("r.direction").alias("direction"), F.col("r.lprs").alias("location_references"))
    return rows.withColumn("reference_id", ids.reference_id(F.col("form_of_way"), F.col("location_references")))


def street_intersections(refs: DataFrame) -> DataFrame:
    """level, intersection_id, node_id, lon, lat, inbound, outbound: reference ids, sorted, repeats kept. A
    reference that starts and ends in one place counts twice as outbound there."""
    first, last = F.get("location_references", F.lit(0)), F.element_at("location_references", -1)
    loop = first["intersection_id"] == last["intersection_id"]
    row = lambda p, out: F.struct(p["intersection_id"].alias("intersection_id"), p["node_id"].alias("node_id"), p["lon"].alias("lon"), p["lat"].alias("lat"), out.alias("out"))
    rows = refs.select("level", ids.id_bytes(F.col("reference_id")).alias("reference"), F.explode(F.array(row(first, F.lit(True)), row(last, loop))).alias("p"))
    # Ids travel as bytes, one row a use; lists are made where all rows of an intersection are, not before.
    rows = rows.select("level", ids.id_bytes(F.col("p.intersection_id")).alias("id"), "p.node_id", "p.lon", "p.lat", "p.out", "reference").repartition("level", "id")
    listed = lambda held: F.transform(F.array_sort(F.collect_list(F.when(held, F.col("reference")))), ids.id_text)
    return rows.groupBy("level", "id").agg(
        F.min("node_id").alias("node_id"), F.min("lon").alias("lon"), F.min("lat").alias("lat"), listed(~F.col("out")).alias("inbound"), listed(F.col("out")).alias("outbound"),
    ).select("level", ids.id_text(F.col("id")).alias("intersection_id"), "node_id", "lon", "lat", "inbound", "outbound")


def least_streets(geometries: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """One row for each geometry id, that of the least segment."""
    # Ids that come once need no comparison, so the rows of streets meet a short list only.
    told = geometries.select("level", ids.id_bytes(F.col("geometry_id")).alias("id"), "seg_key")
    least = keep(told.groupBy("level", "id").agg(F.min("seg_key").alias("least"), F.count("*").alias("n")).where("n > 1").select("level", ids.id_text(F.col("id")).alias("geometry_id"), "least"))
    return geometries.join(least, ["level", "geometry_id"], "left").where("least is null or least = seg_key").drop("least")


def street_geometries(geometries: DataFrame, refs: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """One row for each geometry id, that of the least segment; with its references' ids where they are given or the
    geometries are measured. ``keep`` makes the list of repeated ids durable: then it has a known size."""
    geometries = least_streets(geometries, keep)
    if refs is not None:
        by = refs.groupBy("level", "seg_key").agg(*(F.max(F.when(F.col("direction") == d, F.col("reference_id"))).alias(f"{d}_reference_id") for d in ("forward", "back")), F.first("length").alias("length"))
        geometries = geometries.join(by, ["level", "seg_key"])
    elif "measured" in geometries.columns:
        forward, back = (ids.reference_id(F.col("form_of_way"), lprs) for lprs in _directions())
        told = {"forward_reference_id": forward, "back_reference_id": F.when(~F.col("one_way"), back), "length": F.col("measured.length")}
        geometries = geometries.withColumns(told).drop("measured")
    ends = {"start_intersection_id": (F.get("points", F.lit(0)), "start_node"), "end_intersection_id": (F.element_at("points", -1), "end_node")}
    return geometries.withColumns({name: ids.intersection_id(p["lon"], p["lat"], F.col(node)) for name, (p, node) in ends.items()})


def tiles_of(points: Column, zoom: int) -> Column:
    return F.array_distinct(F.transform(points, lambda p: tiles.tile_id(zoom, p["lon"], p["lat"])))


def tiled_geometries(geometries: DataFrame, zoom: int = 12) -> DataFrame:
    """A row for each tile that a vertex lies in."""
    return geometries.select(F.explode(tiles_of(F.col("points"), zoom)).alias("tile"), "*")


def tiled_references(refs: DataFrame, zoom: int = 12) -> DataFrame:
    return refs.select(F.explode(tiles_of(F.col("location_references"), zoom)).alias("tile"), "*")


def tiled_intersections(found: DataFrame, zoom: int = 12) -> DataFrame:
    return found.select(tiles.tile_id(zoom, F.col("lon"), F.col("lat")).alias("tile"), "*")
