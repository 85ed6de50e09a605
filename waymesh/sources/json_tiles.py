"""Records as JSON, and JSON documents of tiles, by JVM expressions; a file for each tile."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.operators import streets
from waymesh.operators.durable import checkpointed
from waymesh.sources.files import write_whole


def _place(p: Column) -> Column:
    return F.array(p["lon"], p["lat"])


def json_geometry(verbose: bool = False, metadata: bool = False) -> Column:
    parts = []
    if verbose:
        parts += [F.col("start_intersection_id").alias("startIntersectionId"), F.col("end_intersection_id").alias("endIntersectionId"), F.col("forward_reference_id").alias("forwardReferenceId"), F.col("back_reference_id").alias("backReferenceId")]
    parts.append(metadata_struct().alias("metadata") if metadata else F.col("road_class").alias("roadClass"))
    return F.to_json(F.struct(*parts, F.transform("points", _place).alias("coordinates")))


def json_intersection() -> Column:
    some = lambda name: F.when(F.size(name) > 0, F.col(name))
    return F.to_json(F.struct(F.col("node_id").alias("osmNodeId"), some("outbound").alias("outboundSegmentIds"), some("inbound").alias("inboundSegmentIds"), F.array("lon", "lat").alias("point")))


def json_reference() -> Column:
    one = lambda p: F.struct(_place(p).alias("point"), p["outbound"].alias("outboundBearing"), F.round(p["distance"], 2).alias("distanceToNextRef"), p["inbound"].alias("inboundBearing"), p["intersection_id"].alias("intersectionId"))
    return F.to_json(F.struct(F.col("geometry_id").alias("geometryId"), F.col("form_of_way").alias("formOfWay"), F.transform("location_references", one).alias("locationReferences")))


def metadata_struct() -> Column:
    one = lambda s: F.struct(s["way_id"].alias("wayId"), s["road_class"].alias("roadClass"), s["one_way"].alias("oneWay"), s["roundabout"].alias("roundabout"), s["link"].alias("link"), s["node_ids"].alias("nodeIds"))
    return F.struct(F.col("geometry_id").alias("geometryId"), F.transform("metadata.way_sections", one).alias("waySections"))


def json_metadata() -> Column:
    return F.to_json(metadata_struct())


def tile_json(geometries: DataFrame, refs: DataFrame, found: DataFrame, zoom: int = 12, verbose: bool = False, metadata: bool = False) -> DataFrame:
    """level, tile, json: one document for each tile, with one record for each id (the least text, where references
    of parallel lines round to one id), ids in order. A tile's records are bounded by its area."""

    def part(tiled: DataFrame, kind: str, key: str, text: Column) -> DataFrame:
        return tiled.select("level", "tile", F.lit(kind).alias("kind"), F.col(key).alias("id"), F.concat(F.to_json(F.array(key)).substr(F.lit(2), F.length(F.to_json(F.array(key))) - 2), F.lit(":"), text).alias("entry"))

    every = part(streets.tiled_geometries(geometries, zoom), "geometries", "geometry_id", json_geometry(verbose, metadata))
    if verbose:
        every = every.unionByName(part(streets.tiled_intersections(found, zoom), "intersections", "intersection_id", json_intersection()))
    every = every.unionByName(part(streets.tiled_references(refs, zoom), "references", "reference_id", json_reference()))
    every = every.groupBy("level", "tile", "kind", "id").agg(F.min("entry").alias("entry"))
    kinds = every.groupBy("level", "tile", "kind").agg(F.array_join(F.array_sort(F.collect_list("entry")), ",\n").alias("entries"))
    block = F.concat(F.lit('"'), F.col("kind"), F.lit('": {'), F.col("entries"), F.lit("}"))
    tile = kinds.groupBy("level", "tile").agg(F.array_join(F.array_sort(F.collect_list(block)), ",").alias("blocks"))
    return tile.select("level", "tile", F.concat(F.lit("{"), F.col("blocks"), F.lit("}")).alias("json"))


def write_json(tiles: DataFrame, folder: str) -> DataFrame:
    """A file ``<level>/<z>-<x>-<y>.json`` for each tile, written whole; returns level, tile, file, n_bytes. The result
    is durable: reading it writes nothing again."""
    folder = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, tile, text = (c.to_pylist() for c in batch.columns)
            names = [f"{folder}/{a}/{b}.json" for a, b in zip(level, tile, strict=True)]
            sizes = [write_whole(name, [x.encode()]) for name, x in zip(names, text, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names), pa.array(sizes, pa.int64())], ["level", "tile", "file", "n_bytes"])

    return checkpointed(tiles.select("level", "tile", "json").mapInArrow(run, "level int, tile string, file string, n_bytes long"))
