"""From a map extract to tile files: ``python -m waymesh.plans.build --input map.osm.pbf --output tiles``."""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import DataFrame, SparkSession

from waymesh.functions.tags import LEVELS
from waymesh.operators import network, segments, streets
from waymesh.operators.durable import checkpointed
from waymesh.sources import tile_files
from waymesh.sources.osmpbf import OsmPbf


def build(spark: SparkSession, source: str, folder: str, zoom: int = 12, levels: tuple[int, ...] = LEVELS, lpr_mode: str = "compat", fix_last_last: bool = True) -> DataFrame:
    """Write the tiles of an extract; returns the manifest of files. The output folder must not exist."""
    if not source.endswith(".pbf"):
        raise ValueError(f"not a .pbf file: {source}")
    if "://" not in source and not os.path.exists(source):
        raise FileNotFoundError(source)
    if "://" not in folder and os.path.exists(folder):
        raise FileExistsError(folder)
    spark.dataSource.register(OsmPbf)
    read = lambda kind: spark.read.format("osmpbf").option("kind", kind).load(source)
    way_counter, every_way = network.counted(read("way"), "ways")
    node_counter, every_node = network.counted(read("node"), "nodes")
    ways = checkpointed(network.highway_ways(every_way))
    links = network.way_node_links(ways)
    points = network.way_points(links, checkpointed(network.node_positions(every_node)))
    logging.getLogger(__name__).info("ways %s, nodes %s", way_counter.get["ways"], node_counter.get["nodes"])
    kept = checkpointed(network.ways_at_level(ways, network.way_nodes(points), levels))
    found = checkpointed(network.intersections(network.filtered_links(links, kept)))
    cuts = network.grouped_split_points(network.way_split_points(network.splitting(found)))
    first = segments.initial_segments(network.way_sections(kept, cuts))
    merged = segments.merged_segments(first, network.merging(found), checkpointed, fix_last_last=fix_last_last)
    geometries = checkpointed(streets.segment_geometries(merged))
    refs = checkpointed(streets.references(geometries, lpr_mode))
    records = tile_files.tile_records(streets.street_geometries(geometries, refs), refs, streets.street_intersections(refs), zoom)
    return tile_files.write_tiles(records, folder)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--zlevel", type=int, default=12)
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("waymesh").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    build(spark, given.input, given.output, given.zlevel).agg({"n_records": "sum"}).show()


if __name__ == "__main__":
    main()
