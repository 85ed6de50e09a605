"""From raw ways and nodes to sections between intersections.

Every operator takes and gives DataFrames; levels are a column, so one pass serves all of them. Joins are
plain equi-joins whose strategy is left to the planner. ``ord`` and ``terminal`` count all references of a
way, resolved or not; geometry uses resolved nodes only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from waymesh.functions import tags as T


def counted(entities: DataFrame, name: str) -> tuple[Observation, DataFrame]:
    """A counter of entities and the frame that feeds it: ``counter.get[name]`` once an action has run over it."""
    counter = Observation(name)
    return counter, entities.observe(counter, F.count(F.lit(1)).alias(name))


def highway_ways(ways: DataFrame) -> DataFrame:
    return ways.where(T.is_highway(F.col("tags")))


def node_positions(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("id").alias("node_id"), "lat", "lon")


def way_node_links(ways: DataFrame) -> DataFrame:
    """way_id, node_id, ord, terminal: a row for each reference."""
    rows = ways.select(F.col("id").alias("way_id"), F.size("refs").alias("n"), F.posexplode("refs").alias("ord", "node_id"))
    return rows.select("way_id", "node_id", "ord", ((F.col("ord") == 0) | (F.col("ord") == F.col("n") - 1)).alias("terminal"))


def way_points(links: DataFrame, positions: DataFrame) -> DataFrame:
    """Links with the position of their node; unresolved references drop out."""
    return links.join(positions, "node_id").select("way_id", "node_id", "ord", "terminal", "lat", "lon")


def way_nodes(points: DataFrame) -> DataFrame:
    """way_id, nodes: the resolved nodes of each way in order."""
    held = F.array_sort(F.collect_list(F.struct("ord", "node_id", "lat", "lon")))
    node = lambda p: F.struct(p["node_id"].alias("node_id"), p["lat"].alias("lat"), p["lon"].alias("lon"))
    return points.groupBy("way_id").agg(held.alias("held")).select("way_id", F.transform("held", node).alias("nodes"))


def way_attributes(ways: DataFrame) -> DataFrame:
    """way_id, name, one_way, roundabout, link, road_class of ways with tags."""
    t = F.col("tags")
    return ways.where(F.size("tags") > 0).select(F.col("id").alias("way_id"), T.way_name(t).alias("name"), T.is_one_way(t).alias("one_way"), T.is_roundabout(t).alias("roundabout"), T.is_link(t).alias("link"), T.road_class(t).alias("road_class"))


def ways_at_level(ways: DataFrame, ordered: DataFrame, levels: Sequence[int] = T.LEVELS) -> DataFrame:
    """Ways with at least two resolved nodes, once for each level that their class belongs to."""
    known = way_attributes(ways).where(F.col("road_class") <= max(levels))
    rows = known.join(ordered.where(F.size("nodes") >= 2), "way_id")
    fitting = F.filter(F.array(*map(F.lit, levels)), lambda x: x >= F.col("road_class"))
    return rows.select(F.explode(fitting).alias("level"), "*")


def filtered_links(links: DataFrame, kept: DataFrame) -> DataFrame:
    """The links of kept ways, once for each level."""
    return links.join(kept.select("level", "way_id"), "way_id").select("level", "way_id", "node_id", "ord", "terminal")


def intersections(links: DataFrame) -> DataFrame:
    """level, node_id, terminating, intersecting: nodes with more than one use. A closed way ends twice in its node."""
    ends, passes = F.when(F.col("terminal"), F.col("way_id")), F.when(~F.col("terminal"), F.col("way_id"))
    rows = links.groupBy("level", "node_id").agg(F.array_sort(F.collect_list(ends)).alias("terminating"), F.array_sort(F.collect_list(passes)).alias("intersecting"))
    return rows.where(F.size("terminating") + F.size("intersecting") > 1)


def splitting(found: DataFrame) -> DataFrame:
    """Nodes at which ways are cut."""
    passing = F.size("intersecting")
    return found.where((passing > 1) | ((F.size("terminating") > 0) & (passing == 1)))


def merging(found: DataFrame) -> DataFrame:
    """Nodes at which exactly two ends meet and nothing passes."""
    return found.where((F.size("terminating") == 2) & (F.size("intersecting") == 0))


def way_split_points(split: DataFrame) -> DataFrame:
    return split.select("level", F.explode("intersecting").alias("way_id"), "node_id")


def grouped_split_points(points: DataFrame) -> DataFrame:
    return points.groupBy("level", "way_id").agg(F.array_sort(F.collect_set("node_id")).alias("split"))


def way_sections(kept: DataFrame, grouped: DataFrame) -> DataFrame:
    """Kept ways cut at their split points; neighbouring sections share the node. ``start_idx`` is the
    section's first place in the way."""
    n = F.size("nodes")
    inner = F.when(n > 2, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    at = lambda i: F.get("nodes", i)["node_id"]
    cuts = F.when(F.col("split").isNull(), F.array().cast("array<int>")).otherwise(F.filter(inner, lambda i: F.array_contains("split", at(i))))
    rows = kept.join(grouped, ["level", "way_id"], "left").withColumn("borders", F.concat(F.array(F.lit(0)), cuts, F.array(n - 1)))
    piece = lambda a, i: F.struct(a.alias("start_idx"), F.slice("nodes", a + 1, F.get("borders", i + 1) - a + 1).alias("part"))
    pieces = F.transform(F.slice("borders", 1, F.size("borders") - 1), piece)
    rows = rows.withColumn("piece", F.explode(pieces))
    return rows.select("level", "way_id", F.col("piece.start_idx").alias("start_idx"), "name", "one_way", "roundabout", "link", "road_class", F.col("piece.part").alias("nodes"))


def non_area_relations(relations: DataFrame) -> DataFrame:
    """Relations with members, none of which is a way in the role of an outer or inner ring."""
    ring = lambda m: (m["type"] == "way") & m["role"].isin("inner", "outer")
    return relations.where(F.col("members").isNotNull() & ~F.exists("members", ring))
