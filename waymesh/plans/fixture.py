"""A synthetic road network derived from the star-schema tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HIGHWAYS = ("motorway", "trunk", "primary", "secondary", "tertiary", "residential", "unclassified", "service", "footway")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = _table(spark, sf_dir, "part").agg((F.count("*") * 20).alias("n_nodes"))
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    node = (F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_orderkey") * 7) % F.col("n_nodes")
    # One row: the size of the node grid.
    return _table(spark, sf_dir, "lineitem").crossJoin(F.broadcast(size)).select(F.col("l_orderkey").alias("way_id"), node.alias("node_id"), (F.row_number().over(order) - 1).alias("ord"))


def tags_of(w) -> F.Column:
    kind = F.element_at(F.array(*map(F.lit, HIGHWAYS)), (w % 9 + 1).cast("int"))
    kind = F.when((w % 9 <= 4) & (w % 11 == 0), F.concat(kind, F.lit("_link"))).otherwise(kind)
    # Blanks and control characters around values, which do not count.
    kind = F.when(w % 13 == 0, F.concat(F.lit(" \t"), F.upper(kind), F.lit("\n "))).otherwise(kind)
    told = {
        "highway": kind,
        "oneway": F.when(w % 35 == 0, "yes\n").when(w % 5 == 0, "yes").when(w % 5 == 1, "no").when(w % 5 == 2, "-1"),
        "junction": F.when(w % 34 == 0, "roundabout\t").when(w % 17 == 0, "roundabout"),
        "service": F.when((w % 9 == 7) & (w % 4 == 0), "parking_aisle").when((w % 9 == 7) & (w % 4 == 1), "driveway"),
        "name": F.when(w % 6 != 0, F.concat(F.lit(" \tStreet "), (w % 50).cast("string"), F.lit("\r"))),
    }
    entries = F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in told.items()))
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, tags, refs"""
    refs = _links(spark, sf_dir).groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("ord", "node_id"))).alias("r"))
    return refs.select(F.col("way_id").alias("id"), tags_of(F.col("way_id")).alias("tags"), F.transform("r", lambda x: x["node_id"]).alias("refs"))


def _placed(ids: DataFrame) -> DataFrame:
    lon = F.lit(-74.0) + (F.col("id") % 200) * F.lit(0.001)
    lat = F.lit(40.0) + (F.floor(F.col("id") / 200) % 2000) * F.lit(0.001)
    return ids.select("id", lon.alias("lon"), lat.alias("lat"), F.lit(None).cast("map<string,string>").alias("tags"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, lon, lat, tags"""
    return _placed(_links(spark, sf_dir).select(F.col("node_id").alias("id")).distinct())


def chain_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A network in which every joint merges: one three-node way for each part."""
    w = F.col("p_partkey")
    refs = F.array(w * 2, w * 2 + 1, w * 2 + 2)
    tags = F.map_filter(F.create_map(F.lit("highway"), F.lit("residential"), F.lit("oneway"), F.when(F.floor(w / 37) % 2 == 0, "yes")), lambda k, v: v.isNotNull())
    return _table(spark, sf_dir, "part").select(w.alias("id"), tags.alias("tags"), F.when(w % 23 == 0, F.reverse(refs)).otherwise(refs).alias("refs"))


def chain_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(chain_ways(spark, sf_dir).select(F.explode("refs").alias("id")).distinct())


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, tags, members"""
    role = F.when(F.col("o_orderstatus") == "O", "outer").when(F.col("o_orderstatus") == "F", "inner").otherwise("")
    member = F.struct(F.col("o_orderkey").alias("ref"), role.alias("role"), F.lit("way").alias("type"))
    rows = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(member)).alias("members"))
    return rows.select(F.col("o_custkey").alias("id"), F.lit(None).cast("map<string,string>").alias("tags"), "members")


#: The same as SQL: common table expressions that every oracle may use.
SQL = """
links AS MATERIALIZED (
  SELECT l_orderkey AS way_id, (l_partkey * 31 + l_suppkey * 17 + l_orderkey * 7) % (SELECT 20 * count(*) FROM part) AS node_id,
         CAST(row_number() OVER w - 1 AS INTEGER) AS ord, CAST(count(*) OVER (PARTITION BY l_orderkey) AS INTEGER) AS n
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)),
way_node_links AS MATERIALIZED (SELECT way_id, node_id, ord, (ord = 0 OR ord = n - 1) AS terminal FROM links),
nodes AS MATERIALIZED (
  SELECT node_id, -74.0::DOUBLE + (node_id % 200) * 0.001::DOUBLE AS lon, 40.0::DOUBLE + ((node_id // 200) % 2000) * 0.001::DOUBLE AS lat
  FROM (SELECT DISTINCT node_id FROM links)),
ways AS MATERIALIZED (
  SELECT w AS way_id,
    CASE WHEN w % 13 = 0 THEN ' ' || chr(9) || upper(kind) || chr(10) || ' ' ELSE kind END AS highway,
    CASE WHEN w % 35 = 0 THEN 'yes' || chr(10) WHEN w % 5 = 0 THEN 'yes' WHEN w % 5 = 1 THEN 'no' WHEN w % 5 = 2 THEN '-1' END AS oneway,
    CASE WHEN w % 34 = 0 THEN 'roundabout' || chr(9) WHEN w % 17 = 0 THEN 'roundabout' END AS junction,
    CASE WHEN w % 9 = 7 AND w % 4 = 0 THEN 'parking_aisle' WHEN w % 9 = 7 AND w % 4 = 1 THEN 'driveway' END AS service,
    CASE WHEN w % 6 <> 0 THEN ' ' || chr(9) || 'Street ' || (w % 50) || chr(13) END AS name
  FROM (SELECT w, list_extract(['motorway','trunk','primary','secondary','tertiary','residential','unclassified','service','footway'], CAST(w % 9 + 1 AS INTEGER))
               || CASE WHEN w % 9 <= 4 AND w % 11 = 0 THEN '_link' ELSE '' END AS kind
        FROM (SELECT DISTINCT l_orderkey AS w FROM lineitem))),
tagged AS MATERIALIZED (
  SELECT way_id, service, lower(trim(highway, blanks)) AS highway, trim(coalesce(oneway, ''), blanks) AS oneway, trim(coalesce(junction, ''), blanks) AS junction, trim(coalesce(name, ''), blanks) AS name
  FROM ways CROSS JOIN (SELECT ' ' || chr(9) || chr(10) || chr(13) AS blanks)),
attributes AS MATERIALIZED (
  SELECT way_id, name,
    CASE WHEN oneway = 'yes' THEN true WHEN oneway = 'no' THEN false ELSE highway = 'motorway' OR junction = 'roundabout' END AS one_way,
    junction = 'roundabout' AS roundabout,
    highway LIKE '%\\_link' ESCAPE '\\' AS link,
    CAST(CASE WHEN way_id % 9 <= 4 THEN way_id % 9 WHEN way_id % 9 = 5 THEN 5 WHEN way_id % 9 = 6 THEN 6
         WHEN way_id % 9 = 7 THEN CASE WHEN service IS NOT NULL THEN 8 ELSE 7 END ELSE 8 END AS INTEGER) AS road_class
  FROM tagged),
kept AS MATERIALIZED (
  SELECT level, a.* FROM attributes a JOIN (SELECT way_id FROM links GROUP BY way_id HAVING count(*) >= 2) USING (way_id)
  CROSS JOIN (SELECT unnest([6, 4, 2, 0]) AS level) WHERE road_class <= level),
filtered AS MATERIALIZED (SELECT k.level, l.* FROM way_node_links l JOIN kept k USING (way_id)),
intersections AS MATERIALIZED (
  SELECT level, node_id, count(*) FILTER (WHERE terminal) AS n_terminating, count(*) FILTER (WHERE NOT terminal) AS n_intersecting,
         string_agg(CAST(way_id AS VARCHAR), ',' ORDER BY way_id) FILTER (WHERE terminal) AS terminating,
         string_agg(CAST(way_id AS VARCHAR), ',' ORDER BY way_id) FILTER (WHERE NOT terminal) AS intersecting
  FROM filtered GROUP BY level, node_id HAVING count(*) > 1),
splitting AS MATERIALIZED (SELECT * FROM intersections WHERE n_intersecting > 1 OR (n_terminating > 0 AND n_intersecting = 1)),
merging AS MATERIALIZED (SELECT * FROM intersections WHERE n_terminating = 2 AND n_intersecting = 0),
way_split_points AS MATERIALIZED (SELECT f.level, f.way_id, f.node_id FROM filtered f JOIN splitting s USING (level, node_id) WHERE NOT f.terminal),
marked AS MATERIALIZED (
  SELECT f.level, f.way_id, f.node_id, f.ord, l.n, f.ord > 0 AND f.ord < l.n - 1 AND p.node_id IS NOT NULL AS cut
  FROM filtered f JOIN links l USING (way_id, ord)
  LEFT JOIN (SELECT DISTINCT level, way_id, node_id FROM way_split_points) p ON p.level = f.level AND p.way_id = f.way_id AND p.node_id = f.node_id),
starts AS MATERIALIZED (SELECT level, way_id, ord AS start_idx, n, lead(ord) OVER (PARTITION BY level, way_id ORDER BY ord) AS next_start FROM marked WHERE cut OR ord = 0),
section_nodes AS MATERIALIZED (
  SELECT s.level, s.way_id, s.start_idx, m.ord, m.node_id, d.lon, d.lat
  FROM starts s JOIN marked m ON m.level = s.level AND m.way_id = s.way_id AND m.ord BETWEEN s.start_idx AND coalesce(s.next_start, s.n - 1)
  JOIN nodes d ON d.node_id = m.node_id),
sections AS MATERIALIZED (
  SELECT level, way_id, start_idx, CAST(count(*) AS INTEGER) AS n_nodes, string_agg(CAST(node_id AS VARCHAR), ',' ORDER BY ord) AS node_ids,
         arg_min(node_id, ord) AS first_node, arg_max(node_id, ord) AS last_node
  FROM section_nodes GROUP BY level, way_id, start_idx),
segments AS MATERIALIZED (
  SELECT s.*, lpad(CAST(way_id AS VARCHAR), 20, '0') || ':' || lpad(CAST(start_idx AS VARCHAR), 6, '0') AS seg_key, a.name, a.one_way, a.roundabout, a.link, a.road_class
  FROM sections s JOIN attributes a USING (way_id))
"""

#: The chain network: tables like those above, all of them residential, so at level 6 only.
CHAIN_SQL = """
chain_ways AS MATERIALIZED (SELECT p_partkey AS way_id, (p_partkey // 37) % 2 = 0 AS one_way, [2 * p_partkey, 2 * p_partkey + 1, 2 * p_partkey + 2] AS refs, p_partkey % 23 = 0 AS turned FROM part),
chain_nodes AS MATERIALIZED (SELECT way_id, unnest(CASE WHEN turned THEN list_reverse(refs) ELSE refs END) AS node_id, unnest([0, 1, 2]) AS ord FROM chain_ways),
chain_section_nodes AS MATERIALIZED (SELECT 6 AS level, way_id, 0 AS start_idx, node_id, ord FROM chain_nodes),
chain_merging AS MATERIALIZED (SELECT 6 AS level, node_id FROM chain_nodes GROUP BY node_id HAVING count(*) = 2),
chain_segments AS MATERIALIZED (
  SELECT 6 AS level, way_id, 0 AS start_idx, lpad(CAST(way_id AS VARCHAR), 20, '0') || ':000000' AS seg_key, one_way, false AS link, false AS roundabout, '' AS name, CAST(5 AS INTEGER) AS road_class
  FROM chain_ways)
"""
