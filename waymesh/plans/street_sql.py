"""Streets as SQL: lines, classes, metadata, references and intersections of the merged segments."""

from __future__ import annotations

from waymesh.plans import geodesic_sql as G
from waymesh.plans import merge_sql

#: More rounds than the derived networks need; a round without open joints changes nothing.
ROUNDS, CHAIN_ROUNDS = 6, 14

MERGED = merge_sql.merged("", "segments", "section_nodes", "merging", ROUNDS)
CHAINS = merge_sql.merged("c", "chain_segments", "chain_section_nodes", "chain_merging", CHAIN_ROUNDS)

STREETS = f"""{MERGED},
lines AS MATERIALIZED (
  SELECT *, list_filter(every, lambda x, i: i = 1 OR x <> every[i - 1]) AS nodes
  FROM (SELECT *, flatten(list_transform(secs, lambda s: s.nodes)) AS every, list_transform(secs, lambda s: s.road_class) AS classes, list_transform(secs, lambda s: s.name) AS names FROM merged)),
vertices AS MATERIALIZED (
  SELECT v.*, d.lon, d.lat FROM (SELECT level, seg_key, generate_subscripts(nodes, 1) AS ord, unnest(nodes) AS node_id FROM lines WHERE len(nodes) >= 2) v
  JOIN nodes d ON d.node_id = v.node_id),
shapes AS MATERIALIZED (
  SELECT level, seg_key, CAST(count(*) AS INTEGER) AS n_points, string_agg(CAST(node_id AS VARCHAR), ',' ORDER BY ord) AS line_nodes,
    md5('Geometry' || string_agg(printf(' %.5f %.5f', lon, lat), '' ORDER BY ord)) AS geometry_id,
    arg_min(node_id, ord) AS start_node, arg_max(node_id, ord) AS end_node,
    arg_min(lon, ord) AS start_lon, arg_min(lat, ord) AS start_lat, arg_max(lon, ord) AS end_lon, arg_max(lat, ord) AS end_lat
  FROM vertices GROUP BY level, seg_key),
streets AS MATERIALIZED (
  SELECT l.*, n_points, line_nodes, geometry_id, start_node, end_node, start_lon, start_lat, end_lon, end_lat,
    CAST(CASE WHEN len(list_distinct(classes)) = 1 THEN classes[1] ELSE 8 END AS INTEGER) AS road_class,
    CAST(CASE WHEN link THEN 6 WHEN roundabout THEN 4 WHEN len(list_distinct(classes)) > 1 THEN 0 WHEN classes[1] = 0 THEN 1 WHEN classes[1] IN (1, 2) AND one_way THEN 2
              WHEN classes[1] BETWEEN 1 AND 6 THEN 3 ELSE 7 END AS INTEGER) AS form_of_way
  FROM lines l JOIN shapes s ON s.level = l.level AND s.seg_key = l.seg_key),
unique_streets AS (SELECT level, geometry_id, min(seg_key) AS seg_key FROM streets GROUP BY level, geometry_id)
"""

TILES = """,
pixels AS (
  SELECT node_id, lon, lat,
    CAST(floor(floor(least(greatest((lon + 180.0) / 360.0 * 1048576.0 + 0.5, 0.0), 1048575.0)) / 256) AS INTEGER) AS x,
    CAST(floor(floor(least(greatest((0.5 - ln((1.0 + sin(lat * 3.141592653589793 / 180.0)) / (1.0 - sin(lat * 3.141592653589793 / 180.0))) / (4 * 3.141592653589793)) * 1048576.0 + 0.5, 0.0), 1048575.0)) / 256) AS INTEGER) AS y
  FROM nodes),
tiled AS MATERIALIZED (SELECT node_id, x, y, '12-' || x || '-' || y AS tile FROM pixels)
"""

GEOMETRY_TILES = """,
geometry_tiles AS MATERIALIZED (SELECT DISTINCT v.level, v.seg_key, t.tile FROM vertices v JOIN tiled t ON t.node_id = v.node_id)
"""


def intersection(lon: str, lat: str, node: str) -> str:
    return f"md5(printf('Intersection %.5f %.5f', {lon}, {lat}) || ' ' || {node})"


def _half_up(x: str) -> str:
    return f"CAST(floor({x} + 0.5) AS BIGINT)"


#: A line has two references, or one for each 15 km begun; all but the first stand on its last vertex, which only the
#: bearings of the outer ones can tell: 180 is the azimuth between equal points on the northern hemisphere.
REFERENCES = f""",
ways_of AS MATERIALIZED (
  SELECT level, seg_key, 'forward' AS direction, ord, node_id, lon, lat FROM vertices
  UNION ALL
  SELECT v.level, v.seg_key, 'back', s.n_points + 1 - v.ord, v.node_id, v.lon, v.lat FROM vertices v JOIN streets s ON s.level = v.level AND s.seg_key = v.seg_key WHERE NOT s.one_way),
steps AS MATERIALIZED (
  SELECT a.level, a.seg_key, a.direction, a.ord, a.node_id AS a, b.node_id AS b, a.lon AS lon1, a.lat AS lat1, b.lon AS lon2, b.lat AS lat2
  FROM ways_of a JOIN ways_of b ON b.level = a.level AND b.seg_key = a.seg_key AND b.direction = a.direction AND b.ord = a.ord + 1),
distinct_steps AS MATERIALIZED (SELECT DISTINCT a, b, lon1, lat1, lon2, lat2 FROM steps)
{G.inverse("told", "distinct_steps")},
legs AS MATERIALIZED (SELECT a, b, metres, {G.degrees("azimuth2")} AS arriving, {G.azimuth_along("20.0")} AS leaving FROM told),
measured AS MATERIALIZED (
  SELECT s.level, s.seg_key, s.direction, sum(metres) AS length, arg_min(leaving, ord) AS leaving, arg_max(arriving, ord) AS arriving
  FROM steps s JOIN legs l ON l.a = s.a AND l.b = s.b GROUP BY s.level, s.seg_key, s.direction),
counted AS MATERIALIZED (
  SELECT m.*, CASE WHEN length <= 15000 THEN 2 ELSE CAST(ceil(length / 15000) AS INTEGER) END AS n, s.geometry_id, s.form_of_way,
    CASE WHEN direction = 'forward' THEN start_node ELSE end_node END AS first_node, CASE WHEN direction = 'forward' THEN end_node ELSE start_node END AS last_node,
    CASE WHEN direction = 'forward' THEN start_lon ELSE end_lon END AS first_lon, CASE WHEN direction = 'forward' THEN end_lon ELSE start_lon END AS last_lon,
    CASE WHEN direction = 'forward' THEN start_lat ELSE end_lat END AS first_lat, CASE WHEN direction = 'forward' THEN end_lat ELSE start_lat END AS last_lat
  FROM measured m JOIN streets s ON s.level = m.level AND s.seg_key = m.seg_key),
lprs AS MATERIALIZED (
  SELECT level, seg_key, direction, CAST(i + 1 AS INTEGER) AS sequence, CASE WHEN i = 0 THEN first_lon ELSE last_lon END AS lon, CASE WHEN i = 0 THEN first_lat ELSE last_lat END AS lat,
    CASE WHEN i = 0 THEN leaving WHEN i < n - 1 THEN 180.0 END AS outbound, CASE WHEN i > 0 THEN CASE WHEN (n - 1) // i >= 2 THEN 180.0 ELSE arriving END END AS inbound,
    CASE WHEN i < n - 1 THEN length / (n - 1) END AS distance, CASE WHEN i = 0 THEN first_node WHEN i = n - 1 THEN last_node END AS node_id
  FROM (SELECT *, unnest(range(0, n)) AS i FROM counted)),
texts AS MATERIALIZED (
  SELECT level, seg_key, direction, string_agg(printf(' %.5f %.5f', lon, lat) || CASE WHEN outbound IS NULL THEN '' ELSE ' ' || {_half_up("outbound")} || ' ' || {_half_up("distance")} END, '' ORDER BY sequence) AS t
  FROM lprs GROUP BY level, seg_key, direction),
refs AS MATERIALIZED (
  SELECT c.*, md5('Reference ' || form_of_way || t) AS reference_id, {intersection("first_lon", "first_lat", "first_node")} AS first_id, {intersection("last_lon", "last_lat", "last_node")} AS last_id
  FROM counted c JOIN texts x ON x.level = c.level AND x.seg_key = c.seg_key AND x.direction = c.direction),
touches AS MATERIALIZED (
  SELECT level, reference_id, first_id AS intersection_id, first_node AS node_id, first_lon AS lon, first_lat AS lat, true AS outbound FROM refs
  UNION ALL
  SELECT level, reference_id, last_id, last_node, last_lon, last_lat, first_id = last_id FROM refs),
crossings AS MATERIALIZED (
  SELECT level, intersection_id, min(node_id) AS node_id, min(lon) AS lon, min(lat) AS lat, count(*) FILTER (WHERE NOT outbound) AS n_inbound, count(*) FILTER (WHERE outbound) AS n_outbound,
    coalesce(string_agg(reference_id, ',' ORDER BY reference_id) FILTER (WHERE NOT outbound), '') AS inbound, coalesce(string_agg(reference_id, ',' ORDER BY reference_id) FILTER (WHERE outbound), '') AS outbound
  FROM touches GROUP BY level, intersection_id),
reference_tiles AS MATERIALIZED (
  SELECT DISTINCT level, seg_key, direction, tile, reference_id FROM (SELECT *, unnest([first_node, last_node]) AS node_id FROM refs) JOIN tiled USING (node_id))
"""
