"""The merging of segments as SQL, written out round by round, to hold the Spark operators against.

Each round is a handful of table expressions over the round before, with the segments' sections as lists. Rounds
in which nothing is left to merge change nothing, so their number only has to be large enough.
"""

from __future__ import annotations

_TURNED = "list_reverse(list_transform({0}.secs, lambda s: struct_pack(way_id := s.way_id, name := s.name, road_class := s.road_class, nodes := list_reverse(s.nodes))))"
_ALIKE = """a.one_way = b.one_way AND a.link = b.link AND a.roundabout = b.roundabout
    AND (NOT (a.one_way OR a.roundabout) OR b.first = a.last OR a.first = b.last)
    AND (len(a.secs) <> len(b.secs) OR len(list_filter(range(1, len(a.secs) + 1), lambda i: a.secs[i].way_id <> b.secs[i].way_id
         AND a.secs[i].nodes[1] <> b.secs[i].nodes[1] AND a.secs[i].nodes[-1] <> b.secs[i].nodes[-1])) > 0)"""


def start(prefix: str, segments: str, section_nodes: str) -> str:
    """<prefix>m0: a row a segment, from tables like ``segments`` and ``section_nodes`` of the fixture."""
    return f""",
{prefix}lists AS MATERIALIZED (SELECT level, way_id, start_idx, list(node_id ORDER BY ord) AS nodes FROM {section_nodes} GROUP BY level, way_id, start_idx),
{prefix}m0 AS MATERIALIZED (
  SELECT s.level, s.seg_key, s.one_way, s.link, s.roundabout, [struct_pack(way_id := s.way_id, name := s.name, road_class := s.road_class, nodes := x.nodes)] AS secs, x.nodes[1] AS first, x.nodes[-1] AS last
  FROM {segments} s JOIN {prefix}lists x ON x.level = s.level AND x.way_id = s.way_id AND x.start_idx = s.start_idx)"""


def one_round(prefix: str, k: int, merging: str) -> str:
    """<prefix>f<k>: the segments that are final; <prefix>m<k>: the others, merged or waiting."""
    p, was = f"{prefix}", f"{prefix}m{k - 1}"
    return f""",
{p}e{k} AS MATERIALIZED (
  SELECT e.level, e.seg_key, e.node_id FROM (SELECT level, seg_key, unnest([first, last]) AS node_id FROM {was}) e
  JOIN {merging} m ON m.level = e.level AND m.node_id = e.node_id),
{p}p{k} AS MATERIALIZED (SELECT level, node_id, min(seg_key) AS a_key, max(seg_key) AS b_key FROM {p}e{k} GROUP BY level, node_id HAVING count(*) = 2),
{p}c{k} AS MATERIALIZED (
  SELECT p.level, p.node_id, p.a_key, p.b_key, {_ALIKE} AS mergeable
  FROM {p}p{k} p JOIN {was} a ON a.level = p.level AND a.seg_key = p.a_key JOIN {was} b ON b.level = p.level AND b.seg_key = p.b_key),
{p}j{k} AS MATERIALIZED (
  SELECT level, seg_key, arg_min(node_id, md5(CAST(node_id AS VARCHAR) || ',{k}')) AS node_id
  FROM (SELECT level, node_id, unnest([a_key, b_key]) AS seg_key FROM {p}c{k} WHERE mergeable) GROUP BY level, seg_key),
{p}r{k} AS MATERIALIZED (SELECT s.*, j.node_id, j.node_id IS NULL OR s.first = s.last AS final FROM {was} s LEFT JOIN {p}j{k} j ON j.level = s.level AND j.seg_key = s.seg_key),
{p}f{k} AS MATERIALIZED (SELECT level, seg_key, one_way, link, roundabout, secs, first, last FROM {p}r{k} WHERE final),
{p}t{k} AS MATERIALIZED (SELECT level, node_id, min(seg_key) AS a_key, max(seg_key) AS b_key, count(*) AS n FROM {p}r{k} WHERE NOT final GROUP BY level, node_id),
{p}s{k} AS MATERIALIZED (
  SELECT t.level, a.seg_key, a.one_way, a.link, a.roundabout, t.n,
    CASE WHEN t.n = 1 THEN a.secs WHEN b.first = a.last THEN list_concat(a.secs, b.secs) WHEN a.first = b.last THEN list_concat(b.secs, a.secs)
         WHEN a.first = b.first THEN list_concat({_TURNED.format("b")}, a.secs) ELSE list_concat(a.secs, {_TURNED.format("b")}) END AS secs
  FROM {p}t{k} t JOIN {was} a ON a.level = t.level AND a.seg_key = t.a_key JOIN {was} b ON b.level = t.level AND b.seg_key = t.b_key),
{p}m{k} AS MATERIALIZED (SELECT level, seg_key, one_way, link, roundabout, secs, secs[1].nodes[1] AS first, secs[-1].nodes[-1] AS last FROM {p}s{k})"""


def merged(prefix: str, segments: str, section_nodes: str, merging: str, rounds: int) -> str:
    """Table expressions that end in <prefix>merged."""
    parts = " UNION ALL ".join(f"SELECT * FROM {prefix}f{k}" for k in range(1, rounds + 1))
    every = "".join(one_round(prefix, k, merging) for k in range(1, rounds + 1))
    return f"{start(prefix, segments, section_nodes)}{every},\n{prefix}merged AS MATERIALIZED ({parts} UNION ALL SELECT * FROM {prefix}m{rounds})"
