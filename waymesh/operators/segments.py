"""Segments: sections merged across nodes where nothing else meets.

One round: every segment shows its two end nodes; ends at merging nodes that two segments may join keep
their flag; a segment keeps one flagged end, that with the least hash of node and round; segments without one,
and loops, are final; two segments that keep the same node become one, a single one waits for the next round. The
hash makes neighbours agree on the least joint of a chain, so every round with an open joint merges some pair.

Rounds run on outlines: of each segment its attributes, the ends of its sections and the keys of the segments it is
made of (``parts``), no geometry. Each round is written to a durable place, so lineage does not grow. Geometry is
joined once, at the end, and only what was merged is shuffled by its new key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STATE = ["level", "seg_key", "one_way", "link", "roundabout", "sections"]
_OUTLINE = ["level", "seg_key", "one_way", "link", "roundabout", "ends", "parts"]


def initial_segments(sections: DataFrame) -> DataFrame:
    """One segment for each section; the key sorts like (way_id, start_idx)."""
    key = F.concat(F.lpad(F.col("way_id").cast("string"), 20, "0"), F.lit(":"), F.lpad(F.col("start_idx").cast("string"), 6, "0"))
    one = F.array(F.struct("way_id", "start_idx", "name", "one_way", "roundabout", "link", "road_class", "nodes"))
    return sections.select("level", key.alias("seg_key"), "one_way", "link", "roundabout", one.alias("sections"))


def first_node(sections: Column) -> Column:
    return F.get(F.get(sections, F.lit(0))["nodes"], F.lit(0))["node_id"]


def last_node(sections: Column) -> Column:
    return F.element_at(F.element_at(sections, -1)["nodes"], -1)["node_id"]


def outline(segment: DataFrame) -> DataFrame:
    """With ``ends`` (way, first and last node of each section), ``first``, ``last`` and ``parts``: what merging needs."""
    ends = lambda s: F.struct(s["way_id"].alias("way_id"), F.get(s["nodes"], F.lit(0))["node_id"].alias("a"), F.element_at(s["nodes"], -1)["node_id"].alias("z"))
    part = F.array(F.struct(F.col("seg_key").alias("part"), F.lit(False).alias("turned"), F.lit(False).alias("lost")))
    return _ended(segment.withColumn("ends", F.transform("sections", ends)).withColumn("parts", part))


def _ended(rows: DataFrame) -> DataFrame:
    return rows.withColumn("first", F.get("ends", F.lit(0))["a"]).withColumn("last", F.element_at("ends", -1)["z"])


def can_merge(a: Column, b: Column) -> Column:
    """Of two structs (one_way, link, roundabout, first, last, ends): equal attributes; a directed pair must run on
    head to tail; and they must not be duplicates: with equal numbers of sections, at some place way, first
    and last node must all differ."""
    alike = (a["one_way"] == b["one_way"]) & (a["link"] == b["link"]) & (a["roundabout"] == b["roundabout"])
    runs_on = (b["first"] == a["last"]) | (a["first"] == b["last"])
    differ = lambda x, y: (x["way_id"] != y["way_id"]) & (x["a"] != y["a"]) & (x["z"] != y["z"])
    distinct = (F.size(a["ends"]) != F.size(b["ends"])) | F.exists(F.zip_with(a["ends"], b["ends"], differ), lambda d: d)
    return alike & (~(a["one_way"] | a["roundabout"]) | runs_on) & distinct


def reverse_sections(sections: Column) -> Column:
    return F.reverse(F.transform(sections, lambda s: s.withField("nodes", F.reverse(s["nodes"]))))


def _turned(a: Column) -> tuple[Column, Column]:
    """ends and parts of an outline drawn the other way."""
    ends = F.transform(a["ends"], lambda e: F.struct(e["way_id"].alias("way_id"), e["z"].alias("a"), e["a"].alias("z")))
    return F.reverse(ends), F.reverse(F.transform(a["parts"], lambda p: p.withField("turned", ~p["turned"])))


def joined_outlines(a: Column, b: Column, fix_last_last: bool = True) -> tuple[Column, Column]:
    """ends and parts of two outlines joined at the node they share. Where only their last nodes meet, b is turned and
    appended; with ``fix_last_last`` False only the turned b is left there, and the parts of a are lost."""
    ends, parts = _turned(b)
    lost = F.transform(a["parts"], lambda p: p.withField("lost", F.lit(True)))

    def pick(x: Column, y: Column, turned: Column, otherwise: Column) -> Column:
        return F.when(b["first"] == a["last"], F.concat(x, y)).when(a["first"] == b["last"], F.concat(y, x)).when(a["first"] == b["first"], F.concat(turned, x)).otherwise(otherwise)

    return (
        pick(a["ends"], b["ends"], ends, F.concat(a["ends"], ends) if fix_last_last else ends),
        pick(a["parts"], b["parts"], parts, F.concat(a["parts"] if fix_last_last else lost, parts)),
    )


def segment_ends(segments: DataFrame) -> DataFrame:
    """Two rows a segment, also where both ends are one node; of segments or their outlines."""
    rows = segments if "ends" in segments.columns else outline(segments)
    return rows.select("level", "seg_key", "one_way", "link", "roundabout", "first", "last", "ends", F.explode(F.array("first", "last")).alias("node_id"))


def segment_end_merging(ends: DataFrame, merging_nodes: DataFrame) -> DataFrame:
    known = merging_nodes.select("level", "node_id", F.lit(True).alias("known"))
    return ends.join(known, ["level", "node_id"], "left").withColumn("merging", F.coalesce("known", F.lit(False))).drop("known")


def cleaned_segment_ends(flagged: DataFrame) -> DataFrame:
    """The ends of which ``merging`` holds: exactly two at a node, and the two may merge."""
    held = F.array_sort(F.collect_list(F.struct("seg_key", "one_way", "link", "roundabout", "first", "last", "ends")))
    pairs = flagged.where("merging").groupBy("level", "node_id").agg(held.alias("pair")).where(F.size("pair") == 2)
    good = pairs.where(can_merge(F.get("pair", F.lit(0)), F.get("pair", F.lit(1))))
    return good.select("level", "node_id", F.explode(F.transform("pair", lambda p: p["seg_key"])).alias("seg_key"))


def dedup_segment_ends(cleaned: DataFrame, round_no: int) -> DataFrame:
    """level, seg_key, node_id: the one joint of a segment, by least md5 of node and round."""
    hashed = F.md5(F.concat(F.col("node_id").cast("string"), F.lit(","), F.lit(str(round_no))).cast("binary"))
    least = cleaned.groupBy("level", "seg_key").agg(F.min(F.struct(hashed.alias("h"), F.col("node_id"))).alias("joint"))
    return least.select("level", "seg_key", F.col("joint.node_id").alias("node_id"))


def merge_round(outlines: DataFrame, merging_nodes: DataFrame, round_no: int = 1, fix_last_last: bool = True) -> DataFrame:
    """The outlines after one round, with ``status``: final, waiting or merged."""
    joints = dedup_segment_ends(cleaned_segment_ends(segment_end_merging(segment_ends(outlines), merging_nodes)), round_no)
    rows = outlines.join(joints, ["level", "seg_key"], "left")
    final = F.col("node_id").isNull() | (F.col("first") == F.col("last"))
    # A node has two ends at most, so a list holds two segments at most.
    held = F.array_sort(F.collect_list(F.struct("seg_key", "one_way", "link", "roundabout", "first", "last", "ends", "parts")))
    met = rows.where(~final).groupBy("level", "node_id").agg(held.alias("pair"))
    a, b, two = F.get("pair", F.lit(0)), F.get("pair", F.lit(1)), F.size("pair") == 2
    ends, parts = joined_outlines(a, b, fix_last_last)
    same = [a[c].alias(c) for c in ("seg_key", "one_way", "link", "roundabout")]
    moved = met.select("level", *same, F.when(two, ends).otherwise(a["ends"]).alias("ends"), F.when(two, parts).otherwise(a["parts"]).alias("parts"), F.when(two, "merged").otherwise("waiting").alias("status"))
    return _ended(rows.where(final).select(*_OUTLINE, F.lit("final").alias("status")).unionByName(moved))


def merged_segments(segments: DataFrame, merging_nodes: DataFrame, keep: Callable[[DataFrame], DataFrame], max_rounds: int = 100, fix_last_last: bool = True) -> DataFrame:
    """Rounds until nothing merges; after ``max_rounds`` what is still open is given out as it is. ``keep`` makes a
    frame durable."""
    return assembled(keep(placed_segments(segments, merging_nodes, keep, max_rounds, fix_last_last)))


def placed_segments(segments: DataFrame, merging_nodes: DataFrame, keep: Callable[[DataFrame], DataFrame], max_rounds: int = 100, fix_last_last: bool = True) -> DataFrame:
    """The segments with their place in a merged one (``into``, ``pos``, ``turned``, ``lost``), null where they stay as they are."""
    nodes, segments = keep(merging_nodes.select("level", "node_id")), keep(segments.select(*_STATE))
    now, done = outline(segments).select(*_OUTLINE, "first", "last"), []
    several = F.size("parts") > 1
    for round_no in range(1, max_rounds + 1):
        after = keep(merge_round(now, nodes, round_no, fix_last_last))
        done.append(after.where((F.col("status") == "final") & several))
        now = after.where("status <> 'final'").drop("status")
        if after.where("status = 'merged'").isEmpty():
            break
    moved = now.where(several)
    for part in done:
        moved = moved.unionByName(part.drop("status"))
    moved = keep(moved.select("level", F.col("seg_key").alias("into"), F.posexplode("parts").alias("pos", "p")).select("level", "into", "pos", F.col("p.part").alias("seg_key"), "p.turned", "p.lost"))
    return segments.join(moved, ["level", "seg_key"], "left")


def assembled(placed: DataFrame) -> DataFrame:
    """Merged segments of placed ones; ``placed`` is read twice."""
    held = F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("turned"), reverse_sections(F.col("sections"))).otherwise(F.col("sections")).alias("sections"))))
    # All parts of a segment have the same attributes.
    same = [F.min(c).alias(c) for c in ("one_way", "link", "roundabout")]
    whole = placed.where("into is not null and not lost").groupBy("level", F.col("into").alias("seg_key")).agg(*same, F.flatten(F.transform(held, lambda x: x["sections"])).alias("sections"))
    return placed.where("into is null").select(*_STATE).unionByName(whole.select(*_STATE))
