"""Operator 10: near-duplicate documents by MinHash bands, verified with odd sketches and on full sets.

1. One pass over the texts gives each its set of word shingles, 240 MinHash samples, 40 band keys of 6
   samples and an odd sketch: the parity, for each of 1024 places, of the samples that hash there. Equal
   sets have one node (a 64-bit hash of the set), so copies are never compared.
2. Each band key that several nodes share names its least node as pivot. A group is a pivot with all nodes
   that share a key of its; two nodes that share any key share a group. Where the key has two nodes only,
   the XOR population count of their odd sketches settles at once that most are no candidates.
3. Groups are cut into blocks of a bounded number of nodes and bytes. In a block, sketches are compared as
   bit matrices; pairs that the sketches leave open are confirmed on the full sets, likeliest first, and
   only while the two are not yet linked through others. Only links that join two parts come out.
4. For groups of several blocks, nodes outside the group's largest part so far meet all the other blocks.
5. Components of the links; the label of a component is its smallest doc_id.

A pair at similarity 0.8 shares no band with probability (1 - 0.8**6)**40 = 5e-6. The sketch test leaves
about four standard deviations. No group, bucket or partner list is capped.

Edge cases: a null or blank text has an empty set, n_shingles 0, and is its own component. In
``near_duplicates`` a row without doc_id is linked with nothing, has a null component_id and is kept; repeated
rows are copies of each other, and rows that tie on doc_id share a component. Other columns are ignored by
``near_duplicates`` and returned by ``deduplicated``. An empty table gives an empty result. Very long texts are
done whole; a set takes 8 bytes a shingle. Set identities and intersections are those of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm.common import durable, give_back, table, unused
from waymesh.llm.graph import components
from waymesh.llm.minhash import BANDS, ROWS, SKETCH_BITS, Signer, odd_distance_limit
from waymesh.llm.wordhash import GOLDEN, mix, shingle_sets

THRESHOLD = 80
#: Sketch distances up to that of this similarity are left to confirmation.
SKETCH_SIMILARITY = 0.66
BLOCK_NODES = 256
BLOCK_BYTES = 8_000_000
_PART = 2_000_000
SALTS = 32


def set_id(own: np.ndarray) -> int:
    """A signed 64-bit hash of a set of hashes; 0 is never given."""
    total = int(mix(own).sum(dtype=np.uint64)) ^ (int(mix(own * GOLDEN).sum(dtype=np.uint64)) << 1) & (2**64 - 1)
    x = int(mix(np.array([(total + len(own)) & (2**64 - 1)], np.uint64))[0]) or 1
    return x - (1 << 64) if x >= 1 << 63 else x


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = total = 0
    for i, x in enumerate(texts):
        total += len(x or "")
        if total >= _PART:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, did, tie, text. (did, tie) names the rows that are equal in doc_id and text: tie is a hash of the text,
    did the doc_id, or another hash of the text where there is none."""
    text = F.col("text").cast("string")
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.xxhash64(F.lit("id"), text)).alias("did"), F.xxhash64(text).alias("tie"), text.alias("text"))


def signatures(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, did, tie, n_shingles, node, bands, sketch for every row; the last three are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(bands, rows)
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for a, b in _parts(texts):
                sets = shingle_sets(texts[a:b], size)
                full = [i for i, x in enumerate(sets) if len(x)]
                sign = signer.sign([sets[i] for i in full])
                keys, sketches = signer.band_keys(sign), signer.odd_sketches(sign)
                at = dict(zip(full, range(len(full)), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(a, b - a) for k in range(3)),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([set_id(x) if len(x) else None for x in sets], pa.int64()),
                        pa.array([keys[at[i]] if i in at else None for i in range(b - a)], pa.list_(pa.int64())),
                        pa.array([sketches[at[i]].tobytes() if i in at else None for i in range(b - a)], pa.binary()),
                    ],
                    ["doc_id", "did", "tie", "n_shingles", "node", "bands", "sketch"],
                )
        give_back()

    return _rows(docs).mapInArrow(run, "doc_id long, did long, tie long, n_shingles long, node long, bands array<long>, sketch binary")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, sset (the set as bytes) for the nodes of ``wanted`` (did, tie, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _parts(texts):
                sets = shingle_sets(texts[a:b], size)
                yield pa.RecordBatch.from_arrays([pa.array([set_id(x) if len(x) else None for x in sets], pa.int64()), batch.column(0).slice(a, b - a), pa.array([x.tobytes() for x in sets], pa.binary())], ["found", "node", "sset"])
        give_back()

    rows = _rows(docs).join(wanted, ["did", "tie"]).select("node", "text").mapInArrow(run, "found long, node long, sset binary")
    return rows.where("found = node").select("node", "sset").dropDuplicates(["node"])


class _Linked:
    """Which of the nodes of a block are linked already."""

    def __init__(self, labels: list):
        self.parent = list(range(len(labels)))
        first: dict = {}
        for i, x in enumerate(labels):
            if x is not None:
                self.join(i, first.setdefault(x, i))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[a] = b
        return a != b


def _confirmed(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """100 * |a & b| >= threshold * |a | b|."""
    if min(len(a), len(b)) * 100 < threshold * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= threshold * (len(a) + len(b) - both)


def links_of_block(nodes: list[int], sketches: np.ndarray, sets: list[np.ndarray], labels: list, left: np.ndarray, right: np.ndarray, threshold: int, limit: float) -> list[tuple[int, int]]:
    """Links that join parts: pairs of a node in ``left`` (bool) with one in ``right``, on full sets."""
    linked, rows, found = _Linked(labels), np.flatnonzero(left), []
    pairs = []
    for i in rows.tolist():
        distance = np.bitwise_count(sketches[i] ^ sketches).sum(axis=1)
        near = np.flatnonzero((distance <= limit) & right)
        near = near[(near > i) | ~left[near] | ~right[i]]
        pairs.append(np.stack([distance[near], np.full(len(near), i), near], axis=1).astype(np.int64))
    every = np.concatenate(pairs) if pairs else np.zeros((0, 3), np.int64)
    for _, i, j in every[np.argsort(every[:, 0], kind="stable")].tolist():
        if i != j and linked.find(i) != linked.find(j) and _confirmed(sets[i], sets[j], threshold):
            linked.join(i, j)
            found.append((nodes[i], nodes[j]))
    return found


def _block_links(rows: DataFrame, keys: list[str], threshold: int, limit: float) -> DataFrame:
    """Links of each group of rows (keys, node, sketch, sset, label, l, r) with equal keys."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(block: pa.Table) -> pa.Table:
        nodes = block["node"].to_pylist()
        sketches = np.frombuffer(b"".join(block["sketch"].to_pylist()), np.uint64).reshape(len(nodes), -1)
        sets = [np.frombuffer(x, np.uint64) for x in block["sset"].to_pylist()]
        left, right = (np.array(block[k].to_pylist(), bool) for k in ("l", "r"))
        found = links_of_block(nodes, sketches, sets, block["label"].to_pylist(), left, right, threshold, limit)
        return pa.table([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], schema=schema)

    return rows.groupBy(*keys).applyInArrow(run, "u long, v long")


def _of_group(rows: DataFrame, groups: DataFrame, how: str = "inner") -> DataFrame:
    """Rows (pivot, node, ...) with what ``groups`` (pivot, ...) says of their group. Groups are repeated for each salt
    and rows dealt by pivot and salt, so a large group is not one task's."""
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["pivot", "salt"], how).drop("salt")


def near_duplicate_links(docs: DataFrame, signed: DataFrame, size: int, threshold: int = THRESHOLD, block_nodes: int = BLOCK_NODES, without_id: bool = False) -> DataFrame:
    """(u, v): links between nodes, enough of them to give the components of all links. Rows without doc_id take part
    if ``without_id`` says so."""
    limit = odd_distance_limit(min(SKETCH_SIMILARITY, threshold / 100 - 0.14))
    have = signed.where(F.col("node").isNotNull() & (F.lit(without_id) | F.col("doc_id").isNotNull()))
    first = have.groupBy("node").agg(F.min(F.struct("did", "tie")).alias("first")).select("node", "first.*")
    # Rows of one node have equal bands and sketches.
    nodes = have.select("node", "bands", "sketch").dropDuplicates(["node"])
    keys = nodes.select("node", F.explode("bands").alias("band"))
    pivots = keys.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    # Each node of a pivot's group once; ``n`` is 2 where they only meet in keys that have no third node.
    met = durable(keys.join(pivots, "band").where("node <> pivot").groupBy("pivot", "node").agg(F.max("n").alias("n")), "met")
    sketch = nodes.select("node", "sketch")
    two = met.where("n = 2").join(sketch, "node").join(sketch.select(F.col("node").alias("pivot"), F.col("sketch").alias("other")), "pivot")
    word = lambda name, i: F.conv(F.hex(F.substring(name, 8 * i + 1, 8)), 16, -10).cast("long")
    distance = sum((F.bit_count(word("sketch", i).bitwiseXOR(word("other", i))) for i in range(SKETCH_BITS // 64)), F.lit(0))
    members = durable(met.where("n > 2").select("pivot", "node").unionByName(two.where(distance <= F.lit(limit)).select("pivot", "node")), "members")
    members = members.unionByName(members.select("pivot", F.col("pivot").alias("node")).distinct())

    wanted = members.select("node").distinct().join(first, "node")
    sets = _sets(docs, wanted, size).join(sketch, "node")
    sets = durable(sets, "sets")
    sizes = members.join(sets.select("node", F.length("sset").alias("bytes")), "node").groupBy("pivot").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    sizes = sizes.select("pivot", F.greatest(F.ceil(F.col("n") / block_nodes), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")).where("blocks > 1")
    placed = _of_group(members, sizes, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = durable(placed.withColumn("block", F.pmod(F.xxhash64("node", "pivot"), F.col("blocks")).cast("int")), "placed")

    # Within a block; the pivot stands in every block of its group.
    own = placed.where("node <> pivot").select("pivot", "block", "node")
    pivot_rows = placed.where("node = pivot").select("pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "node")
    flags = {"label": F.lit(None).cast("long"), "l": F.lit(True), "r": F.lit(True)}
    links = durable(_block_links(own.unionByName(pivot_rows).join(sets, "node").withColumns(flags), ["pivot", "block"], threshold, limit), "links")

    # Across blocks: nodes that are not in the largest part of their group meet all others.
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return links
    label = components(links).withColumnRenamed("label", "part")
    parted = durable(large.join(label, "node", "left").withColumn("label", F.coalesce("part", "node")).drop("part"), "parted")
    count = parted.groupBy("pivot", "label").agg(F.count("*").alias("n"))
    most = count.groupBy("pivot").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("parts")).where("parts > 1")
    parted = _of_group(parted, most).withColumn("out", F.col("label") != F.col("most.label"))
    # Nodes outside the largest part are dealt anew to blocks of their own: their number is smaller.
    outside = parted.where("out").groupBy("pivot").agg(F.ceil(F.count("*") / block_nodes).cast("int").alias("lefts"))
    parted = _of_group(parted, outside)
    mine = parted.where("out").select("pivot", F.pmod(F.xxhash64("node"), F.col("lefts")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), "node", "label", F.lit(True).alias("l"), F.lit(False).alias("r"))
    theirs = parted.select("pivot", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("i"), F.col("block").alias("j"), "node", "label", F.lit(False).alias("l"), F.lit(True).alias("r"))
    # A node may stand on both sides of a block: one row then.
    both = mine.unionByName(theirs).groupBy("pivot", "i", "j", "node").agg(F.first("label").alias("label"), F.max("l").alias("l"), F.max("r").alias("r"))
    more = _block_links(both.join(sets, "node"), ["pivot", "i", "j"], threshold, limit)
    return links.unionByName(durable(more, "links"))


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = THRESHOLD, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text, ...)."""
    signed = durable(signatures(docs, size), "signed")
    links = near_duplicate_links(docs, signed, size, threshold, block_nodes)
    label = components(links)
    nodes = signed.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = nodes.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = labelled.join(labelled.groupBy("label").agg(F.min("least").alias("component")), "label").select("node", "component")
    rows = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
    out = rows.join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, size: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of docs, one document of each group: that with the smallest doc_id (then the smallest text hash); a
    row without doc_id stays only if the group has none with one. Rows are judged by doc_id and text, so different
    texts under one doc_id are different documents. Of rows equal in both, the one whose other columns sort first as
    JSON stays. Rows without shingles are alike nothing and all stay. Columns keep their names and values."""
    signed = durable(signatures(docs, size), "signed")
    label = components(near_duplicate_links(docs, signed, size, threshold, without_id=True))
    # The last field tells the one row from repeated ones.
    full = signed.where("node is not null").groupBy("node", "did", "tie").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    least = full.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie", "did", "n")).alias("least"))
    labelled = least.join(label, "node", "left").groupBy(F.coalesce("label", "node")).agg(F.min("least").alias("least"))
    did, tie, many = unused(docs, "did", "tie", "many")
    kept = labelled.select(F.col("least.did").alias(did), F.col("least.tie").alias(tie), (F.col("least.n") > 1).alias(many))
    empty = signed.where("node is null").select(F.col("did").alias(did), F.col("tie").alias(tie), F.lit(False).alias(many)).distinct()
    kept = durable(kept.unionByName(empty), "kept")
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    named = docs.withColumns({did: F.coalesce(doc_id, F.xxhash64(F.lit("id"), text)), tie: F.xxhash64(text)}).join(kept, [did, tie])
    out = named.where(~F.col(many)).select(*docs.columns)
    if kept.where(many).isEmpty():
        return out
    row = F.struct(*docs.columns)
    one = named.where(many).groupBy(did, tie).agg(F.min_by(row, F.to_json(row)).alias(many)).select(f"{many}.*")
    return out.unionByName(one)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


#: All pairs of documents that share a shingle: for small tables only.
ORACLE = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (na + nb - shared)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS doc_id, a AS other FROM both_ways UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id, s.doc_id = coalesce(l.component_id, s.doc_id) AS kept
FROM s LEFT JOIN least l ON l.doc_id = s.doc_id
"""
