"""Operator 3: document fingerprints by a homomorphic multiset hash.

Every paragraph (the text between line feeds) is hashed to a wide vector; a document's fingerprint is the sum
of its paragraphs' vectors. The order of paragraphs does not matter, and inserting or deleting one adds or
subtracts its vector. The vector has two parts:

* 8 lanes modulo 2**64, from the whole paragraph: they tell multisets of paragraphs apart;
* 128 lanes modulo 2**32, the sum over the paragraph's word pairs of vectors of +1 and -1: the squared length
  of a difference estimates in how many pairs two documents differ, so likeness needs no text.

The likeness of two fingerprints is 2 <a, b> / (<a, a> + <b, b>) over the second part, kept within 0 and 1:
1 for equal multisets of pairs, near 0 (standard error 0.09) for disjoint ones. Two fingerprints without
pairs are alike (1) iff equal.

A fingerprint is text: base64 of 8 little-endian uint64 and 128 little-endian uint32.

The query also fingerprints an edited text, whose second half comes from the next document in descending
doc_id. Documents are dealt into ranges of doc_id; the first document of each range is also sent to the range
before, so one shuffle of the texts is all, and each task holds two documents besides its batch.

Edge cases: a null text is empty: n_chars 0, the zero fingerprint of no paragraphs. An empty line is a
paragraph. A null doc_id sorts last. Rows that tie on doc_id follow one another in the order of their texts, equal
rows too. A single document is its own next. An empty table gives an empty result. Other columns are ignored. A
very long text is done whole, alone with its neighbours; ids are compared as 64-bit integers.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm.common import give_back, table
from waymesh.llm.wordhash import GOLDEN, mix, word_hashes

WIDE, LANES = 8, 128
_WIDE_SEEDS = mix(np.arange(1, WIDE + 1, dtype=np.uint64) * GOLDEN)
_LANE_SEEDS = mix(np.arange(101, 101 + LANES // 64, dtype=np.uint64) * GOLDEN)
_STEP = 200_000


def _paragraph_lanes(texts: list[str]) -> np.ndarray:
    """(texts, WIDE) uint64: sums over paragraphs of vectors hashed from them, modulo 2**64."""
    out = np.zeros((len(texts), WIDE), np.uint64)
    digest, cut = xxhash.xxh3_128_intdigest, [x.split("\n") if x else [] for x in texts]
    if not (total := sum(map(len, cut))):
        return out
    whole = b"".join(digest(p.encode("utf-8", "surrogatepass")).to_bytes(16, "little") for x in cut for p in x)
    keys = np.frombuffer(whole, np.uint64).reshape(total, 2)
    counts = np.fromiter(map(len, cut), np.int64, len(cut))
    full = counts > 0
    start = (np.cumsum(counts) - counts)[full]
    for k in range(WIDE):
        # Both halves of the 128-bit key go through the mixer: a lane is no function of one half alone.
        out[full, k] = np.add.reduceat(mix(mix(keys[:, 0] ^ _WIDE_SEEDS[k]) + keys[:, 1] * GOLDEN), start)
    return out


def _pair_lanes(texts: list[str]) -> np.ndarray:
    """(texts, LANES) int64: sums over word pairs of +1 and -1; pairs do not cross a line feed."""
    out = np.zeros((len(texts), LANES), np.int64)
    lines = [x.split("\n") if x else [] for x in texts]
    word, counts = word_hashes([p for x in lines for p in x])
    if not len(word):
        return out
    of_line = np.repeat(np.arange(len(counts)), counts)
    of_text = np.repeat(np.arange(len(texts)), np.fromiter(map(len, lines), np.int64, len(lines)))[of_line]
    # A line of one word has that word; a longer one the pairs of neighbours.
    first = np.ones(len(word), bool)
    first[1:] = of_line[1:] != of_line[:-1]
    keep = ~first | (counts[of_line] == 1)
    before = np.zeros_like(word)
    before[1:] = word[:-1]
    before[first] = 0
    key, owner = mix(before * GOLDEN + word)[keep], of_text[keep]
    for a in range(0, len(key), _STEP):
        part, own = key[a : a + _STEP], owner[a : a + _STEP]
        edge = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        size = np.diff(np.append(edge, len(own)))
        for k in range(LANES // 64):
            bits = np.unpackbits(mix(part ^ _LANE_SEEDS[k]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, edge, axis=0, dtype=np.int32)
            out[own[edge], 64 * k : 64 * (k + 1)] += 2 * ones - size[:, None]
    return out


def vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The two parts of each text's fingerprint."""
    own = [x or "" for x in texts]
    return _paragraph_lanes(own), _pair_lanes(own).astype(np.uint32)


def encode(wide: np.ndarray, lanes: np.ndarray) -> list[str]:
    return [base64.b64encode(a.astype("<u8").tobytes() + b.astype("<u4").tobytes()).decode() for a, b in zip(wide, lanes, strict=True)]


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    data = base64.b64decode(fingerprint)
    return np.frombuffer(data, "<u8", WIDE), np.frombuffer(data, "<u4", LANES, 8 * WIDE)


def combine(a: str, b: str, sign: int = 1) -> str:
    """The fingerprint with b's paragraphs inserted into a's, or deleted where sign is -1."""
    (wa, la), (wb, lb) = decode(a), decode(b)
    return encode(*((x + y if sign > 0 else x - y)[None] for x, y in ((wa, wb), (la, lb))))[0]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Likeness of rows of two pairs of arrays."""
    x, y = (v[1].astype(np.uint32).view(np.int32).astype(float) for v in (a, b))
    dot, size = (x * y).sum(axis=1), (x * x + y * y).sum(axis=1)
    equal = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    return np.where(equal, 1.0, np.clip(np.divide(2 * dot, size, out=np.zeros_like(dot), where=size > 0), 0, 1))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint for every row of docs (doc_id, text, ...). No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a in range(0, len(texts), 500):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, 500), pa.array([len(x or "") for x in texts[a : a + 500]], pa.int64()), pa.array(encode(*vectors(texts[a : a + 500])), pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def edited(own: str, following: str) -> str:
    """own with its last floor(n / 2) code points replaced by the first as many (or all) of the next."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, spare) in order; each row but the spares is judged with the row after it."""
    held: list[tuple[int | None, str]] = []
    size, is_spare = 0, False

    def done(rows: list[tuple[int | None, str]]) -> pa.RecordBatch:
        texts = [t for _, t in rows]
        changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
        own, new = vectors(texts), vectors(changed)
        now, nxt = tuple(v[:-1] for v in own), tuple(v[1:] for v in own)
        sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in changed]
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in rows[:-1]], pa.int64()), pa.array([len(x) for x in texts[:-1]], pa.int64()), pa.array(sha, pa.string()), pa.array(encode(*now), pa.string()), pa.array(encode(*new), pa.string()), pa.array(likeness(now, new)), pa.array(likeness(now, nxt))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    slices = (batch.slice(a, 500) for batch in batches for a in range(0, batch.num_rows, 500))
    for part in slices:
        for doc_id, text, spare in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if is_spare and spare:
                continue  # of several rows that begin the next range, the first is the next document
            if is_spare:  # a new range begins in the same task
                if len(held) > 1:
                    yield done(held)
                held, size = [], 0
            held.append((doc_id, text or ""))
            size += len(text or "")
            is_spare = spare
            if size >= most and len(held) > 1:
                yield done(held)
                held, size = held[-1:], len(held[-1][1])
    if len(held) > 1:
        yield done(held)
    give_back()


def neighbour_fingerprints(docs: DataFrame, range_rows: int = 5_000, most_ranges: int = 20_000) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see the module's text."""
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # A range for about range_rows documents, most_ranges at most. Any list of numbers will do as borders, so it
    # does no harm that the quantiles are doubles; ids are compared as they are.
    ranges = max(1, min(most_ranges, lean.count() // range_rows))
    borders: list[int] = []
    if ranges > 1:
        found = lean.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.1 / ranges)
        borders = sorted({max(-(1 << 63), min((1 << 63) - 1, int(x))) for x in found}, reverse=True)
    # The number of borders that are at least the id, by halving steps: an id's range, in descending order.
    listed = F.lit(borders).cast("array<long>")
    steps = [1 << k for k in reversed(range(len(borders).bit_length()))]
    place = lambda at, step: F.when(F.get(listed, at + step - 1) >= F.col("doc_id"), at + step).otherwise(at)
    nth = F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), place) if borders else F.lit(0)
    placed = lean.withColumn("range", F.when(F.col("doc_id").isNull(), len(borders)).otherwise(nth).cast("int"))
    # The first row of each range also goes to the range before it, cyclically.
    heads = placed.groupBy("range").agg(F.max("doc_id").alias("doc_id")).orderBy("range").collect()
    order = [r.range for r in heads]
    spare = [(r.range, r.doc_id, order[k - 1]) for k, r in enumerate(heads)] or [(0, 0, 0)]
    goes = F.broadcast(docs.sparkSession.createDataFrame(spare, "range int, first long, before int").alias("g"))
    first = (F.col("p.range") == F.col("g.range")) & F.col("p.doc_id").eqNullSafe(F.col("g.first"))
    copies = placed.alias("p").join(goes, first).select("doc_id", "text", F.col("before").alias("range"), F.lit(True).alias("spare"))
    rows = placed.withColumn("spare", F.lit(False)).unionByName(copies)
    dealt = rows.repartitionByRange(max(1, len(order)), "range").sortWithinPartitions("range", "spare", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.select("doc_id", "text", "spare").mapInArrow(_pairs, _OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))
