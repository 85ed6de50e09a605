"""Operator 4: quality by perplexity under an interpolated modified Kneser-Ney model of character 5-grams.

1. Training. 5-grams of the trusted documents (labels with quality 1, outside the held-out third) are counted in
   the scan and summed by gram. Lower orders have continuation counts; discounts come from the counts of counts of
   each order; every gram gets its discounted share (alpha) and every context its back-off weight (gamma). All of
   this is grouped and joined by gram.
2. Scoring. Documents are read by split of a file; a split's distinct grams of all orders are joined, sharded by
   gram, with the model, and the matches are written to the shared folder, a directory a split. The second scan reads
   the directory of its split and adds up log-probabilities, so neither the model nor the texts go to one place. Were
   files split another way then, the directory would be missing, and the job fails rather than give other numbers.
3. Thresholds. Perplexity is compared with a quantile over the trusted documents of the held-out third of the
   same language (all languages, where a language has none; no limit, where there are none at all).

What a task holds is bounded by the distinct grams of one split. Digits count as one character; texts are
padded in front. The first pass emits each gram once a task, whatever its number of occurrences.

Edge cases: null and empty texts have no perplexity and are not kept; a null lang is a language of its own; a row
without doc_id is scored but never trusted; labels that contradict each other count as not trusted; without trusted
text every character is equally likely and all texts with characters are kept. Repeated rows repeat, and rows that
tie on doc_id are scored each by its own text; a perplexity equal to the threshold is kept. Very long texts are
scored whole. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm.common import durable, filesystem, fresh_path, give_back, table
from waymesh.llm.op01_language import held_out, parts
from waymesh.llm.wordhash import GOLDEN, mix

ORDER = 5
QUANTILE = 0.99
PAD = "\x02"
_PAD_CODE, _STEP = np.uint32(2), np.uint64(0x9AB5D9A1F3C7E54B)
_TABLE_BITS = 22
#: A key that stands in every split and in the model: it tells that the matches of a split are there.
_PRESENT = 0


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points with ORDER - 1 pads before each text, number of code points of each text)."""
    own = np.frombuffer((PAD * (ORDER - 1)).join(["", *texts]).encode("utf-32-le", "surrogatepass"), "<u4").copy()
    own[(own >= 48) & (own <= 57)] = 48
    return own, np.fromiter(map(len, texts), np.int64, len(texts))


def _scored(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of the texts' own code points."""
    return np.arange(int(counts.sum())) + np.repeat((ORDER - 1) * np.arange(1, len(counts) + 1), counts)


def _keys(codes: np.ndarray, order: int) -> np.ndarray:
    """The key of the gram of each order that ends at each place; the first places of a batch wrap and are pads."""
    c = mix((codes.astype(np.uint64) + np.uint64(1)) * GOLDEN)
    total = np.zeros(len(c), np.uint64)
    for k in range(order):
        part = np.zeros_like(c)
        part[k:] = c[: len(c) - k]
        total = total * _STEP + part
    return mix(total + np.uint64(order))


def gram_key(gram: str) -> int:
    """The same for one gram, signed."""
    codes = np.frombuffer(gram.encode("utf-32-le", "surrogatepass"), "<u4")
    return int(_keys(codes, len(codes))[-1:].view(np.int64)[0])


def _decode(codes: np.ndarray, ends: np.ndarray) -> list[str]:
    rows = codes[ends[:, None] + np.arange(1 - ORDER, 1)]
    text = rows.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [text[i : i + ORDER] for i in range(0, len(text), ORDER)]


def count_grams(docs: DataFrame) -> DataFrame:
    """gram, n: the 5-grams of all texts, counted in each task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            texts = [x for x in batch.column(0).to_pylist() if x]
            for a, b in parts(texts):
                codes, counts = _codes(texts[a:b])
                at = _scored(codes, counts)
                _, first, n = np.unique(_keys(codes, ORDER)[at], return_index=True, return_counts=True)
                for gram, k in zip(_decode(codes, at[first]), n.tolist(), strict=True):
                    held[gram] = held.get(gram, 0) + k
                if len(held) > 500_000:
                    yield _counted(held)
                    held = {}
        if held:
            yield _counted(held)

    def _counted(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([g.encode("utf-8", "surrogatepass") for g in held], pa.binary()), pa.array(list(held.values()), pa.int64())], ["raw", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "raw binary, n long")
    return found.select(F.col("raw").cast("string").alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Of counts 1, 2 and 3 or more; four numbers come to the driver."""
    n = {r.n: r["count"] for r in counts.where("n <= 4").groupBy("n").count().collect()}
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    told = [k - (k + 1) * y * b / a if a and b else 0.75 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(told, 1))


class Model:
    """``grams``: key, alpha, gamma. ``base``: the probability of a character never seen, before all back-off."""

    def __init__(self, grams: DataFrame, empty_gamma: float, uniform: float):
        self.grams, self.empty_gamma, self.uniform = grams, empty_gamma, uniform


def train(trusted: DataFrame) -> Model:
    """The model of texts (text, ...)."""
    counts = durable(count_grams(trusted), "grams")
    alphas, gammas, empty_gamma, vocabulary = [], [], 1.0, 0
    for order in range(ORDER, 0, -1):
        d1, d2, d3 = discounts(counts)
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        rows = counts.withColumn("context", F.substring("gram", 1, order - 1)).withColumn("cut", cut)
        totals = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("freed"))
        alphas.append(rows.join(totals, "context").select("gram", ((F.col("n") - F.col("cut")) / F.col("total")).alias("alpha"), F.lit(None).cast("double").alias("gamma")))
        if order > 1:
            gammas.append(totals.select(F.col("context").alias("gram"), F.lit(None).cast("double").alias("alpha"), (F.col("freed") / F.col("total")).alias("gamma")))
            # Continuation counts: in how many grams one longer it stands at the end.
            counts = durable(counts.groupBy(F.substring("gram", 2, order - 1).alias("gram")).agg(F.count("*").alias("n")), "grams")
        else:
            last = totals.agg(F.first(F.col("freed") / F.col("total")).alias("gamma"), F.count("*")).first()
            vocabulary = counts.count()
            empty_gamma = last.gamma if last.gamma is not None else 1.0
    every = alphas[0]
    for part in [*alphas[1:], *gammas]:
        every = every.unionByName(part)
    merged = every.groupBy("gram").agg(F.max("alpha").alias("alpha"), F.max("gamma").alias("gamma"))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([gram_key(g) for g in batch.column(0).to_pylist()], pa.int64()), batch.column(1), batch.column(2)], ["key", "alpha", "gamma"])

    keyed = merged.select("gram", F.coalesce("alpha", F.lit(0.0)).alias("alpha"), F.coalesce("gamma", F.lit(1.0)).alias("gamma")).mapInArrow(key, "key long, alpha double, gamma double")
    return Model(durable(keyed, "model"), float(empty_gamma), 1.0 / (vocabulary + 1))


class _Seen:
    """A direct-mapped table of keys: says which were not met lately, and holds a value for each."""

    def __init__(self, bits: int = _TABLE_BITS):
        self.shift = np.uint64(64 - bits)
        self.key = np.zeros(1 << bits, np.uint64)
        self.value = np.zeros(1 << bits, np.float32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> self.shift).astype(np.int64)


def _block_grams(docs: DataFrame) -> DataFrame:
    """block, key: the distinct grams of all orders of each block of the input, once a task, and _PRESENT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = None, None
        for batch in batches:
            blocks, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for own in sorted(set(blocks)):
                if own != block:
                    block, seen = own, [_Seen() for _ in range(2)]
                    yield pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array([_PRESENT], pa.int64())], ["block", "key"])
                mine = [t for t, b in zip(texts, blocks, strict=True) if b == own and t]
                for a, b in parts(mine, 1_000_000):
                    codes, counts = _codes(mine[a:b])
                    at = _scored(codes, counts)
                    full = _keys(codes, ORDER)[at]
                    slot = seen[0].slots(full)
                    new = np.flatnonzero(seen[0].key[slot] != full)
                    seen[0].key[slot[new]] = full[new]
                    _, first = np.unique(full[new], return_index=True)
                    ends = at[new[first]]
                    # Each new 5-gram with its suffixes, and the contexts of all of them.
                    keys = np.unique(np.concatenate([_keys_at(codes, ends, k) for k in range(1, ORDER + 1)] + [_keys_at(codes, ends - 1, k) for k in range(1, ORDER)]))
                    slot = seen[1].slots(keys)
                    keys = keys[seen[1].key[slot] != keys]
                    seen[1].key[seen[1].slots(keys)] = keys
                    yield pa.RecordBatch.from_arrays([pa.array([own] * len(keys), pa.int64()), pa.array(keys.view(np.int64))], ["block", "key"])

    return docs.select("block", "text").mapInArrow(run, "block long, key long")


def _keys_at(codes: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """The keys of the grams of an order that end at given places."""
    total = np.zeros(len(ends), np.uint64)
    for k in range(order):
        at = ends - k
        c = mix((codes[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1)) * GOLDEN)
        total = total * _STEP + np.where(at >= 0, c, np.uint64(0))
    return mix(total + np.uint64(order))


class _Scorer:
    """Log-probabilities of the characters of one split's texts, from the matches of its grams."""

    def __init__(self, keys: np.ndarray, alpha: np.ndarray, gamma: np.ndarray, empty_gamma: float, uniform: float):
        order = np.argsort(keys)
        self.keys, self.alpha, self.gamma = keys[order], alpha[order], gamma[order]
        self.empty_gamma, self.uniform, self.seen = empty_gamma, uniform, _Seen()

    def _of(self, keys: np.ndarray, values: np.ndarray, other: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), other)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, values[at], other)

    def _chain(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        p = self._of(_keys_at(codes, ends, 1), self.alpha, 0.0) + self.empty_gamma * self.uniform
        for k in range(2, ORDER + 1):
            p = self._of(_keys_at(codes, ends, k), self.alpha, 0.0) + self._of(_keys_at(codes, ends - 1, k - 1), self.gamma, 1.0) * p
        return np.log(p)

    def perplexities(self, texts: list[str]) -> np.ndarray:
        """NaN for texts without a character."""
        codes, counts = _codes(texts)
        at = _scored(codes, counts)
        full = _keys(codes, ORDER)[at]
        slot = self.seen.slots(full)
        out = self.seen.value[slot].astype(np.float64)
        new = np.flatnonzero(self.seen.key[slot] != full)
        if len(new):
            _, first, back = np.unique(full[new], return_index=True, return_inverse=True)
            value = self._chain(codes, at[new[first]]).astype(np.float32)
            out[new] = value[back]
            self.seen.key[slot[new]], self.seen.value[slot[new]] = full[new], value[back]
        full_texts = counts > 0
        total = np.full(len(texts), np.nan)
        if full_texts.any():
            total[full_texts] = np.add.reduceat(out, (np.cumsum(counts) - counts)[full_texts]) / counts[full_texts]
        return np.exp(-total)


def perplexity(docs: DataFrame, model: Model, stored: bool = False) -> DataFrame:
    """doc_id, lang, perplexity for every row of docs (doc_id, text, lang, ...).

    ``stored``: docs reads files as they are (no join or shuffle before), so each row knows its split; else docs
    are first written to the shared folder.
    """
    spark = docs.sparkSession
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # Both scans must split files alike, also if executors come or go between them.
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    lean = (lean if stored else durable(lean, "texts")).withColumn("block", F.xxhash64(F.input_file_name(), F.input_file_block_start(), F.input_file_block_length()))
    grams = _block_grams(lean).repartition("key").distinct()
    path = fresh_path(spark, "matches")
    known = model.grams.unionByName(spark.range(1).select(F.lit(_PRESENT).cast("long").alias("key"), F.lit(0.0).alias("alpha"), F.lit(1.0).alias("gamma")))
    grams.join(known, "key").repartition("block").sortWithinPartitions("block").write.partitionBy("block").parquet(path)
    empty_gamma, uniform = model.empty_gamma, model.uniform

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, scorer = None, None
        for batch in batches:
            blocks, texts = batch.column(3).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
            out = np.full(len(texts), np.nan)
            for own in sorted(set(blocks)):
                if own != block:
                    block, scorer = own, _Scorer(*_matches(f"{path}/block={own}"), empty_gamma, uniform)
                mine = [i for i, b in enumerate(blocks) if b == own]
                for a, b in parts([texts[i] for i in mine], 1_000_000):
                    out[mine[a:b]] = scorer.perplexities([texts[i] for i in mine[a:b]])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.float64(), mask=np.isnan(out))], ["doc_id", "lang", "perplexity"])
        give_back()

    return lean.mapInArrow(run, "doc_id long, lang string, perplexity double")


def _matches(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    from pyarrow import fs

    files, at = filesystem(uri)
    found = [x.path for x in files.get_file_info(fs.FileSelector(at, allow_not_found=True)) if x.path.endswith(".parquet")]
    tables = [pq.read_table(files.open_input_file(p)) for p in found]
    cat = lambda name, kind: np.concatenate([np.zeros(0, kind), *(t[name].to_numpy() for t in tables)])
    keys = cat("key", np.int64).astype(np.int64)
    if not (keys == _PRESENT).any():
        raise RuntimeError("files were split another way by the second scan: set spark.sql.files.minPartitionNum and run again")
    return keys.view(np.uint64), cat("alpha", np.float64), cat("gamma", np.float64)


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, stored: bool = False) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept for every row of docs (doc_id, text, lang, ...)."""
    good = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("good_id")).agg(F.min("quality").alias("least")).where("least = 1").select("good_id")
    chosen = docs.where("doc_id is not null").where(~held_out(F.col("doc_id")))
    model = train(chosen.select(F.col("doc_id").cast("long").alias("good_id"), "text").join(_small(good), "good_id", "left_semi"))
    scored = durable(perplexity(docs, model, stored), "scored")
    judges = scored.where(held_out(F.col("doc_id")) & F.col("perplexity").isNotNull()).join(good, F.col("doc_id") == F.col("good_id"), "left_semi")
    cut = lambda: F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)).alias("threshold")
    by_lang = judges.groupBy(F.col("lang").alias("of_lang")).agg(cut())
    overall = judges.agg(cut()).first().threshold
    out = scored.join(F.broadcast(by_lang) if by_lang.count() <= 10_000 else by_lang, F.col("lang").eqNullSafe(F.col("of_lang")), "left").drop("of_lang")
    out = out.withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double"), F.lit(float("inf"))))
    return out.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))


def _small(ids: DataFrame, most: int = 5_000_000) -> DataFrame:
    """Ids alone, sent to all tasks up to a stated number (40 MB); beyond it the join is shuffled."""
    return F.broadcast(ids) if ids.count() <= most else ids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), stored=True)
