"""Operator 9: mix sources to target weights. DataFrame expressions only.

Every document gets a hash-random key. The key's leading bits are its bucket within its source, so buckets
are ranges of the key, and the running sum over a source's bucket totals tells in which bucket the source's
budget ends. Only the documents of that one bucket of each source are sorted by key for their own running
sum; all others are decided by their bucket. A target above the source's size repeats whole epochs; the last
one is cut at the exact budget.

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating; they share all words by weight;
a target above ``most_epochs`` times its source's size stops there and the excess goes to the others by
weight, until none is above. If every source is at its limit, the excess is not placed.

The number of buckets follows the size of the source, so a bucket holds about ``bucket_rows`` documents
whatever share of the rows the source has. Sources are a small dimension; nothing here assumes that but the
weights' order, which ranks them over one row a source.

Edge cases: a null text has 0 words and is taken 0 words; a null source is a source; sources without a word
have target 0; repeated rows are rows of their own (equal keys are ordered by doc_id, then by a hash of the
text, and full ties share their sum evenly by position); rows without doc_id get their key from their text; an
empty table gives an empty result; columns with the names used here do not clash, since ``mix`` reads only
doc_id, text and source and ``mixed`` chooses names that are free; a very long text is one document like others,
and the cut of the last epoch may fall inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymesh.llm.common import durable, table, unused

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BUCKET_ROWS = 4_000


def word_count(text: Column) -> Column:
    """Number of runs of what is not ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def random_key(seed: Column) -> Column:
    """A uniform key in 0 .. 2**48 - 1 that other engines can compute too: the head of an MD5."""
    return F.conv(F.substring(F.md5(seed), 1, 12), 16, 10).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target for one row a source (source, source_size, ...).

    The limits bind first where size / weight is least, so a running sum in that order finds all of them:
    source k is at its limit iff what is left for it and all later ones, by weight, exceeds its limit.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight.cast("double")).withColumn("limit", F.col("source_size") * F.lit(float(most_epochs)))
    tight = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    after = tight.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    stepped = ranked.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(after))
    stepped = stepped.withColumn("bound", F.col("left") * F.col("weight") > F.col("limit") * F.col("open"))
    # Bounds are a prefix of the order; the first unbound row's remainder is shared by all unbound ones.
    free = F.coalesce(F.min(F.when(~F.col("bound"), F.struct(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"), (F.col("left") / F.col("open")).alias("rate")))).over(every)["rate"], F.lit(0.0))
    return stepped.select(*totals.columns, F.when(F.col("bound"), F.col("limit")).otherwise(F.col("weight") * free).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS, bucket_rows: int = BUCKET_ROWS, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, taken, whole for every row of docs (doc_id, text, source, ...).

    ``taken`` words are in the mix, repeats counted: the whole document once for every full epoch, and in the
    last epoch as many of its words as the budget still holds. ``whole`` counts how often the mix takes the
    document if only whole documents can be taken: one is in the last epoch iff at least half of it is.
    """
    return _rows_of_mix(docs, weights, most_epochs, bucket_rows, seed).select("doc_id", "size", "source_size", "target", "taken", "whole")


def _rows_of_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS, bucket_rows: int = BUCKET_ROWS, seed: str = "mix") -> DataFrame:
    """``mix`` with the columns source and tie (a hash of the text) of each row."""
    # A document without doc_id is told by its text, so that such rows do not share one key.
    key = random_key(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.col("text")), F.lit(""))))
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), key.alias("key"), F.xxhash64("text").alias("tie"))
    rows = durable(lean, "sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = targets(totals, weights, most_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs).withColumn("rest", (F.floor("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    plan = durable(plan.withColumn("width", F.lit(2.0**48) / F.ceil(F.col("n") / F.lit(bucket_rows))), "plan")

    here = F.col("p.source").eqNullSafe(F.col("r.source"))
    bucket = F.floor(F.col("key") / F.col("width"))
    dealt = rows.alias("r").join(plan.alias("p"), here).select("r.*", "source_size", "target", "epochs", "rest", bucket.alias("bucket"))
    sums = dealt.groupBy("source", "bucket", "rest").agg(F.sum("size").alias("held"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("held").over(running), F.lit(0)))
    # The bucket in which the budget ends, and what earlier buckets have taken of it.
    cut = sums.where((F.col("ahead") <= F.col("rest")) & (F.col("rest") < F.col("ahead") + F.col("held"))).select(F.col("source").alias("cut_source"), F.col("bucket").alias("cut"), "ahead")
    cut = durable(cut, "cuts")
    known = dealt.join(cut, F.col("cut_source").eqNullSafe(F.col("source")), "left")
    # Sources without a word have no cut, and no words to take.
    inside = F.col("bucket") == F.col("cut")
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    edge = known.where(inside).withColumn("start", F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    others = known.where(~inside | F.col("cut").isNull()).withColumn("start", F.when(F.col("bucket") < F.col("cut"), F.lit(-1)).otherwise(F.col("rest")).cast("long"))
    fitting = F.when(F.col("start") < 0, F.col("size")).otherwise(F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start"))))
    both = edge.unionByName(others).withColumn("fitting", fitting.cast("long"))
    taken = (F.col("epochs") * F.col("size") + F.col("fitting")).cast("long")
    whole = (F.col("epochs") + F.when((F.col("size") > 0) & (F.col("fitting") * 2 >= F.col("size")), 1).otherwise(0)).cast("int")
    return both.select("doc_id", "source", "tie", "size", "source_size", "target", taken.alias("taken"), whole.alias("whole"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs as often as the mix takes them whole, decided row by row: rows that share a doc_id, or have
    none, but differ in source or text have decisions of their own. Rows equal in all three may stand for each
    other: if the cut of the last epoch falls among them, as many of them are taken once more as the mix takes."""
    n, least = F.count("*"), F.min("whole")
    decided = _rows_of_mix(docs, **settings).groupBy("doc_id", "source", "tie").agg(n.alias("n"), least.alias("least"), (F.sum("whole") - n * least).alias("more"))
    own = unused(docs, "id", "of", "tie", "n", "least", "more", "times", "copy")
    id_, of, tie, n, least, more, times, copy = own
    decided = durable(decided.select("doc_id", "source", "tie", "n", "least", "more").toDF(*own[:6]), "decided")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & F.col("source").cast("string").eqNullSafe(F.col(of)) & (F.xxhash64("text") == F.col(tie))
    cut = (F.col(more) > 0) & (F.col(more) < F.col(n))
    again = docs.join(decided.where(~cut), same).withColumn(times, F.col(least) + F.when(F.col(more) > 0, 1).otherwise(0))
    if not decided.where(cut).isEmpty():
        place = F.row_number().over(Window.partitionBy(id_, of, tie).orderBy(n))
        parted = docs.join(decided.where(cut), same).withColumn(times, F.col(least) + F.when(place <= F.col(more), 1).otherwise(0))
        again = again.unionByName(parted)
    return again.where(F.col(times) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || text, '')), 1, 12) AS BIGINT) AS key
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight
  FROM sized GROUP BY source),
stepped AS (
  SELECT *, 3.0 * source_size AS lim,
         sum(source_size) OVER () - coalesce(sum(3.0 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM totals),
bound AS (SELECT *, remaining * weight > lim * open_weight AS at_limit FROM stepped),
targets AS (
  SELECT source, source_size,
         CAST(CASE WHEN at_limit THEN lim ELSE weight * (SELECT arg_min(remaining / open_weight, lim / weight) FROM bound WHERE NOT at_limit) END AS DOUBLE) AS target
  FROM bound),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(floor(t.target) / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
         CAST(floor(t.target) AS BIGINT) AS words,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, words - epochs * source_size - start)) AS BIGINT) AS taken,
       CAST(epochs + CASE WHEN size > 0 AND 2 * greatest(0, least(size, words - epochs * source_size - start)) >= size THEN 1 ELSE 0 END AS INTEGER) AS whole
FROM placed
"""
