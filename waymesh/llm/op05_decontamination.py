"""Operator 5: benchmark decontamination by template canonicalisation. DataFrame expressions only.

A text becomes tokens: runs of letters, and numbers. A number is the placeholder <num>, a capitalised word
within a sentence <name>, a unit right after a number <unit>; other words stand for themselves, in lower
case. Windows of five template tokens of the documents are joined by hash with those of the benchmark
items, so a question with other numbers, names or units still meets its windows.

Windows of one item that lie in one document at one offset belong together. Their slots must be consistent:
each value of a slot in the item stands for one value in the document, the most frequent one at that offset,
and windows with another one do not count. Where several changed values are equally frequent, the offset is no re-parameterisation and none of its windows count. A document is contaminated
by an item if the consistent windows are at least half of the item's windows, and at least three (all, where
the item has fewer), or if consistent windows at consecutive places of one offset span 13 tokens, whatever share
of the item that is.

A window without three words of its own is too general. It is lengthened onwards until it has three, or
backwards where the item ends before that. An item with fewer than five tokens, or with too few words to
lengthen all its windows, is one window as a whole: by its template if it has three words (or no slots), else
token by token as written, but for case. So every item with a token has a window.

Scale: documents are exploded to window hashes in the scan stage and meet the benchmark there, if its windows
number at most ``BROADCAST_WINDOWS`` (counted first); above that, a shuffled join that AQE can split. Only
matches are shuffled, and only matched documents are read a second time for their slot values.

Edge cases: null and empty texts have no windows and are never contaminated; rows that repeat a doc_id are
each judged by all rows of that doc_id; a row without doc_id is not judged and not contaminated; an
empty benchmark contaminates nothing; duplicated items count once each. Windows that tie, at one place or in
several documents, each count. Very long texts are judged whole. In scripts without spaces each character is a
token. Extra columns are not touched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm.common import durable, table, unused

WINDOW = 5
LITERALS = 3
COVERAGE = 0.5
LEAST_WINDOWS = 3
#: So many consecutive tokens of an item are a leak, whatever share of the item they are.
RUN = 13
BROADCAST_WINDOWS = 200_000
#: Kinds of windows, preferred in this order.
PLAIN, FORWARD, BACKWARD, WHOLE, EXACT = range(5)
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t oz lb lbs ml cl dl l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks "
    "month months year years meter meters metre metres kilometer kilometers kilometre kilometres mile miles inch inches foot feet yard yards gram grams "
    "kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces liter liters litre litres dollar dollars euro euros cent cents percent degree degrees mph kmh"
).split()
#: Marks a capitalised word that does not begin a sentence.
_NAME = "\ue001"
# What is rare, a capital, is looked for first.
_NAME_PATTERN = r"(?=\p{Lu}\p{Ll})(?<=[^.!?:;\s" + _NAME + r"] )"
_TOKEN_PATTERN = _NAME + r"?\p{L}+|\p{Nd}+(?:[.,:/]\p{Nd}+)*"


#: Scripts without spaces between words (Thai to Myanmar, Khmer, kana, Han): each character is a token.
#: Where a text has none of _BEYOND, which is quicker to find, it has none of these.
_BEYOND = r"[\u0E00-\x{10FFFF}]"
_SPACELESS = r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]"


def raw_tokens(text: Column) -> Column:
    """Tokens as written; a name carries its mark in front. The mark itself, in a text, counts as a space."""
    apart = F.regexp_replace(F.translate(text, _NAME, " "), _SPACELESS, " $0 ")
    plain = F.when(text.rlike(_BEYOND), apart).otherwise(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(F.regexp_replace(plain, _NAME_PATTERN, _NAME), F.lit(_TOKEN_PATTERN), F.lit(0))


def _is_number(token: Column) -> Column:
    first = F.ascii(token)
    return F.when(first < 128, first.between(48, 57)).otherwise(token.rlike(r"^\p{Nd}"))


def _kind(tokens: Column):
    def kind(token: Column, i: Column) -> Column:
        before = F.get(tokens, i - 1)
        return (
            F.when(token.startswith(_NAME), F.lit("<name>"))
            .when(_is_number(token), F.lit("<num>"))
            .when((i > 0) & _is_number(F.coalesce(before, F.lit(""))) & F.lower(token).isin(UNITS), F.lit("<unit>"))
            .otherwise(F.lower(token))
        )

    return kind


def template(tokens: Column) -> Column:
    """Template tokens of raw tokens."""
    return F.transform(tokens, _kind(tokens))


def _coded(template: Column) -> Column:
    """A template token's own hash, with 1 in its lowest bit iff it is a word and not a placeholder."""
    return F.transform(template, lambda t: F.when(t.startswith("<"), F.shiftleft(F.shiftright(F.xxhash64(t), 1), 1)).otherwise(F.xxhash64(t).bitwiseOR(F.lit(1))))


def _plain(raw: Column) -> Column:
    """Raw tokens without case and without the mark of names."""
    return F.transform(raw, lambda t: F.lower(F.replace(t, F.lit(_NAME), F.lit(""))))


def windows(frame: DataFrame, window: int, *keep: str) -> DataFrame:
    """(keep..., pos, window) of a frame with a column ``template``: hashes of its windows with words enough."""

    def one(i: Column) -> Column:
        parts = [F.get("coded", i + k) for k in range(window)]
        words = sum((p.bitwiseAND(F.lit(1)) for p in parts), F.lit(0))
        return F.when(words >= min(LITERALS, window), F.xxhash64(F.lit(window), *parts))

    every = F.when(F.size("coded") >= window, F.transform(F.sequence(F.lit(0), F.size("coded") - window), one))
    return frame.withColumn("coded", _coded(F.col("template"))).select(*keep, F.posexplode(every).alias("pos", "window")).where("window is not null")


def lengthened(frame: DataFrame, window: int, longest: int | None, *keep: str) -> DataFrame:
    """(keep..., pos, first, last, kind, window): windows with too few words, lengthened onwards (FORWARD) or
    backwards (BACKWARD) until they have enough; none longer than ``longest``. ``pos`` is where the window began
    before."""
    least = min(LITERALS, window)
    n, longest = F.size("coded"), F.size("coded") if longest is None else F.lit(longest)
    long = frame.where(F.size("template") > window).withColumn("coded", _coded(F.col("template")))
    at = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("coded", i).bitwiseAND(F.lit(1)) == 1)
    long = long.withColumn("words", at).where(F.size("words") >= least)

    def onwards(k: Column) -> Column:
        last = F.get("words", k + least - 1)
        lo = F.greatest(F.coalesce(F.get("words", k - 1), F.lit(-1)) + 1, last - longest + 1)
        return F.struct(lo.alias("lo"), F.least(F.get("words", k), last - window).alias("hi"), last.alias("end"), F.lit(FORWARD).alias("kind"))

    def back(k: Column) -> Column:
        first = F.get("words", k)
        hi = F.least(F.coalesce(F.get("words", k + least), n) - 1, first + longest - 1)
        return F.struct(F.greatest(F.get("words", k + least - 1), first + window).alias("lo"), hi.alias("hi"), first.alias("end"), F.lit(BACKWARD).alias("kind"))

    def each(s: Column) -> Column:
        def one(x: Column) -> Column:
            forward = s["kind"] == FORWARD
            first, last = F.when(forward, x).otherwise(s["end"]), F.when(forward, s["end"]).otherwise(x)
            hashed = F.xxhash64(s["kind"], last - first + 1, F.slice("coded", first + 1, last - first + 1))
            pos = F.when(forward, x).otherwise(x - window + 1)
            return F.struct(pos.alias("pos"), first.alias("first"), last.alias("last"), s["kind"].alias("kind"), hashed.alias("window"))

        return F.transform(F.sequence(s["lo"], s["hi"]), one)

    ks = F.sequence(F.lit(0), F.size("words") - least)
    spans = F.filter(F.concat(F.transform(ks, onwards), F.transform(ks, back)), lambda s: s["lo"] <= s["hi"])
    return long.select(*keep, F.explode(F.flatten(F.transform(spans, each))).alias("w")).select(*keep, "w.*")


def whole(frame: DataFrame, lengths: list[tuple[int, int]], *keep: str) -> DataFrame:
    """(keep..., pos, window) of a frame with columns ``raw`` and ``template``: hashes of the runs of tokens that may
    be a whole item, for each (kind, length): by template (WHOLE) or as written but for case (EXACT)."""

    def of(kind: int, length: int) -> Column:
        tokens = "coded" if kind == WHOLE else "plain"
        one = lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(kind), F.lit(length), F.slice(tokens, i + 1, length)).alias("window"))
        return F.when(F.size("raw") >= length, F.transform(F.sequence(F.lit(0), F.size("raw") - length), one)).otherwise(F.array().cast("array<struct<pos:int,window:bigint>>"))

    ready = frame.withColumn("coded", _coded(F.col("template"))).withColumn("plain", _plain(F.col("raw")))
    return ready.select(*keep, F.explode(F.concat(*(of(*x) for x in lengths))).alias("w")).select(*keep, "w.*")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, ipos, first, last, kind, window): one window for each place of an item; an item that is shorter than
    a window, or that has a place where no window has words enough, is one window as a whole."""
    plain = windows(items, window, "item_id").select("item_id", F.col("pos").alias("ipos"), F.struct(F.lit(PLAIN).alias("kind"), F.col("pos").alias("first"), (F.col("pos") + window - 1).alias("last"), "window").alias("w"))
    longer = lengthened(items, window, None, "item_id").select("item_id", F.col("pos").alias("ipos"), F.struct("kind", "first", "last", "window").alias("w"))
    placed = plain.unionByName(longer).groupBy("item_id", "ipos").agg(F.min("w").alias("w"))
    full = placed.groupBy("item_id").agg(F.count("*").alias("places")).join(items.select("item_id", F.size("raw").alias("n")), "item_id")
    full = full.where(F.col("places") == F.col("n") - window + 1).select("item_id").distinct()
    words = F.size(F.filter("template", lambda t: ~t.startswith("<")))
    rest = items.join(full, "item_id", "left_anti").withColumn("kind", F.when(words >= F.least(F.lit(LITERALS), F.size("raw")), WHOLE).otherwise(EXACT))
    n, tokens = F.size("raw"), {WHOLE: _coded(F.col("template")), EXACT: _plain(F.col("raw"))}
    hashed = F.when(F.col("kind") == WHOLE, F.xxhash64("kind", n, tokens[WHOLE])).otherwise(F.xxhash64("kind", n, tokens[EXACT]))
    rest = rest.select("item_id", F.lit(0).alias("ipos"), F.lit(0).alias("first"), (n - 1).alias("last"), "kind", hashed.alias("window"))
    return placed.join(full, "item_id", "left_semi").select("item_id", "ipos", "w.first", "w.last", "w.kind", "w.window").unionByName(rest)


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, item_id, windows, of): a row for each document and item that contaminates it."""
    read = benchmark.select(F.col("item_id").cast("long").alias("item_id"), raw_tokens(F.col("text")).alias("raw")).where("item_id is not null")
    items = durable(read.withColumn("template", template(F.col("raw"))).where(F.size("raw") > 0), "items")
    per_item = durable(item_windows(items, window), "item-windows")
    total = per_item.groupBy("item_id").agg(F.countDistinct("ipos").alias("of"))
    small = per_item.count() <= broadcast_windows
    near = (lambda frame: F.broadcast(frame)) if small else (lambda frame: frame)

    named = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = named.select("doc_id", raw_tokens(F.col("text")).alias("raw")).select("doc_id", "raw", template(F.col("raw")).alias("template"))
    # What the items do not have is not looked for: most benchmarks have plain windows only.
    used = per_item.select("kind", (F.col("last") - F.col("first") + 1).alias("n")).distinct().collect()
    theirs = windows(own, window, "doc_id")
    if longer := [r.n for r in used if r.kind in (FORWARD, BACKWARD)]:
        theirs = theirs.unionByName(lengthened(own, window, max(longer), "doc_id").select("doc_id", "pos", "window"))
    if lengths := sorted((r.kind, r.n) for r in used if r.kind in (WHOLE, EXACT)):
        theirs = theirs.unionByName(whole(own, lengths, "doc_id"))
    met = theirs.join(near(per_item.drop("kind")), "window")
    # Bounded by the item's length: the places of its windows that lie at one offset.
    placed = met.groupBy("doc_id", "item_id", (F.col("pos") - F.col("ipos")).alias("offset")).agg(F.collect_set(F.struct("ipos", "first", "last")).alias("at"))
    placed = durable(placed.join(near(total), "item_id"), "placed")
    hopeful = placed.groupBy("doc_id", "item_id", "of").agg(F.sum(F.size("at")).alias("n"), F.max(_long_run("at", window)).alias("run")).where(_enough(F.col("n"), coverage) | F.col("run")).select("doc_id", "item_id")
    placed = placed.join(hopeful, ["doc_id", "item_id"], "left_semi")

    matched = named.join(placed.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", _once(_plain(raw_tokens(F.col("text")))).alias("doc_raw"))
    slots = placed.join(matched, "doc_id").join(near(items.select("item_id", "raw", "template")), "item_id")
    slots = slots.withColumn("raw", _once(_plain(F.col("raw"))))
    cells = F.array_distinct(F.flatten(F.transform("at", lambda w: F.sequence(w["first"], w["last"]))))
    filled = F.filter(cells, lambda p: F.get("template", p).isin("<num>", "<name>", "<unit>"))
    slots = slots.withColumn("filled", _once(filled)).withColumn("cells", _once(F.transform("filled", lambda p: F.struct(p.alias("p"), F.get("raw", p).alias("item"), F.get("doc_raw", p + F.col("offset")).alias("doc")))))
    agreed = slots.withColumn("agreed", _once(F.transform(F.array_distinct("cells.item"), _counterpart))).where(~F.exists("agreed", lambda x: x["doc"].isNull()))
    odd = F.filter("cells", lambda c: ~F.array_contains("agreed", F.struct(c["item"].alias("item"), c["doc"].alias("doc"))))
    judged = agreed.withColumn("odd", F.transform(odd, lambda c: c["p"]))
    judged = judged.withColumn("at", F.filter("at", lambda w: ~F.exists("odd", lambda p: p.between(w["first"], w["last"]))))
    covered = judged.select("doc_id", "item_id", "of", _long_run("at", window).alias("run"), F.explode("at.ipos").alias("ipos"))
    counted = covered.groupBy("doc_id", "item_id", "of").agg(F.countDistinct("ipos").alias("windows"), F.max("run").alias("run"))
    return counted.where(_enough(F.col("windows"), coverage) | F.col("run")).select("doc_id", "item_id", "windows", "of")


def _once(value: Column) -> Column:
    """The value, made once a row: a plain expression would be put into the lambdas that use it, and be made again for
    each of their elements."""
    return F.explode(F.array(value))


def _counterpart(value: Column) -> Column:
    """(item, doc): what a slot value of an item stands for in a document by its ``cells``: the most frequent value
    there, at a tie the item's own; null where other values tie."""
    found = F.transform(F.filter("cells", lambda c: c["item"] == value), lambda c: c["doc"])
    counts = F.transform(F.array_distinct(found), lambda d: F.struct(F.size(F.filter(found, lambda x: x == d)).alias("n"), (d == value).alias("same"), d.alias("doc")))
    best = F.array_max(counts)
    tied = F.size(F.filter(counts, lambda x: x["n"] == best["n"])) > 1
    return F.struct(value.alias("item"), F.when(best["same"] | ~tied, best["doc"]).alias("doc"))


def _long_run(at: str, window: int) -> Column:
    """Whether windows at consecutive places of one offset span RUN tokens."""
    pos, k = F.array_sort(F.col(at)["ipos"]), max(RUN - window, 0)
    return F.coalesce(F.exists(F.sequence(F.lit(0), F.size(pos)), lambda i: F.get(pos, i + k) - F.get(pos, i) == k), F.lit(False))


def _enough(n: Column, coverage: float) -> Column:
    return (n >= F.col("of") * F.lit(coverage)) & (n >= F.least(F.lit(LEAST_WINDOWS), F.col("of")))


def contamination(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (ascending) for every row of docs."""
    found = leaks(docs, benchmark, **settings).groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, "doc_id", "left")
    ids = F.coalesce("item_ids", F.array().cast("array<long>"))
    return rows.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"))


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of docs that no benchmark item contaminates."""
    (leak,) = unused(docs, "leak")
    found = leaks(docs, benchmark, **settings).select(F.col("doc_id").alias(leak)).distinct()
    return docs.join(found, F.col("doc_id").cast("long") == F.col(leak), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
