"""The language model against a plain implementation, and the thresholds."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from waymesh.llm import op04_quality as quality

N = quality.ORDER


def plain_model(texts):
    grams = Counter()
    for t in texts:
        padded = quality.PAD * (N - 1) + "".join("0" if c.isdigit() and c.isascii() else c for c in t)
        grams.update(padded[i : i + N] for i in range(len(padded) - N + 1))
    alpha, gamma, counts = {}, {}, dict(grams)
    for order in range(N, 0, -1):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        d = [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] and n[k + 1] else 0.75, 0.05), k - 0.05) for k in (1, 2, 3)]
        total, freed = Counter(), defaultdict(float)
        for g, c in counts.items():
            total[g[:-1]] += c
            freed[g[:-1]] += d[min(c, 3) - 1]
        for g, c in counts.items():
            alpha[g] = (c - d[min(c, 3) - 1]) / total[g[:-1]]
        for h in total:
            gamma[h] = freed[h] / total[h]
        vocabulary = len(counts)
        counts = dict(Counter(g[1:] for g in counts)) if order > 1 else counts
    def p(g):
        lower = 1 / (vocabulary + 1) if len(g) == 1 else p(g[1:])
        return alpha.get(g, 0.0) + gamma.get(g[:-1], 1.0) * lower
    return p


def plain_perplexity(p, text):
    padded = quality.PAD * (N - 1) + "".join("0" if c.isdigit() and c.isascii() else c for c in text)
    return math.exp(-sum(math.log(p(padded[i : i + N])) for i in range(len(padded) - N + 1)) / len(text))


def corpus(seed=4, n=120):
    rnd = random.Random(seed)
    good = lambda: " ".join(rnd.choice(["the", "there", "other", "thérn", "house", "12 mice"]) for _ in range(rnd.randrange(3, 30)))
    rows = [(i, good(), rnd.choice(["en", "de", None]), "x") for i in range(n)]
    rows += [(500 + i, "".join(rnd.choice("%$#&qxz|") for _ in range(80)), "en", "x") for i in range(20)]
    return rows + [(900, None, "en", "x"), (901, "", "en", "x"), (None, "the house", "en", "x"), (902, "the " * 30_000, "fr", "x"), (1, rows[1][1], rows[1][2], "x")]


def test_against_a_plain_model(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, perplexity string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(120)] + [(7, 0), (550, 1), (None, 1), (8, None)], "doc_id long, quality int")
    trusted = {i for i in range(120) if i % 5 > 0} - {7}
    out = lambda d: zlib.crc32(str(d).encode()) % 3 == 1
    p = plain_model([t for d, t, _, _ in rows if d in trusted and not out(d)])
    got = quality.quality(docs, labels).collect()
    want = {(d, t): plain_perplexity(p, t) for d, t, _, _ in rows if t and d != 902}
    by = {d: [t for e, t, _, _ in rows if e == d] for d, _, _, _ in rows}
    for r in got:
        if r.doc_id in (900, 901):
            assert r.perplexity is None and not r.kept
        elif r.doc_id != 902:
            assert r.perplexity == pytest.approx(want[r.doc_id, by[r.doc_id][0]], rel=1e-3)
    assert len(got) == len(rows)
    kept = {r.doc_id for r in got if r.kept}
    assert not kept & set(range(500, 520)) and len(kept & trusted) > 0.9 * len(trusted)
    assert len({r.threshold for r in got if r.lang == "fr"}) == 1


def test_nothing_trusted_and_nothing_at_all(spark):
    docs = spark.createDataFrame([(1, "abc", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: (r.perplexity, r.kept) for r in quality.quality(docs, none).collect()}
    assert got[1] == (pytest.approx(1.0), True) and got[2] == (None, False)
    assert quality.quality(docs.limit(0), none).count() == 0


def test_splits_of_one_file(spark, tmp_path):
    """A file of several splits gives the same perplexities as many files; were it split another way, the job fails."""
    rows = [r[:3] for r in corpus(n=400) if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    docs.coalesce(1).write.option("parquet.block.size", 4096).parquet(one)
    docs.repartition(5).write.parquet(many)
    model = quality.train(docs.where("doc_id < 100"))
    show = lambda path: sorted((r.doc_id, r.perplexity and round(r.perplexity, 6)) for r in quality.perplexity(spark.read.parquet(path), model, stored=True).collect())
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        split = spark.read.parquet(one)
        assert split.rdd.getNumPartitions() > 2
        assert show(one) == show(many)
        late = quality.perplexity(split, model, stored=True)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        with pytest.raises(Exception, match="split another way"):
            late.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
