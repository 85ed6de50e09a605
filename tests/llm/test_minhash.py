"""Near duplicates against all pairs by brute force."""

import random

import pytest
from pyspark.sql import functions as F

from waymesh.llm import graph
from waymesh.llm import op10_minhash as near


def brute(rows, size, threshold=80):
    def own(text):
        w = (text or "").encode().lower().split()
        if not w:
            return set()
        return set(zip(*(w[i:] for i in range(size)))) if len(w) >= size else {tuple(w)}

    sets = [own(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= threshold * len(a | b):
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)), d is None or least[find(i)] == d) for i, (d, _) in enumerate(rows)), key=str)


def network(seed, groups=12, copies=14, words=60):
    rnd, rows = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rnd.randrange(4000)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 5, 9])):
                own[rnd.randrange(len(own))] = f"x{rnd.randrange(4000)}"
            rows.append(" ".join(own))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("size,block", [(2, 256), (5, 256), (2, 8)])
def test_against_all_pairs(spark, size, block):
    texts = network(size + block)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (None, texts[0]), (1006, texts[3]), (3, texts[3]), (1007, "é \xa0é x"), (1008, "É \xa0é x")]
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, component_id int")
    got = sorted(map(tuple, near.near_duplicates(docs, size=size, block_nodes=block).collect()), key=str)
    assert got == brute(rows, size)


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_duplicates(docs).count() == 0


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (2, "a b c d e f", "y"), (3, "other words here", None), (None, None, "z")], "doc_id long, text string, source string")
    got = sorted(map(tuple, near.deduplicated(docs).collect()), key=str)
    assert got == sorted([(1, "a b c d e f", "x"), (3, "other words here", None), (None, None, "z")], key=str)


def test_different_texts_under_one_id(spark):
    rows = [(1, "a b c d e f g h", "x", 1), (1, "quite another text stands here now", "y", 2), (1, "a b c d e f g h", "w", 3), (2, "a b c d e f g h i", "z", 4)]
    rows += [(None, "a b c d e f g h", "v", 5), (None, "only rows without an id have this text", "u", 6), (None, "only rows without an id have this text", "t", 7), (None, "", "s", 8), (None, "", "r", 9), (5, None, "q", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, did string, tie int")
    got = sorted(map(tuple, near.deduplicated(docs, size=2).collect()), key=str)
    want = [rows[2], rows[1], rows[6], rows[7], rows[8], rows[9]]
    assert got == sorted(want, key=str)
    assert near.deduplicated(docs.limit(0)).count() == 0


def test_very_long_texts(spark):
    rnd = random.Random(7)
    words = [f"w{rnd.randrange(100_000)}" for _ in range(150_000)]
    other = [*words[:-100], *(f"x{i}" for i in range(100))]
    docs = spark.createDataFrame([(3, " ".join(words)), (2, " ".join(other)), (1, "short")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 2}


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            label[y] = x
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {x: find(x) for x in list(label)}
    assert graph.components(spark.range(0).select(F.col("id").alias("u"), F.col("id").alias("v"))).count() == 0
