"""Benchmark leaks: planted verbatim, re-parameterised, inconsistent and absent, and against brute force."""

import random

from waymesh.llm import op05_decontamination as decon

ITEM = "A train leaves the station at 30 km per hour and Anna rides it for 4 hours while her brother waits with 30 apples in a basket."
FILL = "nothing of this kind stands here , only other words that no question uses at all ."


def found(spark, docs, items=((1, ITEM),)):
    d = spark.createDataFrame(list(docs), "doc_id long, text string")
    b = spark.createDataFrame(list(items), "item_id long, text string")
    return {r.doc_id: (r.contaminated, r.item_ids) for r in decon.contamination(d, b).collect()}


def test_planted(spark):
    docs = [
        (1, f"{FILL} {ITEM} {FILL}"),
        (2, FILL),
        (3, ITEM.upper()),
        (4, ITEM.replace("30", "45").replace("4 hours", "7 minutes").replace("Anna", "Otto")),
        # 30 stands twice in the question; two different values for it are no re-parameterisation.
        (5, ITEM.replace("30 km", "45 km").replace("30 apples", "99 apples")),
        (6, None),
        (7, ""),
        (8, " ".join(ITEM.split()[:7])),
        (9, ITEM.replace(" ", "\n ")),
        (None, ITEM),
        (10, ITEM),
        (10, FILL),
    ]
    got = found(spark, docs)
    assert {d for d, (leak, _) in got.items() if leak} == {1, 3, 4, 9, 10}
    assert got[1][1] == [1] and got[2][1] == []


def test_short_items_and_empty_tables(spark):
    assert found(spark, [(1, "x alpha beta gamma y"), (2, "alpha beta")], [(5, "Alpha beta gamma"), (6, None), (7, "")])[1] == (True, [5])
    assert found(spark, [(1, FILL)], []) == {1: (False, [])}
    assert found(spark, []) == {}


def test_clean_keeps_columns(spark):
    d = spark.createDataFrame([(1, ITEM, "a"), (2, FILL, "b"), (None, ITEM, "c")], "doc_id long, text string, window string")
    b = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted(r.window for r in decon.clean(d, b).collect()) == ["b", "c"]


def test_verbatim_against_brute_force(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([1, 2, 2, 3])))
    items = [(i, " ".join(word() for _ in range(rnd.randrange(5, 20)))) for i in range(30)]
    docs = []
    for d in range(150):
        words = [word() for _ in range(rnd.randrange(0, 60))]
        if rnd.random() < 0.6:
            own = rnd.choice(items)[1].split()
            a = rnd.randrange(len(own))
            at = rnd.randrange(len(words) + 1)
            words[at:at] = own[a : a + rnd.randrange(1, 20)]
        docs.append((d, " ".join(words)))
    want = {}
    for d, text in docs:
        w, hits = text.split(), []
        for i, item in items:
            x = item.split()
            seen = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
            n = sum(tuple(x[k : k + 5]) in seen for k in range(len(x) - 4))
            if n >= max(0.5 * (len(x) - 4), min(3, len(x) - 4)):
                hits.append(i)
        want[d] = (bool(hits), hits)
    assert found(spark, docs, items) == want


def test_items_with_few_words(spark):
    dense = "In 2019 Alice paid 30 dollars to Bob Smith and 12 euros to Carol Jones."
    items = [(1, dense), (2, "Compute 3 + 4 * 5 - 2."), (3, "In which year 1 2 3 4 5 6 7 8 9"), (4, "Add 1 2 3 4 5 then 6 7 8 9 stop"), (5, "7 8 9"), (6, "Compute 1 2 3 4 5 6 7 to 8 9")]
    docs = [(i, f"{FILL} {text} {FILL}") for i, text in items]
    docs += [
        (11, f"{FILL} In 1999 Otto paid 45 euros to Max Weber and 7 dollars to Eva Klein. {FILL}"),
        (12, "Compute 4 + 5 * 6 - 3."),
        (13, "In which year 2 3 4 5 6 7 8 9 10"),
        (14, "Add 2 3 4 5 6 then 7 8 9 10 stop"),
        (15, "8 9 10 11"),
        (16, f"{FILL} COMPUTE 3 4 5 2 {FILL}"),
    ]
    got = found(spark, docs, items)
    assert {d: ids for d, (_, ids) in got.items()} == {1: [1], 2: [2], 3: [3, 5], 4: [4, 5], 5: [5], 6: [6], 11: [1], 12: [], 13: [3, 5], 14: [4, 5], 15: [], 16: [2]}


def test_one_edited_slot(spark):
    item = "When Alice went to the old market with Alice of the green hill she saw how Alice sold apples and bread to her neighbours in town."
    twice = "Please count the 5 apples and after this also count the 5 pears that are lying there."
    docs = [
        (1, "Alice".join(item.split("Alice")[:3]) + "Alise" + item.split("Alice")[3]),
        (2, item.replace("Alice", "Otto", 2)),
        (3, twice.replace("5 pears", "8 pears")),
        (4, twice.replace("5", "3")),
        (5, item.replace("Alice", "Otto", 1).replace("Alice", "Max", 1).replace("Alice", "Eva", 1)),
    ]
    got = found(spark, docs, [(1, item), (2, twice)])
    assert {d: ids for d, (_, ids) in got.items()} == {1: [1], 2: [1], 3: [2], 4: [2], 5: []}


def test_long_part_of_a_long_item(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(71)]
    docs = [(n, f"{FILL} {' '.join(words[20 : 20 + n])} {FILL}") for n in (5, 12, 13, 31)]
    docs += [(100, " x ".join(" ".join(words[i : i + 8]) for i in range(0, 40, 8)))]
    got = found(spark, docs, [(1, " ".join(words))])
    assert {d for d, (leak, _) in got.items() if leak} == {13, 31}


def test_scripts_without_spaces(spark):
    item = "一列火车以每小时三十公里的速度离开车站驶向北方"
    docs = [(1, f"他说{item}然后走了"), (2, "今天天气很好我们去公园散步"), (3, f"text before {item} text after"), (4, "\ue001Alpha\ue001 beta")]
    assert {d for d, (leak, _) in found(spark, docs, [(1, item)]).items() if leak} == {1, 3}
    assert found(spark, [(1, "x alpha\ue001beta gamma y")], [(5, "alpha beta gamma")])[1] == (True, [5])


def test_reparameterised_questions(spark):
    """Questions of random words and slots; copies with every slot value replaced consistently are found, copies with
    the values of a repeated slot torn apart are not, whatever stands around them."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    items, docs, want = [], [], {}
    for i in range(25):
        words = [word() for _ in range(16)]
        a, b = rnd.sample(range(10, 99), 2)
        shape = " ".join([*words[:4], "{0}", *words[4:8], "{1}", *words[8:12], "{0}", *words[12:]])
        items.append((i, shape.format(a, b)))
        x, y = rnd.sample(range(100, 999), 2)
        around = f"{' '.join(word() for _ in range(9))} %s {' '.join(word() for _ in range(9))}"
        docs.append((2 * i, around % shape.format(x, y)))
        want[2 * i] = (True, [i])
        docs.append((2 * i + 1, around % " ".join(word() for _ in range(20))))
        want[2 * i + 1] = (False, [])
    assert found(spark, docs, items) == want


def test_very_long_text(spark):
    text = "nothing that any question asks " * 4000 + ITEM + " and so on " * 1000
    assert found(spark, [(1, text), (1, text), (2, text.replace(ITEM, ""))]) == {1: (True, [1]), 2: (False, [])}


def test_clashing_names(spark):
    d = spark.createDataFrame([(1, ITEM, 5, 6), (2, FILL, 7, 8)], "doc_id long, text string, leak int, item_id int")
    b = spark.createDataFrame([(1, ITEM, 9)], "item_id long, text string, doc_id int")
    out = decon.clean(d, b)
    assert out.columns == d.columns and [tuple(r) for r in out.collect()] == [(2, FILL, 7, 8)]
