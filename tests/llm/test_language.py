"""Language identification: held-out accuracy, spans, and the decoder against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymesh.llm import op01_language as language

WORDS = {
    "en": "the house which they thought about with something where another other then this".split(),
    "de": "und zwischen nicht schloss wurde straße über möglich gegenwärtig durch einzeln".split(),
    "ru": "который человек только после время этого большой других сказать".split(),
}


def sentence(lang, n, rnd):
    return " ".join(rnd.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(2)
    rows = [(i, sentence(lang := rnd.choice(list(WORDS)), rnd.randrange(3, 40), rnd), lang, "x") for i in range(300)]
    rows += [(1000, None, "en", "x"), (1001, "12 34 !!", "en", "x"), (1002, "", None, "x"), (1003, "漢字", None, "x"), (None, "the house", "en", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").cache()


def test_held_out_accuracy(docs):
    model = language.fit(docs)
    assert model.languages == ["de", "en", "ru"]
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    want = {r.doc_id: r.lang for r in docs.where("doc_id < 1000").collect()}
    assert sum(got[d].lang_pred == x for d, x in want.items()) >= 0.98 * len(want)
    assert 60 < sum(r.held_out for r in got.values()) < 140
    assert [tuple(got[d])[2:] for d in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred in model.languages and got[1003].score == pytest.approx(1 / 3)
    assert got[None].held_out is False


def test_spans_of_mixed_text(spark, docs):
    rnd = random.Random(5)
    parts = [("en", sentence("en", 8, rnd)), ("ru", sentence("ru", 8, rnd)), ("de", sentence("de", 9, rnd))]
    text = ". ".join(p for _, p in parts)
    got = language.spans(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), language.fit(docs)).orderBy("start").collect()
    assert [(r.lang, text[r.start : r.end]) for r in got] == parts


def test_decoder_against_all_paths():
    rng = np.random.default_rng(1)
    counts = np.array([3, 0, 5, 1, 4])
    scores = rng.normal(size=(counts.sum(), 3)) * 3
    got, at = language.viterbi(scores, counts, 2.0), 0
    for n in counts:
        own = scores[at : at + n]
        value = lambda path: sum(own[i, x] for i, x in enumerate(path)) - 2.0 * sum(a != b for a, b in itertools.pairwise(path))  # noqa: E731, B023
        if n:
            assert value(got[at : at + n]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=int(n)))))
        at += n


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert [tuple(r) for r in language.identify(docs, model).select("doc_id", "lang_pred", "score").collect()] == [(1, "und", 0.0)]
    assert language.identify(docs.limit(0), model).count() == 0
    assert language.spans(docs, model).count() == 0


def test_long_text(spark, docs):
    model = language.fit(docs)
    text = sentence("en", 60_000, random.Random(1))
    (row,) = language.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).select(F.col("lang_pred"), F.col("score")).collect()
    assert row.lang_pred == "en" and row.score > 0.99


def test_letters_and_marks():
    words, *_ = language.read_words(["हिन्दी में", "\U000e0100\U000f0000\U000e0041", "áb ́ c", "\U00020000\U00030000"], 20)
    got = [(t, a, b) for t, a, b in zip(words.text.tolist(), words.start.tolist(), words.end.tolist(), strict=True)]
    assert got == [(0, 0, 6), (0, 7, 10), (2, 0, 3), (2, 6, 7), (3, 0, 2)]


def test_und_without_letters(spark, docs):
    model = language.fit(docs)
    rows = spark.createDataFrame([(1, "\U000e0100"), (2, "\U000f0000 \U000e0041"), (3, "́")], "doc_id long, text string")
    assert {(r.lang_pred, r.score) for r in language.identify(rows, model).collect()} == {("und", 0.0)}


def test_pieces_of_long_texts_change_nothing(docs, monkeypatch):
    model, rnd = language.fit(docs), random.Random(3)
    texts = [sentence(rnd.choice(list(WORDS)), rnd.randrange(0, 30), rnd) for _ in range(40)] + [None, "", "a" * 300]
    want = language.predict(texts, model)
    monkeypatch.setattr(language, "_PART", 50)
    got = language.predict(texts, model)
    assert got[0] == want[0] and np.allclose(got[1], want[1]) and np.allclose(got[2], want[2])
    for _, where, what in language.pieces(texts):
        assert all(len(x) <= 300 for x in what) and len(where) == len(what)


def test_many_languages_share_the_table(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join("".join(rnd.choice("abcdefgh"[k % 4 :]) for _ in range(5)) for _ in range(20)), f"l{k:02d}") for i, k in enumerate(list(range(40)) * 3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.dense().size <= 2**language.TABLE_LOG2 and len(model.languages) > 16


def test_accepted(spark, docs):
    """A clean text of three languages, a repeated row, a column named like a result; unknown scripts and no letters go."""
    rnd, model = random.Random(8), language.fit(docs)
    even = " ".join(sentence(x, 6, rnd) for x in WORDS)
    rows = [(1, even, None, 5), (2, "漢字 漢字", "en", 5), (3, None, "en", 5), (4, sentence("en", 9, rnd), "xx", 5), (4, sentence("en", 9, rnd), "xx", 5), (None, sentence("de", 9, rnd), None, 5)]
    got = language.accepted(spark.createDataFrame(rows, "doc_id long, text string, lang string, score int"), model)
    assert got.columns == ["doc_id", "text", "lang", "score"]
    found = got.collect()
    assert sorted((r.doc_id or 0, r.lang in WORDS, r.score) for r in found) == [(0, True, 5), (1, True, 5), (4, False, 5), (4, False, 5)]
    assert language.accepted(spark.createDataFrame([], "doc_id long, text string, lang string"), model).count() == 0


def test_scores_against_a_plain_count(docs):
    """The scores of words, against dictionaries of n-grams (no two of them share a slot here)."""
    model, rnd = language.fit(docs), random.Random(6)
    train = [(r.lang, r.text) for r in docs.where("lang is not null and text is not null and doc_id is not null").where(~language.held_out(F.col("doc_id"))).collect()]
    def grams(word):
        x = ["\0", "\0", *word.lower()]
        return [tuple(x[i - 2 : i + 1]) for i in range(2, len(x))] + [("", *x[i - 1 : i + 1]) for i in range(2, len(x))] + [(*x[-2:], "$"), ("", x[-1], "$")]
    plain = lambda text: "".join(c if c.isalpha() else " " for c in text).split()
    counts = {lang: {} for lang in model.languages}
    for lang, text in train:
        for word in plain(text):
            for g in grams(word):
                counts[lang][g] = counts[lang].get(g, 0) + 1
    every = set().union(*counts.values())
    total = {lang: sum(c.values()) for lang, c in counts.items()}
    share = {g: [np.log((counts[x].get(g, 0) + 0.5) / (total[x] + 0.5 * len(every))) for x in model.languages] for g in every}
    for word in ["house", "something", "zwischen", "unheard"]:
        w, *found = language.read_words([word], model.bits)
        want = sum((0.5 * (np.array(share[g]) - np.mean(share[g])) for g in grams(word) if g in share), np.zeros(3))
        got, allowed = model.scores(w.script, *found)[0], model.allowed[w.script[0]]
        assert got[allowed] == pytest.approx(want[allowed], abs=1e-3)
