"""The pipeline stage by stage on a small corpus, and its rows against plain Python."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_minhash import brute
from waymesh.llm import op06_token_ids, op09_mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(9)
    words = {"en": [f"the{i}th" for i in range(300)], "de": [f"ung{i}sch" for i in range(300)]}
    make = lambda lang, n: " ".join("".join(c for c in rnd.choice(words[lang]) if not c.isdigit()) + rnd.choice("abcdefgh") * 2 + rnd.choice("rstuvw") + rnd.choice("klmnop") for _ in range(n))
    items = [(i, make("en", 20)) for i in range(5)]
    rows = []
    for i in range(120):
        lang = rnd.choice(["en", "de"])
        rows.append((i, make(lang, rnd.randrange(5, 80)), lang, rnd.choice(["a", "b", "c", None])))
    rows += [(200 + i, rows[i][1], rows[i][2], "b") for i in range(15)]
    rows += [(300 + i, rows[i][1] + " " + items[i % 5][1], "en", "c") for i in range(20, 30)]
    rows += [(400, None, "en", "a"), (401, "12 34", "en", "a"), (402, "", None, None), (403, rows[50][1], None, "a")]
    return [(*r, len(r[1] or "")) for r in rows], items


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rows, items = corpus()
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_rows(spark, sf_dir):
    rows, items = corpus()
    known = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    dup = brute([(r[0], r[1]) for r in known], 5)
    first = {d for d, _, _, kept in dup if kept}
    leaked = [r[0] for r in known if any(x[1] in r[1] for x in items)]
    clean = [r for r in known if r[0] in first and r[0] not in leaked]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert sorted(r.doc_id for r in docs.collect()) == sorted(r[0] for r in clean)

    whole = {r.doc_id: r.whole for r in op09_mixing.mix(spark.createDataFrame(clean, SCHEMA)).collect()}
    library = Tokenizer.from_file(op06_token_ids.default_path())
    want, at = [], 0
    for doc_id, text, *_ in sorted(clean):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
        for _ in range(whole[doc_id]):
            want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()), key=lambda r: r[1])
    assert got == want and max(Counter(r[0] for r in got).values()) > 1


def test_stages_of_nothing(spark, sf_dir):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_odd_rows_through_the_stages(spark, sf_dir):
    """Repeated doc_ids with other texts, a very long text, repeated rows, nulls, and columns named like those used inside."""
    rows, _ = corpus()
    long = " ".join(f"the{'abcdefgh'[i % 8]}{'rstuvw'[i % 6]}{'klmnop'[i // 7 % 6]}th" for i in range(20_000))
    extra = [(1, "quite another text under the first id the house", "en", "a", 1), (500, long, "en", "b", 2), (500, long, "en", "b", 2), (None, rows[60][1], None, "c", 3), (None, None, None, None, None)]
    docs = spark.createDataFrame([(*r, "x", 7, 8) for r in [*rows, *extra]], SCHEMA + ", leak string, copy int, did int")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns, name
        if name == "near_dedup":
            got = docs.collect()
            assert sorted(r.n_chars for r in got if r.doc_id == 1) == sorted([len(rows[1][1]), 1]) and sum(r.doc_id == 500 for r in got) == 1
            assert not any(r.doc_id is None for r in got)
    assert all((r.leak, r["copy"], r.did) == ("x", 7, 8) for r in docs.collect())
    assert corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).count() == docs.count()
