"""The mix against DuckDB and against its own promises."""

import random
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest

from waymesh.llm import op09_mixing as mixing


def rows(kind):
    rnd = random.Random(3)
    out = []
    if kind != "empty":
        for i in range(400):
            source = None if i % 17 == 0 else "hot" if i % 3 == 0 else f"s{rnd.randrange(5)}"
            text = None if i % 29 == 0 else " ".join(["wörd"] * rnd.choice([0, 1, 5, 50, 700 if i == 7 else 3])) + "\t \n"
            out.append((i, text, source, "clash"))
        out += [(900, "lone words here", "tiny", ""), (901, None, "nothing", ""), (902, "", "nothing", "")]
    return out


@pytest.mark.parametrize("kind,bucket", [("full", 20_000), ("full", 7), ("empty", 20_000)])
def test_against_sql(spark, kind, bucket):
    data = rows(kind)
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, size string")
    got = sorted(map(tuple, mixing.mix(docs, bucket_rows=bucket).collect()))
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in data], pa.int64()), "text": pa.array([r[1] for r in data], pa.string()), "source": pa.array([r[2] for r in data], pa.string())}))
    assert got == sorted(con.sql(mixing.ORACLE).fetchall())


def test_budgets_are_met(spark):
    data = rows("full")
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, size string")
    source = {r[0]: r[2] for r in data}
    taken, sizes, target = defaultdict(int), {}, {}
    for r in mixing.mix(docs, bucket_rows=5).collect():
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        sizes[source[r.doc_id]], target[source[r.doc_id]] = r.source_size, r.target
    for s in taken:
        assert target[s] - 1 < taken[s] <= target[s] and target[s] <= 3 * sizes[s]
    assert abs(sum(target.values()) - sum(sizes.values())) < 1e-6 * sum(sizes.values())


def test_rows_of_the_mix(spark):
    data = [(1, "a b", "x", 1), (2, "c d e", "y", 2), (None, "f", "y", 3), (3, None, "z", 4), (2, "c d e", "y", 2)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, whole int")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    want = {r.doc_id: r.whole for r in mixing.mix(docs).collect()}
    seen = defaultdict(int)
    for r in out.collect():
        seen[r.doc_id] += 1
    assert seen[1] == want[1] and seen[3] == 0


def test_mixed_rows_without_or_with_repeated_ids(spark):
    rnd = random.Random(4)
    data = [(None, f"w{i} " * rnd.randrange(1, 9), "abc"[i % 3]) for i in range(120)]
    data += [(i // 3, f"v{i} " * rnd.randrange(1, 9), "abc"[i % 3]) for i in range(90)]
    data += [(None, "one and the same", "b")] * 60
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    taken, target = defaultdict(int), {}
    for r in mixing.mix(docs).collect():
        target[r.source_size] = r.target
    size = {s: sum(len(t.split()) for _, t, x in data if x == s) for s in "abc"}
    for r in mixing.mixed(docs).collect():
        taken[r.source] += len(r.text.split())
    assert len(set(size.values())) == 3
    for s in "abc":
        # The last document is taken or left as a whole.
        assert abs(taken[s] - target[size[s]]) <= 8


def test_names_used_inside_do_not_clash(spark):
    data = [(i, f"w{i} " * (i % 5), "ab"[i % 2], i, i, i, i, i) for i in range(30)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, copy int, id int, of int, times int, tie int")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and all(r.copy == r.id == r.of == r.times == r.tie == r.doc_id for r in out.collect())


def test_rows_without_id_against_sql(spark):
    rnd = random.Random(12)
    data = [(None, f"w{i} " * rnd.randrange(0, 9), "abc"[i % 3]) for i in range(200)] + [(i, "some words", "a") for i in range(9)] + [(None, None, "b"), (700, "long " * 200_000, "c")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = sorted(map(tuple, mixing.mix(docs, bucket_rows=10).collect()), key=str)
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in data], pa.int64()), "text": pa.array([r[1] for r in data], pa.string()), "source": pa.array([r[2] for r in data], pa.string())}))
    assert got == sorted(con.sql(mixing.ORACLE).fetchall(), key=str)
    for source in "abc":
        rows = [r for r in mixing.mix(docs, bucket_rows=10).join(docs.where(f"source = '{source}'").select("doc_id").distinct(), "doc_id", "left_semi").collect()]
        assert all(r.taken <= 3 * r.size for r in rows)


def test_repeated_rows_share_evenly(spark):
    docs = spark.createDataFrame([(1, "a b c", "x")] * 7 + [(2, "d e", "y")] * 5, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    for source_size in {r.source_size for r in got}:
        rows = [r for r in got if r.source_size == source_size]
        assert rows[0].target - 1 < sum(r.taken for r in rows) <= rows[0].target
