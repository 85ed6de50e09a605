"""Fingerprints: the homomorphism, likeness, and the query against a plain loop."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from waymesh.llm import op03_fingerprints as prints


def text(rnd, paragraphs, words=12):
    return "\n".join(" ".join(f"w{rnd.randrange(500)}" for _ in range(rnd.randrange(1, words))) for _ in range(paragraphs))


def one(x):
    return prints.encode(*prints.vectors([x]))[0]


def test_order_insertion_and_deletion():
    rnd = random.Random(1)
    parts = text(rnd, 9).split("\n")
    mixed = parts[::-1]
    assert one("\n".join(parts)) == one("\n".join(mixed))
    assert one("\n".join(parts)) != one("\n".join(parts[:-1]))
    assert prints.combine(one("\n".join(parts[:5])), one("\n".join(parts[5:]))) == one("\n".join(parts))
    assert prints.combine(one("\n".join(parts)), one("\n".join(parts[5:])), -1) == one("\n".join(parts[:5]))
    assert one("a b\na b") != one("a b") and one("a b") != one("A b")


def test_likeness_follows_shared_pairs():
    rnd = random.Random(2)
    a, b = text(rnd, 60), text(rnd, 60)
    half = "\n".join(a.split("\n")[:30] + b.split("\n")[:30])
    va, vb, vh = (prints.vectors([x]) for x in (a, b, half))
    assert prints.likeness(va, va)[0] == 1
    assert prints.likeness(va, vb)[0] < 0.35
    assert 0.25 < prints.likeness(va, vh)[0] < 0.75
    assert prints.likeness(prints.vectors([None]), prints.vectors([""]))[0] == 1


@pytest.mark.parametrize("rows", [2, 7, 1000])
def test_query_against_a_loop(spark, rows):
    rnd = random.Random(rows)
    data = [(i, text(rnd, rnd.randrange(1, 6)), "x") for i in rnd.sample(range(1000), 60)]
    data += [(2000, None, "x"), (2001, "", "x"), (2002, "é\U0001f600\n" * 50, "x"), (None, "last", "x"), (data[0][0], data[0][1], "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, fingerprint string")
    got = [tuple(r) for r in prints.neighbour_fingerprints(docs, range_rows=rows).collect()]
    want, order = [], sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for k, (d, own, _) in enumerate(order):
        own, nxt = own or "", order[(k + 1) % len(order)][1] or ""
        new = own[: len(own) - len(own) // 2] + nxt[: len(own) // 2]
        v = [prints.vectors([x]) for x in (own, new, nxt)]
        want.append((d, len(own), hashlib.sha256(new.encode()).hexdigest(), one(own), one(new), float(prints.likeness(v[0], v[1])[0]), float(prints.likeness(v[0], v[2])[0])))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_few_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert prints.neighbour_fingerprints(empty).count() == 0 and prints.fingerprints(empty).count() == 0
    (row,) = prints.neighbour_fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1
    (row,) = prints.fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert row.fingerprint == one("abcd") and len(np.concatenate(prints.decode(row.fingerprint))) == prints.WIDE + prints.LANES


@pytest.mark.parametrize("rows", [1, 2, 5000])
def test_order_of_large_and_negative_ids(spark, rows):
    """Ids beyond 2**53, where doubles can not tell neighbours apart, against SQL."""
    data = [((1 << 60) + k, f"text {k} " * k) for k in range(1, 9)] + [(-(1 << 62) - k, f"low {k}") for k in range(4)] + [(0, None), (3, "ä\U0001f600ö"), ((1 << 63) - 1, "top"), (-(1 << 63), "bottom"), (None, "x" * 5), (None, "y" * 7)]
    got = prints.neighbour_fingerprints(spark.createDataFrame(data, "doc_id long, text string"), range_rows=rows).select("doc_id", "n_chars", "edited_sha256").collect()
    docs = pa.table({"doc_id": pa.array([x for x, _ in data], pa.int64()), "text": pa.array([x for _, x in data], pa.string())})  # noqa: F841
    want = duckdb.sql(
        """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, text) AS k, count(*) OVER () AS n FROM docs)
        SELECT a.doc_id, length(a.t), sha256(substr(a.t, 1, length(a.t) - length(a.t) // 2) || substr(b.t, 1, length(a.t) // 2))
        FROM d a JOIN d b ON b.k = a.k % a.n + 1"""
    ).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_lanes_against_a_plain_count():
    """The parts of a fingerprint, word by word and bit by bit in plain Python."""
    rnd, mask = random.Random(5), (1 << 64) - 1

    def stir(x):
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask
        return x ^ x >> 31

    word = lambda w: int(prints.word_hashes([w])[0][0])
    for raw in (text(rnd, 4), "one", "a b\n\nc", ""):
        wide, lanes = [0] * prints.WIDE, [0] * prints.LANES
        for line in raw.split("\n") if raw else []:
            key = xxhash.xxh3_128_intdigest(line.encode())
            for k, seed in enumerate(prints._WIDE_SEEDS.tolist()):
                wide[k] += stir((stir((key & mask) ^ seed) + (key >> 64) * int(prints.GOLDEN)) & mask)
            own = [word(w) for w in line.split()]
            pairs = list(zip(own[:-1], own[1:])) if len(own) > 1 else [(0, w) for w in own]
            for a, b in pairs:
                pair = stir((a * int(prints.GOLDEN) + b) & mask)
                for k, seed in enumerate(prints._LANE_SEEDS.tolist()):
                    for i in range(64):
                        lanes[64 * k + i] += 1 if stir(pair ^ seed) >> i & 1 else -1
        got = prints.vectors([raw])
        assert got[0][0].tolist() == [x & mask for x in wide] and got[1][0].tolist() == [x & 0xFFFFFFFF for x in lanes]


def test_very_long_text(spark):
    long = "word and word\n" * 120_000
    rows = prints.neighbour_fingerprints(spark.createDataFrame([(2, long), (1, "short")], "doc_id long, text string")).collect()
    found = {r.doc_id: r for r in rows}
    assert found[2].n_chars == len(long) and found[2].fingerprint == one(long)
    assert found[2].edited_sha256 == hashlib.sha256((long[: len(long) // 2] + "short").encode()).hexdigest()
