"""Archives written, indexed and read back."""

import base64
import hashlib

from pyspark.sql import functions as F

from waymesh.llm import op07_warc as warc

PAGES = [
    (5, "http://www.Example.com/a?x=1#frag", "<p>one</p>", "x"),
    (2, "https://example.com:443/b", "<p>one</p>", "x"),
    (9, "http://sub.example.org", "<p>one</p>", "x"),
    (7, None, None, "x"),
    (8, "not a url", "", "x"),
    (3, "http://example.com/b", "é" * 70_000, "x"),
    (None, "http://example.com/b", "<p>one</p>", "x"),
    (4, "http://example.com/b\r\nEvil: 1", "<p>two</p>\r\n\r\n", "x"),
    (4, "http://example.com/b\r\nEvil: 1", "<p>two</p>\r\n\r\n", "x"),
]


def want(pages, least=0):
    out = []
    for i, _, html, _ in pages:
        own = [p for p, _, h, _ in pages if (h or "") == (html or "") and p is not None]
        data = (html or "").encode()
        first = min(own) if i is not None and len(data) >= least else i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=str)


def through(spark, pages, least=0, block_lines=2):
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, key string")
    folder, captures = warc.write_archives(frame, least)
    shards = warc.write_index(captures, block_lines)
    keys = frame.select(warc.url_key(F.col("url")).alias("key"), "page_id")
    return folder, shards, warc.read_captures(folder, warc.look_up(keys, shards))


def test_round_trip(spark):
    for least in (0, 11):
        _, _, got = through(spark, PAGES, least)
        rows = got.collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == want(PAGES, least)
        html = {p: (h or "").encode() for p, _, h, _ in PAGES}
        assert all(bytes(r.payload) == html[r.page_id] for r in rows if r.record_type == "response" and r.page_id is not None)


def test_keys_and_point_look_ups(spark):
    urls = ["http://www.Example.com/a?x=1#frag", "https://user@example.com:443/b", "http://sub.example.org", None, "not a url"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u"))).collect()]
    assert got == ["com,example,www)/a?x=1", "com,example)/b", "org,example,sub)/", ")/", ")/notaurl"]
    pages = [(i, f"http://h{i % 7}.example.com/p{i % 50}", f"text {i}", "") for i in range(300)]
    folder, shards, _ = through(spark, pages, block_lines=9)
    index = warc.CaptureIndex(shards.collect())
    for k in range(7):
        for p in (0, 13, 49):
            found = index.find(f"com,example,h{k})/p{p}")
            assert [x[0] for x in found] == [i for i in range(300) if i % 7 == k and i % 50 == p]
    assert index.find("com,example,h9)/p1") == [] and index.find("") == [] and index.find("zz") == []
    ((page, part, offset, length),) = index.find("com,example,h3)/p3", 3)
    files, at = warc.filesystem(f"{folder}/part-{part:06d}.warc.gz")
    with files.open_input_file(at) as source:
        source.seek(offset)
        fields, _, payload = warc.parse(warc.zlib.decompress(source.read(length), 31))
    assert (page, payload, fields["WARC-Target-URI"]) == (3, b"text 3", "http://h3.example.com/p3")


def test_no_pages(spark):
    _, _, got = through(spark, [])
    assert got.count() == 0
