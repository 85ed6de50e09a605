"""Operator 7: WARC archives with payload de-duplication and a two-level capture index.

Writing: a native pass finds, for every payload that several pages have (by SHA-1 and length), the smallest
page_id; that page is a response record, the others are revisit records that refer to it. Each task writes one
archive of gzip members, one for each record, and tells where they stand.

Index: captures are sorted by reversed-host URL key and page_id, dealt into shards by range, and each shard
holds compressed blocks of a bounded number of lines and a sparse directory: the first key and the place of
each block. A look-up searches the list of shards (first keys, one row a shard), then the shard's directory,
then the block, each by bisection, and then reads one byte range of the archive.

    shard   block | block | ... | directory | directory length, 8 bytes | "WMCDX1\\n\\0"
    line    key TAB page_id TAB part TAB offset TAB length

Edge cases: null html is an empty payload; a null url is an empty one; payloads below ``least`` bytes are
always responses; a page without page_id is always a response, and its refers_to and page_id are null; rows that
repeat the response's page_id with the same payload are responses too, each in a record of its own; rows that
repeat a page_id are all read back; captures that tie on key and page stand in the order of their places; an
empty table gives no archive and an empty result. Other columns are ignored. A very long page is one record, held
whole by the task that writes or reads it. Files of a repeated task replace equal ones; readers see whole files only.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm.common import durable, filesystem, fresh_path, publish, table

MAGIC = b"WMCDX1\n\0"
BLOCK_LINES = 2000
READ_AHEAD = 4_000_000
#: Bytes of archive that one task reads back.
READ_TASK = 64_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = -(1 << 63)


def url_key(url: Column) -> Column:
    """com,example,www)/path?query: the host's labels reversed, lower-cased, without user, default port and fragment."""
    plain = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20]+|#.*$", "")
    host = F.lower(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(host, r":(?:80|443)?$", "")
    rest = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def record_id(page_id: int | None, seed: str) -> str:
    return f"urn:page:{page_id}" if page_id is not None else f"urn:sha1:{seed}"


def record(page_id: int | None, url: str, payload: bytes, digest: str, first: int | None, first_url: str | None) -> bytes:
    """One WARC record, not compressed. ``first``: the page it revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"), ("WARC-Target-URI", url), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    if first is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_id(first, digest)}>"), ("WARC-Refers-To-Target-URI", first_url or "")]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {_line(v)}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _line(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " else c for c in value)


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _gz(data: bytes) -> bytes:
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def write_archives(pages: DataFrame, least: int = 0) -> tuple[str, DataFrame]:
    """(folder, captures): captures has key, page_id, part, offset, length for every record written."""
    folder = fresh_path(pages.sparkSession, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    lean = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    narrow = lean.select("page_id", "url", F.sha1("html").alias("sha"), F.octet_length("html").alias("size"))
    told = narrow.where((F.col("size") >= least) & F.col("page_id").isNotNull())
    # Only payloads of several pages need a decision; the rest of the table is not joined for it.
    shared = told.groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last")
    again = told.join(shared, ["sha", "size"]).where("page_id > first").select("page_id", "sha", "first")
    urls = lean.select(F.col("page_id").alias("first"), F.col("url").alias("first_url")).join(shared.select("first").distinct(), "first", "left_semi").groupBy("first").agg(F.min("first_url").alias("first_url"))
    again = again.distinct().join(urls, "first").select(F.col("page_id").alias("again_id"), F.col("sha").alias("again_sha"), "first", "first_url")
    rows = lean.withColumn("sha", F.sha1("html")).join(again, (F.col("page_id") == F.col("again_id")) & (F.col("sha") == F.col("again_sha")), "left")
    rows = rows.select("page_id", "url", "html", "sha", "first", "first_url", url_key(F.col("url")).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, places = TaskContext.get().partitionId(), []
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return

        def write(out) -> None:
            now = batch
            info = _gz(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:part:%d>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\nformat: WARC/1.1\r\n\r\n\r\n" % part)
            out.write(info)
            at = len(info)
            while now is not None:
                for page_id, url, text, sha, first, first_url, key in zip(*(c.to_pylist() for c in now.columns), strict=True):
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    data = _gz(record(page_id, url, text.encode("utf-8", "surrogatepass"), digest, first, first_url))
                    out.write(data)
                    places.append((key, page_id, at, len(data)))
                    at += len(data)
                now = next(batches, None)

        publish(f"{folder}/part-{part:06d}.warc.gz", write)
        for a in range(0, len(places), 10_000):
            key, page_id, at, length = zip(*places[a : a + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(page_id, pa.int64()), pa.array([part] * len(key), pa.int32()), pa.array(at, pa.int64()), pa.array(length, pa.int64())], ["key", "page_id", "part", "offset", "length"])

    return folder, durable(rows.mapInArrow(run, "key string, page_id long, part int, offset long, length long"), "captures")


def write_index(captures: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the shards; returns (shard, path, size, first_key, first_page, n), one row a shard."""
    folder = fresh_path(captures.sparkSession, "index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, told = TaskContext.get().partitionId(), {"n": 0}
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return

        def lines() -> Iterator[tuple]:
            now = batch
            while now is not None:
                yield from zip(*(c.to_pylist() for c in now.columns), strict=True)
                now = next(batches, None)

        def write(out) -> None:
            at, held, directory = 0, [], []

            def flush() -> None:
                nonlocal at
                if held:
                    data = zlib.compress("\n".join("\t".join(map(str, x)) for x in held).encode("utf-8", "surrogatepass"), 3)
                    out.write(data)
                    directory.append(f"{held[0][0]}\t{held[0][1]}\t{at}\t{len(data)}")
                    at += len(data)
                    held.clear()

            for row in lines():
                told.setdefault("first", row[:2])
                told["n"] += 1
                held.append(row)
                if len(held) >= block_lines:
                    flush()
            flush()
            data = zlib.compress("\n".join(directory).encode("utf-8", "surrogatepass"), 3)
            out.write(data + struct.pack("<q8s", len(data), MAGIC))

        uri = f"{folder}/shard-{shard:06d}.cdx"
        publish(uri, write)
        files, at = filesystem(uri)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [uri], "size": [files.get_file_info(at).size], "first_key": [told["first"][0]], "first_page": [told["first"][1]], "n": [told["n"]]})

    lean = captures.select("key", F.coalesce("page_id", F.lit(NO_ID)).alias("page"), "part", "offset", "length")
    dealt = lean.repartitionByRange("key", "page").sortWithinPartitions("key", "page", "part", "offset")
    return durable(dealt.mapInArrow(run, "shard int, path string, size long, first_key string, first_page long, n long"), "shards")


def _order(key: str, page: int) -> tuple[bytes, int]:
    """Spark sorts text by its bytes."""
    return key.encode("utf-8", "surrogatepass"), page


class CaptureIndex:
    """Look-ups in the shards of an index (rows of the manifest). Holds one directory and one block at a time."""

    def __init__(self, shards: list):
        self.shards = sorted(shards, key=lambda r: r.shard)
        self.firsts = [_order(r.first_key, r.first_page) for r in self.shards]
        self.open: tuple = (None, None, [], [])
        self.block: tuple = (None, None, [], [])

    def _directory(self, k: int):
        if self.open[0] != k:
            if self.open[1] is not None:
                self.open[1].close()
            row = self.shards[k]
            files, at = filesystem(row.path)
            source = files.open_input_file(at)
            source.seek(row.size - 16)
            length, magic = struct.unpack("<q8s", source.read(16))
            if magic != MAGIC:
                raise ValueError("not an index shard, or a truncated one")
            source.seek(row.size - 16 - length)
            lines = [x.split("\t") for x in zlib.decompress(source.read(length)).decode("utf-8", "surrogatepass").split("\n")]
            self.open = (k, source, [_order(x[0], int(x[1])) for x in lines], [(int(x[2]), int(x[3])) for x in lines])
        return self.open

    def _lines(self, k: int, j: int):
        if self.block[:2] != (k, j):
            _, source, _, places = self._directory(k)
            source.seek(places[j][0])
            lines = [x.split("\t") for x in zlib.decompress(source.read(places[j][1])).decode("utf-8", "surrogatepass").split("\n")]
            self.block = (k, j, [_order(x[0], int(x[1])) for x in lines], [tuple(map(int, x[2:])) for x in lines])
        return self.block

    def _from(self, low: tuple[bytes, int]) -> Iterator[tuple[tuple[bytes, int], tuple[int, int, int]]]:
        """Lines from the first at or after ``low``."""
        k = max(0, bisect.bisect_left(self.firsts, low) - 1)
        first = True
        while k < len(self.shards):
            starts = self._directory(k)[2]
            j = max(0, bisect.bisect_left(starts, low) - 1) if first else 0
            while j < len(starts):
                _, _, keys, places = self._lines(k, j)
                for i in range(bisect.bisect_left(keys, low) if first else 0, len(keys)):
                    first = False
                    yield keys[i], places[i]
                j += 1
            k += 1

    def find(self, key: str, page_id: int | None = None) -> list[tuple[int | None, int, int, int]]:
        """(page_id, part, offset, length) of every capture of a key, or of one page of it."""
        want, out = key.encode("utf-8", "surrogatepass"), []
        for (own, page), place in self._from((want, NO_ID if page_id is None else page_id)):
            if own != want or (page_id is not None and page != page_id):
                break
            out.append((None if page == NO_ID else page, *place))
        return out


def look_up(keys: DataFrame, shards: DataFrame) -> DataFrame:
    """(page_id, part, offset, length) of the captures of ``keys`` (key, page_id). Keys are dealt by range, so a
    task meets few blocks; the list of shards has a row a file and goes to every task."""
    rows = shards.select("shard", "path", "size", "first_key", "first_page").collect()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CaptureIndex(rows)
        for batch in batches:
            out = [x for key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True) for x in index.find(key, NO_ID if page is None else page)]
            for a in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[a : a + 10_000], strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["page_id", "part", "offset", "length"])

    wanted = keys.select("key", "page_id").distinct()
    return wanted.repartitionByRange("key", "page_id").sortWithinPartitions("key", F.coalesce("page_id", F.lit(NO_ID))).mapInArrow(run, "page_id long, part int, offset long, length long")


def read_captures(folder: str, captures: DataFrame) -> DataFrame:
    """The records of captures (part, offset, length): page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for revisits). Ranges that touch are read at once. The number of tasks follows the bytes
    of archive that the captures name, not those of the captures themselves: it is stated, so it is kept."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"

    def page(urn: str | None) -> int | None:
        return int(urn[10:-1]) if urn and urn.startswith("<urn:page:") else None

    def records(rows: list[tuple[int, int, int]]) -> Iterator[tuple]:
        a = 0
        while a < len(rows):
            part, start, end = rows[a][0], rows[a][1], rows[a][1] + rows[a][2]
            b = a + 1
            while b < len(rows) and rows[b][0] == part and end <= rows[b][1] <= end + 65_536 and rows[b][1] + rows[b][2] - start <= READ_AHEAD:
                end = rows[b][1] + rows[b][2]
                b += 1
            files, at = filesystem(f"{folder}/part-{part:06d}.warc.gz")
            with files.open_input_file(at) as source:
                source.seek(start)
                data = source.read(end - start)
            for _, offset, length in rows[a:b]:
                fields, http, payload = parse(zlib.decompress(data[offset - start : offset - start + length], 31))
                kind = fields["WARC-Type"]
                if kind == "response":
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324
                else:
                    size, digest = int(http["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                yield page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], size, digest, kind, page(fields.get("WARC-Refers-To")), payload if kind == "response" else None
            a = b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            for row in records(list(zip(*(c.to_pylist() for c in batch.columns), strict=True))):
                held.append(row)
                if len(held) == 500:
                    yield _batch(held)
                    held = []
            if held:
                yield _batch(held)

    told = captures.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    tasks = max(1, min(captures.sparkSession.sparkContext.defaultParallelism, told.n // 500), (told.bytes or 0) // READ_TASK)
    dealt = captures.select("part", "offset", "length").repartitionByRange(tasks, "part", "offset").sortWithinPartitions("part", "offset")
    return dealt.mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder, captures = write_archives(pages)
    shards = write_index(captures)
    keys = pages.select(url_key(F.col("url").cast("string")).alias("key"), F.col("page_id").cast("long").alias("page_id"))
    found = durable(look_up(keys, shards), "found")
    return read_captures(folder, found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS MATERIALIZED (SELECT page_id, sha1(coalesce(html, '')) AS sha, strlen(coalesce(html, '')) AS size FROM pages),
f AS (SELECT sha, size, min(page_id) AS first FROM p GROUP BY sha, size)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((CAST('0x' || substr(sha, 5 * (i // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1]), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM p JOIN f USING (sha, size)
"""
