"""Operator 6: token ids in fixed-width bit-packed files.

Documents are range-partitioned by doc_id and sorted, and each partition becomes one file in the shared
folder, so the files in order of their part number hold the ids in ascending doc_id order. Every id takes
the least number of bits that holds the vocabulary. Files are written as a stream, block by block, and
end in a footer:

    "WMTOK1\\n\\0" | block | block | ... | footer | footer length, 8 bytes | "WMTOK1\\n\\0"

    block   ``block_ids`` ids (the last may have fewer), ``bits`` bits each, lowest bit first
    footer  zlib of: JSON line {bits, block_ids, n_ids, n_docs, tail}, then little-endian int64 arrays:
            block offsets, doc_ids, first id of each document (n_docs + 1 of them)

``TokenFile.ids(a, b)`` reads only the blocks that hold the ids a..b-1 and unpacks them with numpy.

Edge cases: a null text is empty and gives the end id alone; a null doc_id sorts first and is kept as null;
rows that tie on doc_id, and repeated rows, stay, in the order of their text; an empty table gives an empty
result; other columns are ignored; very long texts are encoded and written a megabyte at a time. A repeated
task writes the same bytes under its own name and renames them.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymesh.llm.bpe import PieceTable, WholeTexts, can_be_cut, column_bytes
from waymesh.llm.common import durable, filesystem, fresh_path, publish, table

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
MAGIC = b"WMTOK1\n\0"
BLOCK_IDS = 1 << 16

_WORKER: dict = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids -> ceil(len * bits / 8) bytes, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    flat = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little")
    return np.packbits(flat.reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The inverse of pack: n ids as uint32."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


class TokenFile:
    """Random access to one file."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 16)
        length, magic = struct.unpack("<q8s", source.read(16))
        if magic != MAGIC:
            raise ValueError("not a token file, or a truncated one")
        source.seek(size - 16 - length)
        raw = zlib.decompress(source.read(length))
        line, _, rest = raw.partition(b"\n")
        told = json.loads(line)
        self.bits, self.block_ids, self.n_ids, self.n_docs = (told[k] for k in ("bits", "block_ids", "n_ids", "n_docs"))
        arrays = np.frombuffer(rest, "<i8")
        blocks = -(-self.n_ids // self.block_ids)
        self.offsets = arrays[: blocks + 1]
        self.doc_ids = arrays[blocks + 1 : blocks + 1 + self.n_docs]
        self.starts = arrays[blocks + 1 + self.n_docs : blocks + 2 + 2 * self.n_docs]
        self.null_docs = told["null_docs"]

    def ids(self, a: int, b: int) -> np.ndarray:
        if b <= a:
            return np.zeros(0, np.uint32)
        first, last = a // self.block_ids, (b - 1) // self.block_ids
        self.source.seek(int(self.offsets[first]))
        data = self.source.read(int(self.offsets[last + 1] - self.offsets[first]))
        out = []
        for k in range(first, last + 1):
            n = min(self.block_ids, self.n_ids - k * self.block_ids)
            at = int(self.offsets[k] - self.offsets[first])
            out.append(unpack(data[at : at + int(self.offsets[k + 1] - self.offsets[k])], n, self.bits))
        return np.concatenate(out)[a - first * self.block_ids : b - first * self.block_ids]


class _Writer:
    """Streams ids into a file; holds one block and the document table (16 bytes a document)."""

    def __init__(self, out, bits: int, block_ids: int, end_id: int | None):
        self.out, self.bits, self.block_ids, self.end_id = out, bits, block_ids, end_id
        out.write(MAGIC)
        self.at, self.offsets, self.held, self.n_held = len(MAGIC), [len(MAGIC)], [], 0
        self.doc_ids, self.starts, self.nulls, self.n_ids, self.n_docs = [], [np.zeros(1, np.int64)], 0, 0, 0

    def add(self, doc_ids: pa.Array, runs: Iterator) -> None:
        """Documents with their ids, which come in runs; each document ends in the end id."""
        self.nulls += doc_ids.null_count
        self.doc_ids.append(pc.fill_null(doc_ids, 0).to_numpy(zero_copy_only=False))
        self.n_docs += len(doc_ids)
        for _, counts, values, whole in runs:
            ids = np.zeros(0, np.uint32) if values is None else values.astype(np.uint32)
            ends = np.cumsum(counts)[: len(counts) if whole else -1]
            if self.end_id is not None:
                ids = np.insert(ids, ends, self.end_id)
                ends = ends + np.arange(1, len(ends) + 1)
            self.starts.append(self.n_ids + ends)
            self.n_ids += len(ids)
            self.held.append(ids)
            self.n_held += len(ids)
            if self.n_held >= self.block_ids:
                self._blocks(self.n_held // self.block_ids)

    def _blocks(self, n: int, rest: bool = False) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for k in range(n + rest):
            if len(part := ids[k * self.block_ids : (k + 1) * self.block_ids]):
                data = pack(part, self.bits)
                self.out.write(data)
                self.at += len(data)
                self.offsets.append(self.at)
        self.held, self.n_held = [ids[n * self.block_ids :]], max(0, len(ids) - n * self.block_ids)

    def close(self) -> None:
        self._blocks(0, rest=True)
        told = {"bits": self.bits, "block_ids": self.block_ids, "n_ids": self.n_ids, "n_docs": self.n_docs, "null_docs": self.nulls}
        body = json.dumps(told).encode() + b"\n" + np.concatenate([self.offsets, *self.doc_ids, *self.starts]).astype("<i8").tobytes()
        data = zlib.compress(body, 1)
        self.out.write(data + struct.pack("<q8s", len(data), MAGIC))


def _encoder(path: str) -> tuple[PieceTable | WholeTexts, int]:
    """(texts to ids by the tokenizers library, size of the vocabulary)"""
    if path not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_padding()
        library.no_truncation()
        told = json.loads(library.to_str())
        size = library.get_vocab_size()
        dtype = np.uint16 if size <= 1 << 16 else np.uint32

        def make(new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            counts, ids = [], []
            for a in range(0, len(new), 20_000):
                part = [x.decode("utf-8", "replace") for x in new[a : a + 20_000]]
                done = library.encode(part, is_pretokenized=True, add_special_tokens=False)
                counts.append(np.bincount(np.array(done.word_ids, np.int64), minlength=len(part)))
                ids.append(np.array(done.ids, dtype))
            return np.concatenate(counts), np.concatenate(ids)

        special = [x["content"] for x in told.get("added_tokens", [])]
        _WORKER[path] = (PieceTable(make, special, dtype) if can_be_cut(told) else WholeTexts(library, dtype)), size
    return _WORKER[path]


def encode_texts(texts: list[str | None], path: str) -> list[np.ndarray]:
    """The library's ids of each text."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for a, counts, values, _ in _encoder(path)[0].runs(*column_bytes(pa.array(texts, pa.large_string()))):
        ends = np.cumsum(counts)
        for k in np.flatnonzero(counts).tolist():
            out[a + k].append(values[ends[k] - counts[k] : ends[k]])
    return [np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]


def write_token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = END_ID, block_ids: int = BLOCK_IDS, partitions: int | None = None) -> DataFrame:
    """Write all documents; returns the manifest (part, path, size, n_docs, n_ids, start), one row a file."""
    path, spark = tokenizer or default_path(), docs.sparkSession
    folder = fresh_path(spark, "tokens")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        uri = f"{folder}/part-{part:06d}.tok"
        batch = next((b for b in rows if b.num_rows), None)
        if batch is None:
            return
        table_, vocabulary = _encoder(path)
        bits, done = bits_for(max(vocabulary, (end_id or 0) + 1)), {}

        def write(out) -> None:
            writer, now = _Writer(out, bits, block_ids, end_id), batch
            while now is not None:
                for a in range(0, now.num_rows, 1000):
                    writer.add(now.column(0).slice(a, 1000), table_.runs(*column_bytes(now.column(1).slice(a, 1000))))
                now = next(rows, None)
            writer.close()
            done["n_docs"], done["n_ids"] = writer.n_docs, writer.n_ids

        publish(uri, write)
        files, at = filesystem(uri)
        size = files.get_file_info(at).size
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [uri], "size": [size], "n_docs": [done["n_docs"]], "n_ids": [done["n_ids"]]}, pa.schema([("part", pa.int32()), ("path", pa.string()), ("size", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = lean.repartitionByRange(partitions, "doc_id") if partitions else lean.repartitionByRange("doc_id")
    written = durable(dealt.sortWithinPartitions("doc_id", "text").mapInArrow(run, "part int, path string, size long, n_docs long, n_ids long"), "manifest")
    # One row a file: the running sum is over the manifest, not over documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files of a manifest."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for uri, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, at = filesystem(uri)
                with files.open_input_file(at) as source:
                    yield from _digests(TokenFile(source, size), start)

    # One row a file, each read by a task of its own; a stated number is not coalesced to one task.
    dealt = manifest.repartitionByRange(max(1, manifest.count()), "part")
    return dealt.select("path", "size", "start").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _digests(file: TokenFile, start: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Reads at most about ``most`` ids at a time, but always whole documents."""
    a = 0
    while a < file.n_docs:
        b = max(a + 1, int(np.searchsorted(file.starts, file.starts[a] + most, side="right")) - 1)
        b = min(b, file.n_docs)
        first = int(file.starts[a])
        data = memoryview(file.ids(first, int(file.starts[b])).astype("<u4").tobytes())
        at = (file.starts[a : b + 1] - first) * 4
        crc = [zlib.crc32(data[x:y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        ids = pa.array(file.doc_ids[a:b], pa.int64(), mask=np.arange(a, b) < file.null_docs)
        yield pa.RecordBatch.from_arrays([ids, pa.array(file.starts[a:b] + start), pa.array(np.diff(file.starts[a : b + 1])), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
        a = b


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents")))
