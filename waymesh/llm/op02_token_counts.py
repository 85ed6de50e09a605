"""Operator 2: token counts by rank-synchronous merging of arrays.

Pre-tokens of a batch lie one behind another in one numpy array of symbol ids. Each round looks up the
rank of every adjacent pair, finds each sequence's lowest rank, and applies that pair everywhere in its
sequence at once; sequences without a mergeable pair leave the batch. What is left of each sequence is
counted. Merging all occurrences of the lowest pair at once equals merging one after another, because a
merge only makes pairs of a higher rank.

Edge cases: a null text counts as empty (0 tokens, 0 bytes); an empty table gives an empty result; repeated
rows give repeated rows, and no result depends on their order; other columns are ignored. Memory: one Arrow
batch, worked on a megabyte at a time (very long texts too), and a bounded table of pieces.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm.bpe import PieceTable, can_be_cut, column_bytes
from waymesh.llm.common import table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024

_WORKER: dict = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class RankMerger:
    """Counts of byte-level BPE tokens from the tables of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        if not can_be_cut(told):
            raise ValueError("not a byte-level BPE file of the kind this operator merges")
        vocab, merges = told["model"]["vocab"], told["model"]["merges"]
        letters = _byte_letters()
        self.symbol = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left << 20 | right
        order = np.argsort(key, kind="stable")
        # A perfect table is not needed: pairs of an open-addressed hash are found in one or two probes.
        self.bits = 18
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.slot_rank = np.zeros(1 << self.bits, np.int64)
        self.slot_made = np.zeros(1 << self.bits, np.int64)
        waiting = order
        step = np.zeros(len(order), np.int64)
        while len(waiting):
            at = (self._hash(key[waiting]) + step) & ((1 << self.bits) - 1)
            free = self.slots[at] < 0
            _, first = np.unique(at, return_index=True)
            win = np.zeros(len(at), bool)
            win[first] = True
            win &= free
            self.slots[at[win]] = key[waiting[win]]
            self.slot_rank[at[win]] = waiting[win]
            self.slot_made[at[win]] = made[waiting[win]]
            waiting, step = waiting[~win], step[~win] + 1
        self.special = sorted((x["content"] for x in told.get("added_tokens", [])), key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def _hash(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, slot) of each pair; rank is 2**40 where the pair does not merge."""
        at = self._hash(key)
        rank = np.full(len(key), 1 << 40, np.int64)
        found = self.slots[at]
        hit = found == key
        rank[hit] = self.slot_rank[at[hit]]
        todo = np.flatnonzero(~hit & (found >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.slots[at[todo]]
            hit = found == key[todo]
            rank[todo[hit]] = self.slot_rank[at[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return rank, at

    def count_words(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each pre-token."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        out = length.copy()
        ids = np.flatnonzero(length > 1)
        sym = self.symbol[np.frombuffer(b"".join(w for w in words if len(w) > 1), np.uint8)]
        length = length[ids]
        while len(ids):
            start = np.cumsum(length) - length
            last = start + length - 1
            key = sym[:-1] << 20 | sym[1:]
            rank, slot = self.ranks(key)
            rank = np.append(rank, 1 << 40)
            rank[last] = 1 << 40
            low = np.minimum.reduceat(rank, start)
            go = low < 1 << 40
            out[ids[~go]] = length[~go]
            of = np.repeat(np.arange(len(ids)), length)
            hit = (rank == low[of]) & go[of]
            at = np.flatnonzero(hit)
            # In a run of overlapping occurrences every second one counts, from the left.
            new_run = np.append(True, (at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]]))
            begin = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            sym = sym.copy()
            sym[at] = self.slot_made[slot[at]]
            keep = go[of]
            keep[at + 1] = False
            length = np.bincount(of[keep], minlength=len(ids))[go]
            sym, ids = sym[keep], ids[go]
            done = length == 1
            if done.any():
                out[ids[done]] = 1
                keep = np.repeat(~done, length)
                sym, ids, length = sym[keep], ids[~done], length[~done]
        return out

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each piece, special strings being one token each."""
        extra = [0] * len(texts)
        if any(s in "\n".join(texts) for s in self.special):
            found = []
            for i, text in enumerate(texts):
                parts = self.split.split(text)
                extra[i] = len(parts) // 2
                found.append([w for part in parts[::2] for w in self.words.findall(part)])
        else:
            found = list(map(self.words.findall, texts))
        words = list(set().union(*found))
        known = dict(zip(words, self.count_words([w.encode() for w in words]).tolist(), strict=True)).__getitem__
        return [n + sum(map(known, x)) for n, x in zip(extra, found, strict=True)]


def _counter(path: str) -> PieceTable:
    if path not in _WORKER:
        merger = RankMerger(path)

        def make(new: list[bytes]) -> tuple[np.ndarray, None]:
            return np.array(merger.count([x.decode("utf-8", "replace") for x in new]), np.int64), None

        _WORKER[path] = PieceTable(make, merger.special)
    return _WORKER[path]


def count_column(column: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text of a column; the same counts as the library's for the file."""
    out = np.zeros(len(column), np.int64)
    for a, counts, _, _ in _counter(path).runs(*column_bytes(column)):
        out[a : a + len(counts)] += counts
    return out


def count_texts(texts: list[str], path: str) -> list[int]:
    return count_column(pa.array(texts, pa.large_string()), path).tolist()


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of docs (doc_id, text, ...). No shuffle."""
    path = tokenizer or default_path()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            counts = pa.array(count_column(batch.column(2), path))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], ["doc_id", "n_bytes", "n_tokens"])

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), F.col("text").cast("string").alias("text"))
    counted = lean.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
