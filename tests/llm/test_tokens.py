"""Token counts and token files against the tokenizers library on whole texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from waymesh.llm import bpe
from waymesh.llm import op02_token_counts as counts
from waymesh.llm import op06_token_ids as ids
from waymesh.llm.bpe import pieces

TEXTS = [
    "", " ", "  ", "a  b", "a\n  b", "\n\n a", "foo \nbar", "x\t y", "<|endoftext|> a<|endoftext|>b", "a" * 5000,
    "a  b", "don't we'll 12 345", "　 　x", "foo\n \nbar baz", "  lead", "trail  ", "é \U0001f600\U0001f600",
    "a \n", "a \n b \n\n  c\r\n d", "the the the " * 3000, "ababab" * 999 + " abab",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(counts.default_path())


def test_pieces_join_to_the_text():
    for text in TEXTS:
        assert "".join(pieces(text)) == text


def test_counts_equal_the_library(library):
    want = [len(library.encode(x, add_special_tokens=False).ids) for x in TEXTS]
    assert counts.count_texts(TEXTS, counts.default_path()) == want


def test_random_texts_in_small_chunks(library, monkeypatch):
    rnd = random.Random(11)
    signs = [*"ab  \n\n\t'.,1é×÷ß—\u00a0\u3000、。中文ñжЖ\u0301 \r\x0b\x1c\x7f\x85²", "<|endoftext|>", "'s", "'ll", "\U0001f600", "<|endof"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(0, 40))) for _ in range(2000)] + ["ab" * 20_000 + " x" * 9000 + "."]
    want = [library.encode(x, add_special_tokens=False).ids for x in texts]
    monkeypatch.setattr(bpe, "CHUNK", 1 << 12)
    assert [x.tolist() for x in ids.encode_texts(texts, ids.default_path())] == want
    assert counts.count_texts(texts, counts.default_path()) == list(map(len, want))


def test_a_full_table_forgets_what_was_not_met_again():
    table = bpe.PieceTable(lambda new: (np.ones(len(new), np.int64), np.array([int(x) for x in new], np.uint32)), [], slots_log2=8)
    for k in range(60):
        texts = [" ".join(str(100 * k + i) for i in range(100)), "7 8 9"]
        data = bpe.column_bytes(pa.array([" ".join(texts)]))
        ((_, n, values, _),) = table.runs(*data)
        assert values.tolist() == [int(x) for x in " ".join(texts).split()] and n.tolist() == [103]
        assert table.size <= table.limit + 103


def test_tokenizers_that_can_not_be_cut():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Two  WORDS\n here.", None, ""]
    assert [x.tolist() for x in ids.encode_texts(texts, path)] == [Tokenizer.from_file(path).encode(x or "", add_special_tokens=False).ids for x in texts]
    with pytest.raises(ValueError):
        counts.count_texts(texts, path)


def test_count_query(spark, library):
    rows = [(i, x, 1) for i, x in enumerate(TEXTS)] + [(99, None, 1), (99, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, counts.token_counts(docs).collect()))
    want = sorted((i, len((x or "").encode()), n := len(library.encode(x or "", add_special_tokens=False).ids), n > 1024) for i, x, _ in rows)
    assert got == want
    assert counts.token_counts(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 24, 31, 32])
def test_packing_round_trip(bits):
    values = np.random.default_rng(bits).integers(0, 1 << bits, 1003).astype(np.uint32)
    data = ids.pack(values, bits)
    assert len(data) == -(-1003 * bits // 8)
    assert (ids.unpack(data, 1003, bits) == values).all()


def test_token_files(spark, library):
    rows = [(7 * i % 23, x, "clash") for i, x in enumerate(TEXTS)] + [(None, "null id", None), (50, None, None), (51, "twice", None), (51, "twice", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    manifest = ids.write_token_files(docs, block_ids=100, partitions=3)
    got = sorted(map(tuple, ids.read_token_files(manifest).collect()), key=lambda r: r[1])
    at, want = 0, []
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        own = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((doc_id, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    assert got == want


def test_random_access(spark, library):
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(TEXTS)], "doc_id long, text string")
    (row,) = ids.write_token_files(docs, block_ids=64, partitions=1).collect()
    files, at = ids.filesystem(row.path)
    every = np.concatenate([library.encode(x, add_special_tokens=False).ids + [2] for x in TEXTS])
    with files.open_input_file(at) as source:
        file = ids.TokenFile(source, row.size)
        for a, b in ((0, 1), (63, 65), (0, len(every)), (100, 100), (len(every) - 3, len(every))):
            assert (file.ids(a, b) == every[a:b]).all()


def test_truncated_file_is_refused(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x y")], "doc_id long, text string")
    (row,) = ids.write_token_files(docs, partitions=1).collect()
    files, at = ids.filesystem(row.path)
    with files.open_input_file(at) as source, pytest.raises(ValueError):
        ids.TokenFile(source, row.size - 5)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ids.read_token_files(ids.write_token_files(docs)).count() == 0
