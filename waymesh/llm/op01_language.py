"""Operator 1: language identification of whole texts and of spans within them.

A word is a run of letters and the marks on them. Its script, from code-point ranges, narrows the candidates to the languages that
were seen to use that script; the others are barred. Its score for each candidate adds up, over its letters,
how much more often the language has the letter pairs and triples of the word than languages do on average
(hashed n-grams, bounded table). A Viterbi pass over a text's words finds the best sequence of languages under
a penalty for every switch; runs of one language are the spans of mixed-language text. The language of the
text is the one with the most letters; the score is its share of all letters.

The model is fitted on at most about ``sample`` labelled documents of each language, chosen by a hash of
doc_id; only doc_id (to choose), text and lang of rows outside the held-out third are read. Everything is one
pass without a shuffle; only counts of n-grams, at most 2**24 for all languages together, come to the driver.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as is everything if nothing is
labelled. A text that only has words in scripts no language uses gets the first learned language with score
1 / languages. Ties go to the language that sorts first. A row without doc_id is not learned from and not held
out. Repeated rows repeat; other columns are ignored. Very long texts are labelled whole; they are read piece by
piece, and what is held of them is a row of scores for each word.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm.common import give_back, table

UNKNOWN = "und"
SAMPLE = 3000
SWITCH_PENALTY = 12.0
SLOTS_LOG2 = 20
#: A worker's table has 2**TABLE_LOG2 numbers at most: more than 16 languages share fewer slots each.
TABLE_LOG2 = 24
#: ``accepted`` takes the language for unknown where less of the letters than this is in words of known scripts.
LEAST_KNOWN = 0.5
_END = 0x110000
_TOP = 0x40000
_PART = 1_000_000
#: Characters of the texts that are decoded side by side; a row for each of their words is held.
_ABREAST = 4_000_000
_ROWS = 2000
_BARRED = -30.0
#: First code point of each script range (public Unicode block bounds) and a name for the script.
SCRIPTS = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other-indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1400, "other"), (0x1780, "khmer"),
    (0x1800, "other"), (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"),
    (0x2E00, "han"), (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7FC, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0x10000, "other"), (0x20000, "han"),
)
_NAMES = sorted({name for _, name in SCRIPTS})
_TABLES: dict = {}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Is it a letter, a mark, its lower case, its script: for code points below _TOP; above are none."""
    if not _TABLES:
        kind = [unicodedata.category(chr(i))[0] for i in range(_TOP)]
        _TABLES["letter"] = np.fromiter((x == "L" for x in kind), bool, _TOP)
        _TABLES["mark"] = np.fromiter((x == "M" for x in kind), bool, _TOP)
        lower = [chr(i).lower() for i in range(_TOP)]
        _TABLES["lower"] = np.fromiter((ord(x) if len(x) == 1 else i for i, x in enumerate(lower)), np.uint32, _TOP)
        starts = np.array([a for a, _ in SCRIPTS])
        ids = np.array([_NAMES.index(name) for _, name in SCRIPTS])
        _TABLES["script"] = ids[np.maximum(0, np.searchsorted(starts, np.arange(_TOP), side="right") - 1)].astype(np.int8)
    return _TABLES["letter"], _TABLES["mark"], _TABLES["lower"], _TABLES["script"]


def _slot(a: np.ndarray, b: np.ndarray, c: np.ndarray, bits: int) -> np.ndarray:
    """The table row of a letter triple, or of a pair (then ``a`` is all ones)."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + c.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Words:
    """The words of some texts: where they stand, of which text and script."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray


def read_words(texts: list[str], bits: int) -> tuple[Words, np.ndarray, tuple, tuple]:
    """The words, and for their n-grams: the place of each word's first letter, the slots of the pairs and triples
    that end in each letter, and of those that end in the end of each word."""
    letter, mark, lower, script = _tables()
    length = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    near = np.minimum(codes, _TOP - 1)
    is_letter = letter[near]
    inside = is_letter | mark[near]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    start, end = edge[::2], edge[1::2]
    at = np.flatnonzero(inside)
    letters = np.cumsum(is_letter)
    real = letters[end - 1] - letters[start] + is_letter[start] > 0
    if not real.all():  # marks without a letter
        at = at[np.repeat(real, end - start)]
        start, end = start[real], end[real]
    base = np.cumsum(length) - length
    text = np.searchsorted(base, start, side="right") - 1
    c = lower[near[at]]
    size = end - start
    first = np.cumsum(size) - size
    p1 = np.empty_like(c)
    p1[1:], p1[:1] = c[:-1], 0
    p2 = np.empty_like(c)
    p2[2:], p2[:2] = c[:-2], 0
    p1[first] = 0
    p2[first] = 0
    p2[(first + 1)[size > 1]] = 0
    pair, last = np.full(1, 0xFFFFFFFF, np.uint32), first + size - 1
    stop = np.full(1, _END, np.uint32)
    slots = _slot(p2, p1, c, bits), _slot(pair, p1, c, bits)
    end_slots = _slot(p1[last], c[last], stop, bits), _slot(pair, c[last], stop, bits)
    return Words(start - base[text], end - base[text], text, script[near[start]]), first, slots, end_slots


def _cut(text: str, a: int) -> int:
    """The end of a piece of about _PART characters from a on; no word crosses it."""
    b = a + _PART
    if b >= len(text):
        return len(text)
    inside = lambda i: unicodedata.category(text[i])[0] in "LM"
    back = b
    while back > a and inside(back - 1) and inside(back):
        back -= 1
    if back > a:
        return back
    while b < len(text) and inside(b):
        b += 1
    return b


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Groups of about _PART characters: the texts' numbers, the places where the pieces begin, the pieces."""
    who, where, what, total = [], [], [], 0
    for i, x in enumerate(texts):
        a = 0
        while x and a < len(x):
            b = _cut(x, a)
            who.append(i)
            where.append(a)
            what.append(x[a:b])
            total += b - a
            a = b
            if total >= _PART:
                yield who, where, what
                who, where, what, total = [], [], [], 0
    if who:
        yield who, where, what


@dataclass
class Model:
    """``table`` (slots, languages): the centred log share of a slot; ``allowed`` (scripts, languages)."""

    languages: list[str]
    slots: np.ndarray
    values: np.ndarray
    allowed: np.ndarray

    bits: int = SLOTS_LOG2

    def dense(self) -> np.ndarray:
        if "_full" not in self.__dict__:
            full = np.zeros((1 << self.bits, len(self.languages)), np.float32)
            full[self.slots] = self.values
            self.__dict__["_full"] = full
        return self.__dict__["_full"]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_full"}

    def scores(self, script: np.ndarray, first: np.ndarray, slots: tuple, end_slots: tuple) -> np.ndarray:
        """(words, languages)"""
        grams = self.dense()
        out = np.zeros((len(script), len(self.languages)), np.float32)
        # So many words at once that a row for each letter stays small, whatever the number of languages.
        step = max(1, 2_000_000 // (8 * max(1, len(self.languages))))
        for a in range(0, len(script), step):
            b = min(a + step, len(script))
            x, y = first[a], first[b] if b < len(first) else len(slots[0])
            by_letter = grams[slots[0][x:y]]
            by_letter += grams[slots[1][x:y]]
            out[a:b] = np.add.reduceat(by_letter, first[a:b] - x, axis=0)
        out += grams[end_slots[0]]
        out += grams[end_slots[1]]
        allowed = self.allowed[script]
        none = ~allowed.any(axis=1)
        out[none] = 0
        return np.where(allowed | none[:, None], out, np.float32(_BARRED))


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word, all texts of the batch abreast, one word of each at a time."""
    starts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    starts, length = starts[order], counts[order]
    most = int(length[0]) if len(length) else 0
    active = len(length) - np.searchsorted(length[::-1], np.arange(most), side="right")
    value = np.zeros((len(length), scores.shape[1]))
    stay = np.ones(scores.shape, bool)
    source = np.zeros(len(scores), np.int16)
    for t, n in enumerate(active.tolist()):
        at, v = starts[:n] + t, value[:n]
        if t:
            best = v.argmax(axis=1)
            bar = (v[np.arange(n), best] - penalty)[:, None]
            stay[at], source[at] = v >= bar, best
            np.maximum(v, bar, out=v)
        v += scores[at]
    out = np.zeros(len(scores), np.int16)
    now = value.argmax(axis=1)
    for t in range(most - 1, -1, -1):
        n = int(active[t])
        at, own = starts[:n] + t, now[:n]
        out[at] = own
        if t:
            now[:n] = np.where(stay[at, own], own, source[at])
    return out


def parts(texts: list[str | None], most: int = _PART) -> Iterator[tuple[int, int]]:
    at = total = 0
    for i, x in enumerate(texts):
        total += len(x or "")
        if total >= most:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def label(texts: list[str | None], model: Model, penalty: float = SWITCH_PENALTY) -> tuple[Words, np.ndarray]:
    """The words of the texts and their languages. What is held is a row for each word, not for each letter."""
    found, scores = [], [np.zeros((0, len(model.languages)), np.float32)]
    for who, where, what in pieces(texts):
        w, *grams = read_words(what, model.bits)
        scores.append(model.scores(w.script, *grams))
        at = np.array(where)[w.text]
        found.append((w.start + at, w.end + at, np.array(who)[w.text], w.script))
    own = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
    words = Words(*own)
    return words, viterbi(np.concatenate(scores), np.bincount(words.text, minlength=len(texts)), penalty)


def predict(texts: list[str | None], model: Model, penalty: float = SWITCH_PENALTY) -> tuple[list[str], np.ndarray, np.ndarray]:
    """For each text its language, the score, and the share of its letters in words of a known script."""
    names, score, known = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    n = len(model.languages)
    for a, b in parts(texts, _ABREAST // max(1, n // 8)) if n else ():
        words, labels = label(texts[a:b], model, penalty)
        letters = (words.end - words.start).astype(float)
        share = np.bincount(words.text * n + labels, weights=letters, minlength=(b - a) * n).reshape(-1, n)
        in_known = np.bincount(words.text, weights=letters * model.allowed[words.script].any(axis=1), minlength=b - a)
        total, best = share.sum(axis=1), share.argmax(axis=1)
        some = total > 0
        known[a:b][some] = in_known[some] / total[some]
        top = share[np.arange(b - a), best] / np.maximum(total, 1)
        score[a:b] = np.where(some, np.where(in_known > 0, top, 1.0 / n), 0.0)
        for k in np.flatnonzero(some).tolist():
            names[a + k] = model.languages[best[k]]
    return names, score, known


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from labelled documents (doc_id, text, lang) outside the held-out third."""
    rows = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros((len(_NAMES), 0), bool))
    # The dense table of a worker has 2**24 numbers at most, whatever the number of languages.
    bits = max(12, min(SLOTS_LOG2, TABLE_LOG2 - (len(languages) - 1).bit_length()))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang in languages:
        chosen = chosen | ((F.col("lang") == lang) & (draw < int(min(1.0, sample / sizes[lang]) * (1 << 30))))
    rows = rows.where(chosen).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                for _, _, what in pieces(own):
                    w, _, slots, end_slots = read_words(what, bits)
                    slot, n = np.unique(np.concatenate([*slots, *end_slots]), return_counts=True)
                    script, words = np.unique(w.script, return_counts=True)
                    slot, n = np.concatenate([slot, -1 - script.astype(np.int64)]), np.concatenate([n, words])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(n)], ["lang", "slot", "n"])
        give_back()

    counts = rows.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    lang = np.searchsorted(np.array(languages), np.array(found["lang"].to_pylist())) if found.num_rows else np.zeros(0, np.int64)
    slot, n = found["slot"].to_numpy(), found["n"].to_numpy()
    allowed = np.zeros((len(_NAMES), len(languages)), bool)
    words = np.zeros(allowed.shape)
    of = slot < 0
    words[-1 - slot[of], lang[of]] = n[of]
    allowed |= words >= np.maximum(1, 0.001 * words.sum(axis=0, keepdims=True))
    slots, at = np.unique(slot[~of], return_inverse=True)
    table_ = np.zeros((len(slots), len(languages)))
    table_[at, lang[~of]] = n[~of]
    total = table_.sum(axis=0, keepdims=True)
    share = np.log((table_ + 0.5) / (total + 0.5 * max(1, len(slots))))
    # Pairs and triples overlap, so their evidence is counted at half its weight.
    values = 0.5 * (share - share.mean(axis=1, keepdims=True))
    return Model(languages, slots, values.astype(np.float32), allowed, bits)


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs (doc_id, text, ...)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                lang, score, _ = predict(part.column(2).to_pylist(), sent.value, penalty)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])
        give_back()

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return lean.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least_known: float = LEAST_KNOWN, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The rows of docs whose language is known: not ``und``, and at least this share of the letters in words of a
    script that a learned language uses, however many languages the text mixes. A null lang is filled with the
    prediction; a given one is kept. Without a model no row has a known language. Other columns, whatever their
    names, stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    text_at, lang_at = names.index("text"), names.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                lang, _, share = predict(part.column(text_at).to_pylist(), sent.value, penalty)
                known = pa.array((np.array(lang, object) != UNKNOWN) & (share >= least_known))
                filled = pc.coalesce(part.column(lang_at), pa.array(lang, pa.string()).cast(part.column(lang_at).type))
                yield part.set_column(lang_at, batch.schema.field(lang_at), filled).filter(known)
        give_back()

    return docs.mapInArrow(run, docs.schema)


def spans(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """doc_id, start, end (code points), lang: a row for each maximal run of words of one language."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in parts(texts) if sent.value.languages else ():
                w, labels = label(texts[a:b], sent.value, penalty)
                new = np.flatnonzero(np.append(True, (w.text[1:] != w.text[:-1]) | (labels[1:] != labels[:-1]))[: len(labels)])
                last = np.append(new[1:], len(labels)) - 1 if len(new) else new
                yield pa.RecordBatch.from_arrays([pa.array([ids[a + k] for k in w.text[new]], pa.int64()), pa.array(w.start[new]), pa.array(w.end[last]), pa.array([sent.value.languages[k] for k in labels[new]], pa.string())], ["doc_id", "start", "end", "lang"])
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, start long, end long, lang string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
