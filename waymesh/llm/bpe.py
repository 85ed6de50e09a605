"""Exact memory of pieces for byte-level BPE: a text is cut where no token can cross, and each distinct piece
is done once.

The pre-tokenizer of these vocabularies reads `` ?letters``, `` ?digits``, `` ?others``, white space and the
contractions behind an apostrophe, and looks ahead only. So a text may be cut, with the same tokens before and
behind, where a run of letters or digits ends, where a run of other signs meets a letter or digit (unless the
last sign is an apostrophe), before white space, and behind a single line break or tab. Cuts are made at bytes
whose kind is certain (ASCII, the Latin and Cyrillic letters of two bytes); other characters are cut only
before white space that follows them. Strings of special tokens are pieces of their own.

``PieceTable`` works on the UTF-8 bytes of a batch with numpy, without a Python object for each piece. It knows
a piece by two 64-bit hashes, keeps the values of all pieces in one array, and forgets the pieces that were not
met again when it is full. Pieces over ``LONG`` bytes are never kept. Memory is bounded by the number of slots
and by a chunk of text, not by the table or by the longest text (one piece is the exception: it is a
pre-token, and the library needs it whole).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from waymesh.llm.wordhash import GOLDEN, mix, span_sums

LONG = 64
CHUNK = 1 << 20
SLOTS_LOG2 = 21

_LETTER, _DIGIT, _SIGN, _APOSTROPHE, _SPACE, _BREAK = range(1, 7)
#: Kind of a byte; 0 where a byte alone does not tell.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[39] = _APOSTROPHE
_KIND[[9, 10, 11, 12, 13]] = _BREAK
_KIND[32] = _SPACE
#: First bytes of two-byte characters that are all letters (but for U+00D7 and U+00F7): U+00C0-U+017F, U+0400-U+047F.
_PAIRS = np.zeros(256, bool)
_PAIRS[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1]] = True
_KIND[_PAIRS] = _LETTER
#: May a piece begin between these kinds? Cuts behind a break are made apart.
_CUT = np.zeros((8, 8), bool)
for _a, _others in {
    _LETTER: (_DIGIT, _SIGN, _APOSTROPHE, _SPACE, _BREAK),
    _DIGIT: (_LETTER, _SIGN, _APOSTROPHE, _SPACE, _BREAK),
    _SIGN: (_LETTER, _DIGIT, _SPACE, _BREAK),
    _APOSTROPHE: (_DIGIT, _SPACE, _BREAK),
}.items():
    _CUT[_a, list(_others)] = True
_CUT = _CUT.reshape(-1)
#: First bytes, or first two, of white space beyond ASCII: U+0085, U+00A0, U+1680, U+2000-U+205F, U+3000.
_WIDE_SPACES = ((0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80))

_VALUES = tuple(mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(k)) for k in (0xD6E8FEB86659FD93, 0xA24BAED4963EE407))


def cuts(data: np.ndarray) -> np.ndarray:
    """Where pieces begin in the bytes of a text, or of texts that begin at the start of other pieces."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = _KIND[data]
    wide = data >= 0x80
    if wide.any():
        second = np.flatnonzero(_PAIRS[data[:-1]]) + 1
        kind[second] = _LETTER
        sign = second[(data[second - 1] == 0xC3) & ((data[second] & 0xDF) == 0x97)]
        kind[sign] = kind[sign - 1] = 0
    go = np.zeros(n, bool)
    go[0] = True
    go[1:] = _CUT[kind[:-1] << 3 | kind[1:]]
    space = kind >= _SPACE
    if wide.any():
        at = np.flatnonzero(space[1:] & (kind[:-1] == 0) & wide[:-1]) + 1
        if len(at):
            b2, b3 = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
            unsure = b2 == 0xC2
            for x, y in _WIDE_SPACES:
                unsure |= (b3 == x) & (b2 == y)
            go[at[~unsure]] = True
    if n > 2:
        one = np.flatnonzero((kind[1:-1] == _BREAK) & (kind[:-2] > 0) & ~space[:-2] & (kind[2:] > 0) & ~space[2:]) + 2
        go[one] = True
    return np.flatnonzero(go)


def pieces(text: str) -> list[str]:
    """The pieces of a text without special strings; they concatenate to the text."""
    raw = text.encode("utf-8")
    at = [*cuts(np.frombuffer(raw, np.uint8)).tolist(), len(raw)]
    return [raw[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), off


class PieceTable:
    """Values of pieces. ``make`` gets distinct pieces (bytes) and returns the number of values of each and all
    values in order, or None where only the numbers count."""

    def __init__(self, make: Callable, special: list[str], dtype=np.uint32, slots_log2: int = SLOTS_LOG2):
        self.make, self.bits, self.dtype = make, slots_log2, dtype
        self.limit = (1 << slots_log2) * 5 // 8
        self.special = re.compile(b"|".join(re.escape(x.encode()) for x in sorted(special, key=len, reverse=True))) if special else None
        self._clear()

    def _clear(self) -> None:
        n = 1 << self.bits
        self.key, self.check = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.ref, self.count, self.met = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.uint8)
        self.size = self.filled = 0
        self.values = np.zeros(1 << 16, self.dtype)

    def _append(self, values: np.ndarray | None) -> int:
        at = self.filled
        if values is not None:
            if at + len(values) > len(self.values):
                grown = np.zeros(max(at + len(values), len(self.values) * 3 // 2), self.dtype)
                grown[:at] = self.values[:at]
                self.values = grown
            self.values[at : at + len(values)] = values
            self.filled += len(values)
        return at

    def _find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The slot of each piece, -1 where it is unknown."""
        at = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.key[at]
        hit = (found == key) & (self.check[at] == check)
        out = np.where(hit, at, -1)
        todo = np.flatnonzero(~hit & (found != 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.key[at[todo]]
            hit = (found == key[todo]) & (self.check[at[todo]] == check[todo])
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit & (found != 0)]
        return out

    def _insert(self, key: np.ndarray, check: np.ndarray, ref: np.ndarray, count: np.ndarray) -> None:
        """Pieces that are not in the table, each once."""
        at, waiting = (key >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(len(key))
        while len(waiting):
            own = at[waiting]
            first = np.zeros(len(own), bool)
            first[np.unique(own, return_index=True)[1]] = True
            win = first & (self.key[own] == 0)
            slot, who = own[win], waiting[win]
            self.key[slot], self.check[slot], self.ref[slot], self.count[slot], self.met[slot] = key[who], check[who], ref[who], count[who], 1
            waiting = waiting[~win]
            at[waiting] = (at[waiting] + 1) & ((1 << self.bits) - 1)
        self.size += len(key)

    def _sweep(self) -> None:
        """Keep what was met again since the last sweep, at most half of the limit."""
        kept = np.flatnonzero(self.met > 1)
        kept = kept[:: 1 + len(kept) * 2 // self.limit]
        key, check, count = self.key[kept], self.check[kept], self.count[kept]
        start = np.cumsum(count) - count
        values = self._gather(self.ref[kept], count) if self.filled else None
        self._clear()
        self._append(values)
        self._insert(key, check, start, count)

    def _gather(self, ref: np.ndarray, count: np.ndarray) -> np.ndarray:
        count = count.astype(np.int64)
        start = np.cumsum(count) - count
        return self.values[np.repeat(ref - start, count) + np.arange(int(count.sum()))]

    def _chunk(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """(number of values of each piece, all values in order) for the pieces that begin at ``at``."""
        if self.size > self.limit:
            self._sweep()
        end = np.append(at[1:], len(data))
        length = end - at
        short = length <= LONG
        slot = np.zeros(len(at), np.int64)
        raw = data.tobytes()
        if short.any():
            key, check = (mix(x + length.astype(np.uint64) * GOLDEN) for x in span_sums(data, at, end, _VALUES))
            key |= np.uint64(1)
            slot[short] = self._find(key[short], check[short])
            self.met[slot[short & (slot >= 0)]] = 2
            todo = np.flatnonzero((slot < 0) & short)
            while len(todo):
                _, first = np.unique(key[todo], return_index=True)
                new = todo[np.sort(first)]
                count, values = self.make([raw[a:b] for a, b in zip(at[new].tolist(), end[new].tolist(), strict=True)])
                self._insert(key[new], check[new], self._append(values) + np.cumsum(count) - count, count)
                slot[todo] = self._find(key[todo], check[todo])
                todo = todo[slot[todo] < 0]
        count, ref, held = self.count[slot].astype(np.int64), self.ref[slot].astype(np.int64), self.filled
        if not short.all():
            which: dict[bytes, int] = {}
            big = np.flatnonzero(~short)
            of = [which.setdefault(raw[a:b], len(which)) for a, b in zip(at[big].tolist(), end[big].tolist(), strict=True)]
            n, values = self.make(list(which))
            start = self._append(values) + np.cumsum(n) - n
            count[big], ref[big] = n[of], start[of]
        out = self._gather(ref, count) if self.filled else None
        self.filled = held
        return count, out

    def _specials(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Borders (start, end) of special strings that lie within one text."""
        found = []
        if self.special is not None:
            at = int(off[0])
            while (m := self.special.search(data, at, int(off[-1]))) is not None:
                a, b = m.span()
                inside = np.searchsorted(off, a, side="right") == np.searchsorted(off, b, side="left")
                if inside:
                    found.append((a, b))
                at = b if inside else a + 1
        return np.array(found, np.int64).reshape(-1, 2)

    def _cuts(self, data: np.ndarray, a: int, b: int, begins: np.ndarray, special: np.ndarray) -> np.ndarray:
        """Where pieces begin in a..b-1; ``begins`` are the starts of texts."""
        go = np.zeros(b - a, bool)
        go[cuts(data[a:b])] = True
        go[begins[(begins >= a) & (begins < b)] - a] = True
        for x, y in special[(special[:, 1] > a) & (special[:, 0] < b)].tolist():
            go[max(x + 1, a) - a : y - a] = False
            for z in (x, y):
                if a <= z < b:
                    go[z - a] = True
        return np.flatnonzero(go)

    def runs(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray | None, bool]]:
        """(first text, numbers of values, all values, is the last text complete?), a chunk at a time; a text
        longer than a chunk comes in parts."""
        special, i, n = self._specials(data, off), 0, len(off) - 1
        while i < n:
            j = int(np.searchsorted(off, off[i] + CHUNK, side="right")) - 1
            a, end = int(off[i]), int(off[max(j, i + 1)])
            if j > i:
                at = self._cuts(data, a, end, off[i:j], special)
                count, values = self._chunk(data[a:end], at) if len(at) else (np.zeros(0, np.int64), None)
                text = np.searchsorted(off[i : j + 1], at + a, side="right") - 1
                yield i, np.bincount(text, weights=count, minlength=j - i).astype(np.int64), values, True
                i = j
                continue
            while a < end:
                room = CHUNK
                while True:
                    b = min(a + room, end)
                    at = self._cuts(data, a, b, off[i : i + 1], special)
                    if b == end or len(at) > 1:
                        break
                    room *= 2
                if len(at) > 1 and room > CHUNK:  # a giant piece goes alone
                    b, at = a + int(at[1]), at[:1]
                elif b < end:
                    b, at = a + int(at[-1]), at[:-1]
                count, values = self._chunk(data[a:b], at)
                yield i, np.array([int(count.sum())]), values, b == end
                a = b
            i += 1


class WholeTexts:
    """The same interface for tokenizers whose texts can not be cut: every text goes to the library whole."""

    def __init__(self, library, dtype=np.uint32):
        self.library, self.dtype = library, dtype

    def runs(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
        for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
            ids = np.array(self.library.encode(data[a:b].tobytes().decode("utf-8", "replace"), add_special_tokens=False).ids, self.dtype)
            yield i, np.array([len(ids)]), ids, True


def can_be_cut(told: dict) -> bool:
    """Does a tokenizer file describe the pre-tokenizer that ``cuts`` is for?"""
    before, model = told.get("pre_tokenizer") or {}, told["model"]
    plain = all(not (x.get("single_word") or x.get("lstrip") or x.get("rstrip") or x.get("normalized")) for x in told.get("added_tokens", []))
    byte_level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
    return model.get("type", "BPE") == "BPE" and byte_level and not told.get("normalizer") and not told.get("truncation") and plain
