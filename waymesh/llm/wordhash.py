"""Word and shingle hashes of whole batches of texts, in numpy, without a Python object for each word.

The hash of a word is a polynomial in its bytes modulo 2**64, taken as a difference of running sums over
the whole batch, and then stirred. Bytes tell white space (space, \\t to \\r) and A-Z; nothing else is
split at or lower-cased.
"""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Odd, and 1 - BASE has a single factor 2, so that changing places of two bytes changes the sum.
BASE = 0x9AB5D9A1F3C7E54B
_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_VALUE_LOWER = _VALUE.copy()
_VALUE_LOWER[65:91] = _VALUE[97:123]
_CACHE: dict[str, np.ndarray] = {}
_CHUNK = 1 << 20


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("p", ())) < n:
        _CACHE["p"], _CACHE["i"] = _powers(BASE, n), _powers(_INVERSE, n)
    return _CACHE["p"][:n], _CACHE["i"][:n]


def span_sums(buffer: np.ndarray, start: np.ndarray, end: np.ndarray, values: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    """The polynomial of the bytes of every span, modulo 2**64, for each table of byte values."""
    up, down = _power_tables(len(buffer))
    out = []
    for value in values:
        total = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(value[buffer] * up, out=total[1:])
        out.append((total[end] - total[start]) * down[start])
    return out


def word_hashes(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of every text in order, number of words of each text)."""
    data = [x.encode("utf-8", "surrogatepass") if x else b"" for x in texts]
    buffer = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    space = _SPACE[buffer]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start = edge[space[edge - 1]]
    if len(space) and not space[0]:
        start = np.append(0, start)
    end = edge[space[edge]]
    ends_of_texts = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1)
    counts = np.diff(np.searchsorted(start, ends_of_texts), prepend=0)
    value, out = (_VALUE_LOWER if lower else _VALUE), np.empty(len(start), np.uint64)
    # In chunks that begin at a word, so that the tables of powers stay small; a longer word gets its own.
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + _CHUNK, side="right")))
        low, high = int(start[a]), int(end[b - 1])
        up, down = _power_tables(high - low)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(value[buffer[low:high]] * up, out=total[1:])
        out[a:b] = (total[end[a:b] - low] - total[start[a:b] - low]) * down[start[a:b] - low]
        a = b
    return mix(out), counts


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles: with fewer words, the whole sequence as one."""
    word, counts = word_hashes(texts)
    whole = np.zeros(0, np.uint64)
    if len(word) >= size:
        n = len(word) - size + 1
        whole = word[:n].copy()
        for k in range(1, size):
            whole = mix(whole * GOLDEN + word[k : k + n] + np.uint64(k))
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            own = np.sort(whole[at : at + n - size + 1])
            if len(own) > 1:
                first = np.empty(len(own), bool)
                first[0] = True
                np.not_equal(own[1:], own[:-1], out=first[1:])
                own = own[first]
            out.append(own)
        else:
            few = np.array([n], np.uint64)
            for k in range(n):
                few = mix(few * np.uint64(31) ^ word[at + k : at + k + 1])
            out.append(few[: min(n, 1)])
        at += n
    return out
