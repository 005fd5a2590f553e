"""Vectorised word and shingle hashes for whole texts, used inside tasks.

A batch of texts becomes one UTF-8 buffer; every word gets a 64-bit polynomial hash from a running sum
over the buffer, so there is no Python work per word. Buffers are cut at separators near ``BLOCK``
bytes, which bounds the memory whatever the length of one text. Hashes are the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BLOCK = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_COEF = np.array([pow(0xD1342543DE82EF95, j + 1, 1 << 64) for j in range(64)], dtype=np.uint64)
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Separators: ASCII white space, or all ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[128:] = False
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    NOT_ALNUM[_c] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = max(n, BLOCK + (BLOCK >> 3))
        for k, base in ((0, _P), (1, _P_INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POW[k] = np.cumprod(x)
    return _POW[0][:n], _POW[1][:n]


def hash_runs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run buf[start:end] of a uint8 buffer."""
    p, inv = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def _cuts(buf: np.ndarray, sep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about BLOCK bytes that end behind a separator (one word is never cut)."""
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + BLOCK)
        if end < n:
            back = np.flatnonzero(sep[at:end])
            if len(back):
                end = at + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(sep[end:])
                end = end + int(ahead[0]) + 1 if len(ahead) else n
        yield at, end
        at = end


def joined(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 in one buffer with a line feed behind each, and where each text starts (one more
    entry than texts)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=at[1:])
    return np.frombuffer(b"\n".join(raw) + b"\n" if raw else b"", np.uint8), at


def runs(buf: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without separators."""
    edge = np.diff(np.concatenate(([True], separators[buf], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(texts: Sequence[str | None], separators: np.ndarray = SPACE,
                lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and each text's first word (one more entry)."""
    buf, at = joined([t.lower() if t and lower else t for t in texts])
    sep = separators[buf]
    hashes, where = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in _cuts(buf, sep):
        starts, ends = runs(buf[a:b], separators)
        hashes.append(hash_runs(buf[a:b], starts, ends))
        where.append(starts + a)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(where), at)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text and each text's first shingle. A text of 1 to k-1
    words has one shingle, all its words; an empty text has none."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    out_first = np.concatenate(([0], np.cumsum(count))).astype(np.int64)
    padded = np.concatenate((words, np.zeros(k, np.uint64)))
    s = np.zeros(len(words), np.uint64)
    for j in range(k):
        s += padded[j:j + len(words)] * _COEF[j]
    pos = np.arange(out_first[-1]) - np.repeat(out_first[:-1] - first[:-1], count)
    out = s[pos]
    for d in np.flatnonzero((n > 0) & (n < k)):
        w = words[first[d]:first[d + 1]]
        out[out_first[d]] = (w * _COEF[:len(w)]).sum(dtype=np.uint64)
    return mix(out), out_first


def slices(texts: Sequence[str | None], limit: int = 1 << 20) -> Iterator[slice]:
    """Consecutive slices of a batch that hold about ``limit`` characters each (at least one text)."""
    at = total = 0
    for i, t in enumerate(texts):
        total += len(t) if t else 0
        if total >= limit:
            yield slice(at, i + 1)
            at, total = i + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))
