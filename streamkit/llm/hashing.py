"""Word hashes of whole Arrow batches with NumPy.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D`` (in UTF-8 those
bytes are never part of another character).  A word's hash is a polynomial
of its bytes modulo 2**64, read off one prefix sum over the batch, then mixed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE = 1 << 18  # bytes hashed together; longer documents go in pieces of this size
BASE = 0x9E3779B97F4A7C15 | 1

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_powers: list[np.ndarray] = [np.ones(1, dtype=U), np.ones(1, dtype=U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, n of each at least."""
    if len(_powers[0]) < n:
        size = max(n, SLICE + 1)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _hash_run(data: np.ndarray, cuts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of ``data``; no word spans a cut."""
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SPACE[data]
    first = np.ones(n, dtype=bool)
    first[1:] = ~word[:-1]
    inner = cuts[(cuts > 0) & (cuts < n)]
    first[inner] = True
    starts = np.flatnonzero(first & word)
    last = np.ones(n, dtype=bool)
    last[:-1] = ~word[1:]
    last[inner - 1] = True
    ends = np.flatnonzero(last & word) + 1
    up, down = _power(n)
    codes = (LOWER[data] if lower else data).astype(U) + U(1)
    total = np.zeros(n + 1, dtype=U)
    np.cumsum(codes * up[:n], out=total[1:])
    raw = (total[ends] - total[starts]) * down[starts]
    return mix(raw ^ (ends - starts).astype(U)), starts, ends


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text cut at white space, about SLICE bytes each."""
    at = 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        while end < len(data):
            space = np.flatnonzero(SPACE[data[at:end]])
            if len(space):
                end = at + int(space[-1]) + 1
                break
            end = min(len(data), end + (end - at))  # one word longer than that
        yield data[at:end]
        at = end


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), off.astype(np.int64)


def word_hashes(col: pa.Array, lower: bool = False) -> Iterator[np.ndarray]:
    """One array of word hashes for each text of the column, in order."""
    data, off = text_bytes(col)
    at, n = 0, len(off) - 1
    while at < n:
        end = at + 1
        if off[end] - off[at] > SLICE:
            yield np.concatenate([_hash_run(p, np.zeros(0, np.int64), lower)[0]
                                  for p in _pieces(data[off[at]:off[end]])])
            at = end
            continue
        while end < n and off[end + 1] - off[at] <= SLICE:
            end += 1
        cuts = off[at:end + 1] - off[at]
        hashes, starts, _ = _hash_run(data[off[at]:off[end]], cuts, lower)
        marks = np.searchsorted(starts, cuts)
        for i in range(end - at):
            yield hashes[marks[i]:marks[i + 1]]
        at = end


def shingles(words: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hash of each run of k words, in order; none if there are fewer words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    out = mix(words[:n], seed)
    for j in range(1, k):
        out = mix((out << U(7) | out >> U(57)) ^ words[j:j + n], seed + j)
    return out


def rolling(words: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Polynomial hash of each run of k words by one prefix sum (any k at one cost)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    up, down = _power(len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=U)
    np.cumsum(mix(words, seed) * up[:len(words)], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[:n], seed + 1)


def spans(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of the words [start, end) of each pair."""
    up, down = _power(len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=U)
    np.cumsum(mix(words, seed) * up[:len(words)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U), seed + 1)
