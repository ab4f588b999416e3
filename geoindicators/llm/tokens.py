"""Vectorised word and shingle hashing over Arrow string columns (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
_TABLE = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=U)
    out[0] = 1
    np.multiply.accumulate(np.full(n - 1, base, dtype=U), out=out[1:])
    return out


_POW = _powers(0x100000001B3, _TABLE)
_BACK = _powers(pow(0x100000001B3, -1, 1 << 64), _TABLE)
_STEP = _powers(0xD6E8FEB86659FD93, 64)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII letters, digits and all bytes of characters beyond ASCII make words; the rest separates them.
NOT_WORD = np.ones(256, dtype=bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def text_chunks(texts: pa.Array, max_bytes: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a string array as (first row, rows, bytes, row offsets in bytes), null as empty.

    A slice holds ``max_bytes`` at most, or one longer text.
    """
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if len(texts) and texts.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1)
        yield row, end - row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


@dataclass
class Words:
    """Words of a slice: row of each, place of its first byte and after its last, 64-bit hash; rows in the slice."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    rows: int

    def first(self) -> np.ndarray:
        """Place of each row's first word, and the number of words at the end."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))


def split_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = IS_SPACE) -> Words:
    """Maximal runs of non-separator bytes; a row's border ends a word."""
    rows = len(offsets) - 1
    inside = ~separator[data]
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    if len(data):
        after[:-1] = inside[1:] & before[1:]
    end = np.flatnonzero(inside & ~after) + 1
    row = np.repeat(np.arange(rows), np.diff(np.searchsorted(start, offsets)))
    return Words(row, start, end, _hash(data, start, end), rows)


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of the bytes of each word: a difference of running sums, turned back by the power of the place it starts at."""
    if not len(start):
        return np.zeros(0, dtype=U)
    size = end - start
    if 4 * int(size.sum()) < len(data):
        return _hash_each(data, start, size)
    sums = np.zeros(len(data) + 1, dtype=U)
    value = sums[1:]
    np.add(data, U(1), out=value)
    whole = len(data) - len(data) % _TABLE
    value[:whole].reshape(-1, _TABLE)[:] *= _POW
    value[whole:] *= _POW[:len(data) - whole]
    np.cumsum(value, out=value)
    total = (sums[end] - sums[start]) * _BACK[start & (_TABLE - 1)]
    out = mix(total ^ (size.astype(U) * _ODD))
    over = np.flatnonzero(start // _TABLE != (end - 1) // _TABLE)  # there the powers begin anew
    if len(over):
        out[over] = _hash_each(data, start[over], size[over])
    return out


def _hash_each(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``_hash`` from the words' own bytes only, of any size."""
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(first, size)
    value = (data[at + np.repeat(start, size)].astype(U) + U(1)) * _POW[at & (_TABLE - 1)]
    if size.max() > _TABLE:
        value *= U(1) + U(2) * (at >> 16).astype(U)
    return mix(np.add.reduceat(value, first) ^ (size.astype(U) * _ODD))


def prefix_hash(data: np.ndarray, words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the first ``n`` bytes of each word longer than that."""
    long = np.flatnonzero(words.end - words.start > n)
    if not len(long):
        return np.zeros(0, np.int64), np.zeros(0, dtype=U)
    start = words.start[long]
    return words.row[long], mix(_hash(data, start, start + n) ^ U(n))


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every ``n`` words in a row; a row of 1 to n-1 words has one shingle, all its words."""
    w, row = words.hash, words.row
    if len(w) >= n:
        total = sum(w[i:len(w) - n + 1 + i] * _STEP[i + 1] for i in range(n))
        whole = row[:len(w) - n + 1] == row[n - 1:]
        out_row, out = row[:len(w) - n + 1][whole], mix(total[whole] ^ _ODD)
    else:
        out_row, out = row[:0], w[:0]
    first = words.first()
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.array([int((w[first[r]:first[r + 1]] * _STEP[1:1 + count[r]]).sum(dtype=U)) for r in short], dtype=U)
        out_row = np.concatenate([out_row, short])
        out = np.concatenate([out, mix(extra ^ (count[short].astype(U) + U(1)))])
        order = np.argsort(out_row, kind="stable")
        out_row, out = out_row[order], out[order]
    return out_row, out


def counted(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) in order, and how often each occurs."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(new)
    return row[at], key[at], np.diff(np.append(at, len(row)))


def counted48(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``counted``, for fewer than 65,536 rows and the upper 48 bits of the keys, by one sort of single values."""
    both = np.sort((row.astype(U) << U(48)) | (key >> U(16)))
    new = np.ones(len(both), dtype=bool)
    new[1:] = both[1:] != both[:-1]
    at = np.flatnonzero(new)
    both = both[at]
    return (both >> U(48)).astype(np.int64), both & U((1 << 48) - 1), np.diff(np.append(at, len(row)))
