"""Vectorised tokenising and hashing of Arrow string batches in numpy.

Everything here works on one contiguous UTF-8 buffer holding many texts, so the cost of a
short text is a few array elements and not a Python call.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A fixed odd 64-bit value per byte.
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_BYTE = np.arange(256, dtype=np.uint8)
LOWER_BYTE[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: All ASCII bytes but letters and digits.
IS_MARK = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; the table is kept up to 4M entries."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        made = []
        for base in (BASE, INVERSE):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        if size > 1 << 22:
            return made[0], made[1]
        _powers.clear()
        _powers[size] = (made[0], made[1])
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: bijective, spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * BASE**i, one longer than values."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each half-open span: equal spans have equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts] + (ends - starts).astype(np.uint64) * BASE)


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and the offsets of its values; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes together; a longer text stands alone, whole."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of texts lo..hi of a buffer; other separators by `apart`.

    starts, ends: byte positions in `data`; bounds[i]..bounds[i+1]: the words of text i.
    """

    def __init__(self, body: np.ndarray, offsets: np.ndarray, lo: int, hi: int, lower: bool = False, apart: np.ndarray = IS_SPACE):
        self.data = body[offsets[lo] : offsets[hi]]
        if lower:
            self.data = LOWER_BYTE[self.data]
        self.cuts = offsets[lo : hi + 1] - offsets[lo]
        word = ~apart[self.data]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        inner = self.cuts[(self.cuts > 0) & (self.cuts < len(word))]
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, self.cuts)

    def hashes(self) -> np.ndarray:
        return span_hash(prefix(BYTE_VALUE[self.data]), self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def runs(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of n items that stay inside their text, and the bounds of each text's runs."""
    have = np.maximum(np.diff(bounds) - n + 1, 0)
    out = np.zeros(len(have) + 1, dtype=np.int64)
    np.cumsum(have, out=out[1:])
    return np.arange(out[-1]) + np.repeat(bounds[:-1] - out[:-1], have), out


def run_hashes(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, their starts, and the bounds by text."""
    starts, out = runs(bounds, n)
    return span_hash(prefix(words), starts, starts + n), starts, out


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)
