"""Vectorised word segmentation and hashing over UTF-8 bytes.

Both word rules of this package depend on single ASCII bytes only (every byte
of a non-ASCII character is a word byte), so whole batches of texts can be cut
with array operations on their bytes, without decoding or regular expressions.
Word hashes are 64-bit; operators that must be exact compare words or sorted
hash sets afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def lower_table() -> np.ndarray:
    """A-Z to a-z, every other byte to itself."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def alnum_table() -> np.ndarray:
    """Word bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    t = np.zeros(256, dtype=bool)
    t[48:58] = t[97:123] = t[65:91] = t[128:] = True
    return t


def nonspace_table() -> np.ndarray:
    """Word bytes of ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[9:14] = False
    t[32] = False
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=U)
    have, step = 1, base & (2**64 - 1)
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * U(step)
        have += take
        step = step * step & (2**64 - 1)
    return out


class Hasher:
    """Hashes byte spans of a buffer by differences of one prefix sum."""

    def __init__(self) -> None:
        self.value = mix(np.arange(1, 257, dtype=U) * U(_BASE))[lower_table()]
        self.up = self.down = powers(1, 1)

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        if len(self.up) < n + 1:
            self.up = powers(_BASE, n + 1)
            self.down = powers(pow(_BASE, -1, 2**64), n + 1)
        sums = np.zeros(n + 1, dtype=U)
        np.cumsum(self.value[data] * self.up[:n], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(U))


def cut(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends and, for each text, the index of its first word (one more at the end).

    ``offs`` has the texts' byte offsets in ``data``, beginning with 0.
    """
    is_word = table[data]
    before = np.empty_like(is_word)
    after = np.empty_like(is_word)
    if len(data):
        before[0] = after[-1] = False
        before[1:] = is_word[:-1]
        after[:-1] = is_word[1:]
        edge = offs[(offs > 0) & (offs < len(data))]
        before[edge] = False
        after[edge - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows of texts, and each window's text.

    A text of one to k-1 words gives one window, its whole sequence.
    """
    n, count = len(words), np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    coef = mix(np.arange(1, k + 1, dtype=U) * U(0xD6E8FEB86659FD93)) | U(1)
    left = np.repeat(first[1:], count) - np.arange(n)  # words of the text from here on
    size = np.minimum(np.repeat(count, count), k)
    acc = size.astype(U) * U(0xA24BAED4963EE407)
    for j in range(k):
        if n > j:
            part = words[j:] * coef[j]
            part[size[: n - j] <= j] = 0
            acc[: n - j] += part
    keep = (left >= k) | ((np.repeat(count, count) < k) & (left == np.repeat(count, count)))
    return mix(acc[keep]), text[keep]


def text_buffers(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (beginning with 0) of an Arrow string or binary array; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    raw = array.buffers()
    offs = np.frombuffer(raw[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    data = np.frombuffer(raw[2], dtype=np.uint8)[offs[0] : offs[-1]] if raw[2] is not None and len(array) else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def pieces(data: np.ndarray, offs: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``most`` bytes: first and last text, bytes, offsets.

    A text longer than ``most`` is a run of its own, still whole.
    """
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j
