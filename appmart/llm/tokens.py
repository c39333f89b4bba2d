"""Words and shingles of Arrow string batches as numpy arrays.

A word is a maximal run of bytes other than space and \\t-\\r, with A-Z
lower-cased. Words are 64-bit hashes; two different words share one with
probability 2**-64. All steps are vectorised over a chunk of texts of bounded
size; a text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_U = np.uint64
_GOLD, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
#: White space, control characters and ASCII punctuation: what is left are runs of letters and digits.
PUNCTUATION = (_BYTES <= 47) | ((_BYTES >= 58) & (_BYTES <= 64)) | ((_BYTES >= 91) & (_BYTES <= 96)) | (
    (_BYTES >= 123) & (_BYTES <= 127))
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the SplitMix64 finaliser's shape)."""
    x = x ^ (x >> _U(30))
    x = x * _M1
    x ^= x >> _U(27)
    x *= _M2
    x ^= x >> _U(31)
    return x


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) for runs of rows of about CHUNK_BYTES. Null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n:
        return
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK_BYTES, side="right")) - 1)
        yield first, raw[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray,
               breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and length of every word, and where each row's words begin (one more entry at the end).

    ``breaks`` says of each byte whether it ends a word.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~breaks[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | cut[1:n]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1 - start, np.searchsorted(start, offsets).astype(np.int64)


def hash_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of the A-Z lower-cased bytes of each span, eight bytes a step."""
    n = len(data)
    padded = np.zeros(n + 8, dtype=np.uint8)
    padded[:n] = LOWER[data]
    eight = np.ndarray(n + 1, dtype="<u8", buffer=padded, strides=(1,))
    h = length.astype(np.uint64) * _GOLD
    todo = slice(None)
    at, left = start, length
    while len(at):
        block = eight[at] & _LOW_BYTES[np.minimum(left, 8)]
        h[todo] = mix((h[todo] ^ block) + _GOLD)
        more = np.flatnonzero(left > 8)
        todo = more if isinstance(todo, slice) else todo[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows in order, and where each row's words begin (one more entry at the end)."""
    start, length, first = word_spans(data, offsets, breaks)
    return hash_spans(data, start, length), first


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries of ``h`` (also across rows)."""
    m = max(0, len(h) - k + 1)
    out = h[:m].copy()
    for j in range(1, k):
        out = mix(out * _GOLD + h[j:m + j])
    return out


def shingles_by_row(h: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per row its ``k``-word shingles in order; a row of 1 to k-1 words is one shingle, an empty row none."""
    runs = windows(h, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            yield runs[a:b - k + 1]
        else:
            yield windows(h[a:b], b - a) if b > a else h[:0]
