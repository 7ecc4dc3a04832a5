"""Words of whole batches of texts as flat numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
_LONG = 1 << 16
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, MASK, 256, dtype=np.uint64, endpoint=True)
_BASE = int(_rng.integers(0, MASK, dtype=np.uint64)) | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, n - done)
        out[done:done + more] = out[:more] * step
        done += more
    return out


_LOW, _HIGH_BASE = _powers(_BASE, _LONG), pow(_BASE, _LONG, 1 << 64)


def byte_table(separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lower-casing table for A-Z, which bytes separate words)."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    breaks = np.zeros(256, bool)
    breaks[np.frombuffer(separators, np.uint8)] = True
    return lower, breaks


# Fixed sets of the contracts: white space; everything ASCII but digits and letters.
BLANK_BYTES = byte_table(bytes([0x20, *range(0x09, 0x0E)]))
PLAIN_BYTES = byte_table(bytes([b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)]))


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets); null is empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def groups_of(offsets: np.ndarray, limit: int):
    """Ranges of texts of at most ``limit`` bytes together, or of one longer text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the words: byte ranges, and the number of the first word of every text."""
    word = ~table[1][data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = word[1:] != word[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    is_word = word[at[:-1]] if len(at) > 1 else np.zeros(0, bool)
    starts, ends = at[:-1][is_word], at[1:][is_word]
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table) -> np.ndarray:
    """64-bit hashes of the lower-cased words."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    at = within + np.repeat(starts, lengths)
    terms = _BYTE[table[0][data[at]]]
    if lengths.max() <= _LONG:
        terms = terms * _LOW[within]
    else:
        terms = terms * _LOW[within % _LONG] * _powers(_HIGH_BASE, int(lengths.max()) // _LONG + 1)[within // _LONG]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
