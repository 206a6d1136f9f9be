"""Shared word helpers: the column expressions and their numpy counterparts.

A word is a maximal run of characters other than the six ASCII blanks
(space, tab, newline, vertical tab, form feed, carriage return). All six are
single bytes in UTF-8, so splitting characters and splitting bytes agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHINGLE = 5

# Bytes handled at once inside a task: bounds the numpy temporaries.
SLAB_BYTES = 1 << 20


def words(text: Column | str) -> Column:
    """Array of the words of a text; null text gives an empty array."""
    return F.regexp_extract_all(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


# ---------------------------------------------------------------------------
# numpy side (inside mapInArrow tasks)

_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS.encode())] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CODES = np.random.default_rng(20240111).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    col = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slabs(column: pa.Array, size: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of about
    ``size`` bytes; a longer text forms a run of its own."""
    data, offsets = text_buffer(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _BASE), np.full(size, _BASE_INV)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = hash of data[i:j] times base**i."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * powers(len(data))[0][: len(data)], out=h[1:])
    return h


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte start and end of every word; words do not cross texts."""
    inside = ~_BLANK[data]
    n = len(data)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = offsets[:-1], offsets[1:]
    begins, ends = begins[begins < n], ends[ends > 0] - 1
    first[begins] = inside[begins]
    last[ends] = inside[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every lower-cased word, word offsets of the texts)."""
    starts, ends = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    h = prefix_hash(_LOWER[data])
    down = powers(len(data))[1]
    hashes = mix((h[ends] - h[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text. A text of fewer words than
    ``width`` has its whole sequence as one shingle; without words, none."""
    hashes, at = word_hashes(data, offsets)
    mult = np.uint64(0x9DDFEA08EB382D69)

    def chain(parts) -> np.ndarray:
        acc = np.full(1, len(parts), np.uint64)
        for part in parts:
            acc = mix(acc * mult + part)
        return acc

    n = len(hashes) - width + 1
    full = chain([hashes[k : n + k] for k in range(width)]) if n > 0 else np.zeros(0, np.uint64)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= width:
            yield np.unique(full[a : b - width + 1])
        elif b > a:
            yield np.asarray(chain([hashes[i : i + 1] for i in range(a, b)]))
        else:
            yield np.zeros(0, np.uint64)
