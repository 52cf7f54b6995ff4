"""Words and word windows of many texts at once, as 64-bit hashes in flat numpy arrays.

A text column arrives as an Arrow array: one byte buffer and one offset per text. A table says which bytes belong
to words (both word rules used here separate at ASCII characters, so UTF-8 bytes decide as well as characters do)
and gives every byte a random number, the same for a letter in either case. Nothing is done per word in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SEGMENT = 1 << 16  # bytes hashed at a time; bounds the working memory, not the text


def _random_numbers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(is_word: np.ndarray, fold: bool = True) -> np.ndarray:
    """One number per byte: 0 outside words, otherwise different for every byte but, with ``fold``, A-Z and a-z."""
    table = _random_numbers(256, 77)
    if fold:
        table[65:91] = table[97:123]
    return np.where(is_word, table, np.uint64(0))


_BYTES = np.arange(256)
#: Words are runs of anything but ASCII white space.
SPACED = byte_table(~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))))
#: Words are runs of digits, ASCII letters and everything beyond ASCII.
ALPHANUMERIC = byte_table(
    ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | (_BYTES >= 0x80)
)
_BASE = np.uint64(0xD1342543DE82EF95)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and the offsets of the texts in them; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(texts):
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _segment(raw: np.ndarray, cuts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of one piece; ``cuts`` are places no word may cross."""
    inside = (table != 0)[raw]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    before[-1], before[:-1] = False, inside[1:]
    before[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~before) + 1
    return starts, ends, run_hashes(table[raw], starts)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def run_hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of the numbers from each start to the next: a polynomial of their place within the run, then mixed."""
    if len(_powers[0]) < len(values):
        for i, x in enumerate((_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            _powers[i] = np.cumprod(np.append(np.uint64(1), np.full(len(values) + (1 << 17), x, np.uint64)), dtype=np.uint64)
    sums = np.add.reduceat(values * _powers[0][: len(values)], starts)
    return mix(sums * _powers[1][starts])


def _cut(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where no word is cut: beside a separator or between two texts."""
    while at < len(raw):
        stop = min(at + 65536, len(raw))
        free = np.flatnonzero(~inside[raw[at:stop]])
        found = at + int(free[0]) if len(free) else stop
        text = int(offsets[np.searchsorted(offsets, at)])
        if text <= found or len(free):
            return min(text, found)
        at = stop
    return len(raw)


def word_spans(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word starts, word ends and word hashes of all texts, and the offset of each text's first word."""
    raw, offsets = flat_bytes(texts)
    inside = table != 0
    parts, at = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))], 0
    while at < len(raw):
        to = _cut(raw, offsets, inside, at + _SEGMENT)
        cuts = np.unique(offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to)]) - at
        starts, ends, hashes = _segment(raw[at:to], cuts, table)
        parts.append((starts + at, ends + at, hashes))
        at = to
    starts, ends, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    return raw, starts, ends, hashes, np.searchsorted(starts, offsets)


_FACTORS = _random_numbers(64, 4242) | np.uint64(1)


def windows(hashes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within one text, and each text's offset among them; ``size`` <= 64.

    A text of fewer words, but not none, has one window: all its words.
    """
    counts, n = np.diff(offsets), len(hashes)
    sums = np.zeros(n, np.uint64)
    for k in range(min(size, n)):
        sums[: n - k] += hashes[k:] * _FACTORS[k]
    place = np.arange(n) - np.repeat(offsets[:-1], counts)
    whole = place + size <= np.repeat(counts, counts)
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = hashes[offsets[i] : offsets[i + 1]]
        sums[offsets[i]] = np.sum(own * _FACTORS[: len(own)], dtype=np.uint64)
        whole[offsets[i]] = True
    found = np.where(counts >= size, counts - size + 1, counts > 0)
    return mix(sums[whole]), np.append(0, np.cumsum(found))
