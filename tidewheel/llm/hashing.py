"""Words of many texts as 64-bit hashes, whole Arrow batches at a time.

Texts stay one byte buffer; nothing is done word by word in Python. A word's hash is a polynomial
over its bytes, a run of words a polynomial over their hashes, both taken as differences of
running sums modulo 2**64 and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are taken at once; a longer text is taken alone.
CHUNK_BYTES = 2 << 20
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n - 1)`` modulo 2**64. The powers a chunk may need are kept, more are not."""
    table = _tables.get(base)
    if table is None or len(table) < n:
        table = np.full(n, base, np.uint64)
        table[:1] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if n <= CHUNK_BYTES + 2:
            _tables[base] = table
    return table[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Each bit of ``x`` spread over all bits; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The polynomial over ``values[s:e]`` for each pair, free of where it lies."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(base, n), out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(_inverse(base), n + 1)[starts]


def _blank(data: np.ndarray) -> np.ndarray:
    return (data != 32) & ((data < 9) | (data > 13))


_KEPT = np.zeros(256, np.uint8)
_KEPT[0x30:0x3A] = np.arange(0x30, 0x3A)
_KEPT[0x61:0x7B] = np.arange(0x61, 0x7B)
_KEPT[0x41:0x5B] = np.arange(0x61, 0x7B)
_KEPT[0x80:] = np.arange(0x80, 0x100)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


@dataclass
class Chunk:
    """Some rows of a batch: ``first`` and ``rows`` say which; ``bounds[i]`` to ``bounds[i + 1]`` are the words of the i-th."""

    first: int
    rows: int
    words: np.ndarray
    bounds: np.ndarray
    last: np.ndarray  # for each word, where the words of its text end
    ending: np.ndarray | None = None  # for each word, its last two bytes and whether it goes beyond ASCII, as a number

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The starts of all runs of ``k`` words within one text, and their hashes."""
        starts = np.arange(len(self.words))
        starts = starts[starts + k <= self.last]
        return starts, self.runs(starts, starts + k)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the runs of words from each start to each end."""
        return mix(_ranges(self.words, starts, ends, WORD_BASE) ^ (ends - starts).astype(np.uint64))


def chunks(texts: pa.Array | pa.ChunkedArray, plain: bool = False, lower: bool = False) -> Iterator[Chunk]:
    """The words of every row (none for null), in row order.

    Words are runs of anything but the blanks 0x20 and 0x09 to 0x0D; if ``plain``, runs of ASCII letters in
    lower case, digits and all beyond ASCII; if ``lower``, A-Z count as a-z, and the endings of words are given.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, body = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        data = body[offsets[first] : offsets[stop]]
        at = offsets[first : stop + 1] - offsets[first]
        if plain:
            data = _KEPT[data]
            inside = data != 0
        else:
            data = _LOWER[data] if lower else data
            inside = _blank(data)
        # a word also ends where its text ends
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
        ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
        bounds = np.searchsorted(starts, at)
        words = mix(_ranges(data.astype(np.uint64) + np.uint64(1), starts, ends, BYTE_BASE))
        ending = None
        if lower:
            beyond = np.concatenate(([0], np.cumsum(data >= 0x80)))
            ending = data[ends - 1].astype(np.int64) << 9 | data[np.maximum(ends - 2, starts)].astype(np.int64) << 1 | (beyond[ends] > beyond[starts])
        yield Chunk(first, stop - first, words, bounds, np.repeat(bounds[1:], np.diff(bounds)), ending)
        first = stop
