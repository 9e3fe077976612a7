"""Word, line and shingle kernels over Arrow text columns, in numpy.

A text is handled as its UTF-8 bytes, so A-Z lower-casing and the ASCII separators of the operators
are table lookups. Words and lines are 64-bit hashes of their bytes: a polynomial over a fixed odd
base with one random value a byte, taken from prefix sums, then mixed. Work goes in pieces of about
``PIECE`` bytes that end between words; memory follows the largest single text, never a partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 17
BLOCK = 1 << 21

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)


@dataclass(frozen=True)
class Alphabet:
    """Byte ranges that part words (first and last byte), and the value every byte has in a hash."""

    ranges: tuple[tuple[int, int], ...]
    value: np.ndarray

    def parts(self, data: np.ndarray) -> np.ndarray:
        """True at the separators."""
        found = np.zeros(len(data), dtype=bool)
        for first, last in self.ranges:
            found |= (data - np.uint8(first)) <= np.uint8(last - first)
        return found


def alphabet(ranges: tuple[tuple[int, int], ...], lower: bool) -> Alphabet:
    value = _RANDOM.copy()
    if lower:
        value[65:91] = value[97:123]
    return Alphabet(ranges, value)


SPACES = ((0x20, 0x20), (0x09, 0x0D))
PLAIN = alphabet(SPACES, lower=False)
LOWERED = alphabet(SPACES, lower=True)
ALNUM = alphabet(((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)), lower=True)
LINES = alphabet(((0x0A, 0x0A),), lower=False)


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing steps that spread a hash over all 64 bits."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, PIECE + 1)
            self.up, self.down = (np.full(size, x, dtype=np.uint64) for x in (_BASE, _BASE_INVERSE))
            for powers in (self.up, self.down):
                powers[0] = 1
                np.cumprod(powers, out=powers)
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Block:
    """Some consecutive texts of a column: their bytes and the offsets between them."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK) -> Iterator[Block]:
    """The texts in runs of about ``size`` bytes, one text at least; null is the empty text."""
    first = 0
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        chunk = pc.fill_null(pc.cast(chunk, pa.large_string()), "")
        if not len(chunk):
            continue
        offsets = np.frombuffer(chunk.buffers()[1], dtype=np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        buffer = chunk.buffers()[2]
        data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, np.uint8)
        at = 0
        while at < len(chunk):
            end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
            end = min(max(end, at + 1), len(chunk))
            yield Block(first + at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
            at = end
        first += len(chunk)


@dataclass
class Words:
    """Words of a block in order: row in the block, first byte, byte after the last, hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def _pieces(block: Block, letters: Alphabet) -> Iterator[tuple[int, int]]:
    """Byte ranges of about PIECE bytes that end at a separator or between texts."""
    at, size = 0, len(block.data)
    while at < size:
        end = min(at + PIECE, size)
        if end < size:
            inside = np.searchsorted(block.offsets, end, side="right") - 1
            if block.offsets[inside] > at:
                end = int(block.offsets[inside])
            else:
                gap = np.flatnonzero(letters.parts(block.data[at:end]))
                stop = int(block.offsets[inside + 1])
                if len(gap):
                    end = at + int(gap[-1]) + 1
                else:
                    after = np.flatnonzero(letters.parts(block.data[end:stop]))
                    end = end + int(after[0]) + 1 if len(after) else stop
        yield at, end
        at = end


def words(block: Block, letters: Alphabet) -> Words:
    starts, ends, hashes = [], [], []
    for at, to in _pieces(block, letters):
        data = block.data[at:to]
        inside = ~letters.parts(data)
        borders = block.offsets[
            np.searchsorted(block.offsets, at, "left") : np.searchsorted(block.offsets, to, "left")
        ] - at
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[borders] = inside[borders]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        borders = borders[borders > 0]
        stops[borders - 1] = inside[borders - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        up, down = _POWERS.get(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(letters.value[data] * up[: len(data)], out=sums[1:])
        hashes.append(mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)))
        starts.append(start + at)
        ends.append(end + at)
    if not starts:
        none = np.empty(0, dtype=np.int64)
        return Words(none, none, none, np.empty(0, dtype=np.uint64))
    start = np.concatenate(starts)
    row = np.searchsorted(block.offsets, start, side="right") - 1
    return Words(row, start, np.concatenate(ends), np.concatenate(hashes))


def row_bounds(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's words begin in the sorted ``row``, with the end of the last."""
    return np.searchsorted(row, np.arange(rows + 1))


_SALT = _RANDOM[:16] * _U(0x2545F4914F6CDD1D) | _U(1)


def windows(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within a row, and the index of each run's first word."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        total = total * _SALT[0] + hashes[i : i + count] * _SALT[1]
    at = np.flatnonzero(row[:count] == row[n - 1 :])
    return mix(total[at]), at


def count_words(column: pa.Array | pa.ChunkedArray, letters: Alphabet = PLAIN) -> np.ndarray:
    """Words of every text."""
    counts = np.zeros(len(column), dtype=np.int64)
    for block in blocks(column):
        inside = ~letters.parts(block.data)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        borders = block.offsets[:-1][block.offsets[:-1] < len(block.data)]
        begins[borders] = inside[borders]
        sums = np.concatenate([[0], np.cumsum(begins)])
        counts[block.first : block.first + block.rows] = np.diff(sums[block.offsets])
    return counts
