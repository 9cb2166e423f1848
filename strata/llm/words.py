"""Vectorised words and word hashes of Arrow text columns.

A word is a maximal run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return; A-Z count as a-z.  Texts are read from the
column's own buffer in blocks of bounded size, so neither a large batch nor one
very long text needs more memory than ``BLOCK`` bytes times a small factor.
Null texts are empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK = 1_000_000
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Odd multiplier of the polynomial word hash (mod 2^64).
_R = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_R))
    values[65:91] = values[97:123]
    return values


BYTES = _byte_values()
#: Byte values for words whose capitals count.
EXACT_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_R))
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the multiplier or of its inverse."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = _R if kind == "up" else pow(_R, -1, 1 << 64)
        factors = np.full(max(n, BLOCK), base, np.uint64)
        factors[0] = 1
        have = np.multiply.accumulate(factors)
        if len(have) <= 4 * BLOCK:
            _powers[kind] = have
    return have


@dataclass
class Texts:
    """Bytes of a text column: text ``i`` is ``data[start[i]:start[i + 1]]``."""

    data: np.ndarray
    start: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.start) - 1


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = offsets[0] if len(offsets) else 0
    last = offsets[-1] if len(offsets) else 0
    return Texts(data[first:last], offsets - first)


@dataclass
class Words:
    """Words of all texts in order; ``row[i]`` and the byte span of word ``i``."""

    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    """``first[r]:first[r + 1]`` are the words of text ``r``."""


def _cuts(texts: Texts) -> Iterator[tuple[int, int]]:
    """Block limits that never lie inside a word."""
    at, size = 0, len(texts.data)
    while at < size:
        to = min(at + BLOCK, size)
        while to < size:
            later = np.flatnonzero(_WS[texts.data[to : to + 65536]])
            edge = texts.start[np.searchsorted(texts.start, to)]
            near = to + int(later[0]) if len(later) else to + 65536
            if edge <= near:
                to = int(edge)
                break
            to = near
            if len(later):
                break
        to = min(to, size)
        yield at, to
        at = to


def words_of(texts: Texts, gap: np.ndarray = _WS, values: np.ndarray = BYTES) -> Words:
    """All words with 64-bit hashes that depend on their letters and length.

    ``gap`` marks the bytes between words (white space among them), ``values``
    gives the bytes that count as equal equal numbers.
    """
    begins, ends, hashes = [], [], []
    for at, to in _cuts(texts):
        data = texts.data[at:to]
        space = gap[data]
        # a text's first byte begins a word even if the byte before is a letter
        edge = np.zeros(len(data) + 1, bool)
        lo, hi = np.searchsorted(texts.start, [at, to + 1])
        edge[texts.start[lo:hi] - at] = True
        edge[0] = edge[-1] = True
        before = np.empty(len(data), bool)
        before[0] = True
        before[1:] = space[:-1]
        begin = np.flatnonzero(~space & (before | edge[:-1]))
        after = np.empty(len(data), bool)
        after[-1] = True
        after[:-1] = space[1:]
        end = np.flatnonzero(~space & (after | edge[1:])) + 1
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * _power("up", len(data))[: len(data)], out=total[1:])
        value = (total[end] - total[begin]) * _power("down", len(data))[begin]
        hashes.append(mix(value + (end - begin).astype(np.uint64)))
        begins.append(begin + at)
        ends.append(end + at)
    begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    value = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    first = np.searchsorted(begin, texts.start)
    row = np.repeat(np.arange(texts.rows), np.diff(first))
    return Words(row, begin, end, value, first)


def row_sums(texts: Texts, member: np.ndarray) -> np.ndarray:
    """Bytes of each text that are members."""
    count = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(member[texts.data], out=count[1:])
    return np.diff(count[texts.start])


def merged(values: np.ndarray, equal: dict[str, str]) -> np.ndarray:
    """A table of byte values in which each key counts as its letter."""
    values = values.copy()
    for key, letter in equal.items():
        values[ord(key)] = values[ord(letter)]
    return values


def hash_words(words: list[str]) -> np.ndarray:
    """Hashes of given words, as ``words_of`` computes them."""
    return words_of(texts_of(pa.array(words, pa.string()))).hash


def as_long(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed longs of a Spark column."""
    return values.view(np.int64)


def parts(column: pa.Array | pa.ChunkedArray, size: int = 2 * BLOCK) -> Iterator[Texts]:
    """Consecutive rows with about ``size`` bytes of text each, rows whole.

    Only one part is copied at a time, and freed memory goes back to the system,
    since a worker process outlives its tasks.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    kind = np.int32 if pa.types.is_string(column.type) else np.int64
    start = np.frombuffer(column.buffers()[1] or b"\0" * 8, kind)[column.offset : column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        to = int(np.searchsorted(start, start[at] + size, "right")) - 1
        to = min(max(to, at + 1), len(column))
        yield texts_of(column.slice(at, to - at))
        at = to
    release()


def bounded_batches(spark: SparkSession, mb: int = 8) -> None:
    """Let Arrow batches hold this much at most, so neither side of a worker buffers more."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{mb}m")


def release() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def runs(texts: Texts, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end (bytes) of maximal runs of member bytes, ``least`` long or more."""
    inside = np.zeros(len(texts.data) + 1, np.int8)
    inside[:-1] = member[texts.data]
    step = np.diff(inside, prepend=np.int8(0))
    # a run also ends where a text ends
    edge = np.unique(texts.start[1:-1])
    split = edge[(inside[edge] == 1) & (inside[edge - 1] == 1)] if len(edge) else edge
    begin = np.sort(np.concatenate([np.flatnonzero(step == 1), split]))
    end = np.sort(np.concatenate([np.flatnonzero(step == -1), split]))
    keep = end - begin >= least
    begin, end = begin[keep], end[keep]
    return np.searchsorted(texts.start, begin, "right") - 1, begin, end


def code_points(texts: Texts, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions in characters, within their own text, of byte positions."""
    count = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=count[1:])
    return count[at] - count[texts.start[row]]


def byte_class(pattern: str) -> np.ndarray:
    """Membership table of the ASCII characters listed."""
    table = np.zeros(256, bool)
    table[np.frombuffer(pattern.encode("ascii"), np.uint8)] = True
    return table
