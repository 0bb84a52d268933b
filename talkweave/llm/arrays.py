"""Words and their hashes over whole Arrow batches of text, with numpy.

A text column is one run of bytes with offsets. Words, their 64-bit hashes and hashes of
word windows come from array operations over slices of it, so that no Python code runs
per word. Slices hold whole texts and about SLICE_BYTES bytes, which bounds memory; one longer text is
a slice of its own.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from talkweave.staging import ship_package

SLICE_BYTES = 2 << 20

_U = np.uint64
_MULTIPLIERS = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def byte_class(separators: bytes, lower: bool) -> np.ndarray:
    """Table byte -> byte of a word, 0 for separators; A-Z lower-cased if asked."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A"):ord("Z") + 1] += 32
    table[list(separators)] = 0
    return table


SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALPHANUMERIC = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


@dataclass
class Words:
    """Words of texts ``first`` to ``first + len(bounds) - 2`` of a batch.

    ``data``: classified bytes, 0 between words where NUL is a separator; ``start``, ``end``: of each word
    in ``data``; ``bounds``: index of each text's first word, and the number of words.
    """

    first: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offset of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "")
    if column.offset:
        column = pa.concat_arrays([column, pa.array([], pa.large_string())])
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if len(column) and buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts, each of about ``limit`` bytes or one text."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def words_of(column, table: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """Words of every text of a batch, slice by slice."""
    data, offsets = text_bytes(column)
    is_word = table != 0
    is_word[0] = table[0] != 0 or _nul_is_word(table)
    for lo, hi in slices(offsets, limit):
        a, b = offsets[lo], offsets[hi]
        part, cuts = data[a:b], offsets[lo:hi + 1] - a
        word = is_word[part]
        inner = cuts[(cuts > 0) & (cuts < len(part))]
        before = np.zeros(len(part), bool)
        before[1:] = word[:-1]
        before[inner] = False
        after = np.zeros(len(part), bool)
        after[:-1] = word[1:]
        after[inner - 1] = False
        start = np.flatnonzero(word & ~before)
        end = np.flatnonzero(word & ~after) + 1
        yield Words(lo, table[part], start, end, np.searchsorted(start, cuts))


def _nul_is_word(table: np.ndarray) -> bool:
    """With white space as the only separator, NUL is a byte of words like any other."""
    return table[1] != 0


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse, modulo 2**64."""
    if which not in _powers or len(_powers[which][0]) < n:
        size = max(n, SLICE_BYTES + 1)
        p = _MULTIPLIERS[which]
        inverse = _U(pow(int(p), -1, 1 << 64))
        with np.errstate(over="ignore"):
            up = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, p, _U)]), dtype=_U)
            down = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, inverse, _U)]), dtype=_U)
        if size > 8 * SLICE_BYTES:
            return up, down
        _powers[which] = up, down
    return _powers[which]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def word_hashes(words: Words, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``which`` picks one of two independent families."""
    if not len(words):
        return np.zeros(0, _U)
    up, down = _powers_to(len(words.data) + 1, which)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words.data) + 1, _U)
        np.cumsum((words.data.astype(_U) + _U(1)) * up[:len(words.data)], out=sums[1:], dtype=_U)
        value = (sums[words.end] - sums[words.start]) * down[words.start]
        return mix(value + (words.end - words.start).astype(_U) * _MULTIPLIERS[1 - which])


def window_hashes(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A hash of each run of ``size`` words (of the whole array; callers drop runs across texts)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    p = _MULTIPLIERS[which]
    with np.errstate(over="ignore"):
        out = hashes[:n].copy()
        for k in range(1, size):
            out *= p
            out += hashes[k:k + n]
        return mix(out)


def whole_windows(words: Words, size: int) -> np.ndarray:
    """Start words of the runs of ``size`` words that lie in one text."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    text = words.text_of()
    return np.flatnonzero(text[:n] == text[size - 1:])


def normalised(words: Words) -> tuple[bytes, np.ndarray]:
    """The words joined by one space, and the start of each in that string (and its length + 1)."""
    length = words.end - words.start
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(length + 1, out=at[1:])
    out = np.full(at[-1], 0x20, np.uint8)
    if len(words):
        inside = np.ones(at[-1], bool)
        inside[at[1:] - 1] = False
        source = np.repeat(words.start - at[:-1], length + 1) + np.arange(at[-1])
        out[inside] = words.data[source[inside]]
    return out.tobytes(), at
