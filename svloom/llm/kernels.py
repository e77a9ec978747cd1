"""Array kernels that run inside tasks: words and word windows of an Arrow text column.

All work on the UTF-8 bytes of a batch at once, in slices of bounded size, so that a
task's memory does not depend on how long the batch is. A word is a maximal run of
bytes other than 0x20 and 0x09-0x0D. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

SLICE_BYTES = 1 << 19

# Workers live on between stages; the system's allocator gives what a batch took back at once.
pa.set_memory_pool(pa.system_memory_pool())

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


@dataclass
class Words:
    """The words of some consecutive rows."""

    data: np.ndarray  # the rows' bytes
    offsets: np.ndarray  # where each row's bytes begin, and the end of the last
    starts: np.ndarray  # where each word's bytes begin and end
    ends: np.ndarray
    first: np.ndarray  # each row's first word, and the number of all words

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same in every batch."""
        n = len(self.data)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * powers(_BASE, n), out=total[1:])
        raw = (total[self.ends] - total[self.starts]) * powers(_INVERSE, n + 1)[self.starts]
        return mix(raw + (self.ends - self.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def windows(hashes: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of `size` words that lies in one row, and where it starts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(row[:n] == row[size - 1 :])
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(_BASE, len(hashes)), out=total[1:])
    return mix((total[at + size] - total[at]) * powers(_INVERSE, len(hashes) + 1)[at]), at


def slices(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of pieces of about `limit` bytes, a row at least."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    n = len(text)
    if n == 0:
        return
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64, count=text.offset + n + 1)[text.offset :]
    body = text.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


#: True for the ASCII bytes that are no letters or digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def split_words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> Words:
    """between: a table of the 256 bytes, true for those that separate words."""
    word = ~between[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = word
    before[offsets] = False
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = word
    after[offsets] = False
    starts = np.flatnonzero(word & ~before[:-1])
    ends = np.flatnonzero(word & ~after[1:]) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def words_in(text: pa.Array, limit: int = SLICE_BYTES, between: np.ndarray = _SPACE) -> Iterator[tuple[int, int, Words]]:
    for at, to, data, offsets in slices(text, limit):
        yield at, to, split_words(data, offsets, between)


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of `values` between consecutive offsets, 0 where there are none."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """One list per row, of so many of the values each."""
    ends = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def join_lists(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    """The slices' results as one array; of no rows if there are none."""
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def arrow_column(kind: pa.DataType) -> Callable:
    """Decorates a function of Arrow arrays to become a function of columns that gives `kind`."""
    return lambda f: F.arrow_udf(f, from_arrow_type(kind))


@arrow_column(pa.binary())
def squeezed(text: pa.Array) -> pa.Array:
    """Each text compressed, for the one shuffle that texts make."""
    press = zstandard.ZstdCompressor(level=1)
    out = [press.compress(data[offsets[i] : offsets[i + 1]].data) for at, to, data, offsets in slices(text) for i in range(to - at)]
    return pa.array(out, pa.binary())


def unsqueezed(body: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, pa.Array]]:
    """(first row, row after the last, texts) of pieces of about `limit` bytes of text."""
    press = zstandard.ZstdDecompressor()
    held: list[bytes] = []
    at = size = 0
    for i, x in enumerate(body):
        held.append(press.decompress(x.as_buffer()))
        size += len(held[-1])
        if size >= limit or i == len(body) - 1:
            yield at, i + 1, pa.array(held, pa.large_binary()).cast(pa.large_string())
            held, at, size = [], i + 1, 0
