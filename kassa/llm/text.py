"""Shared helpers: Arrow text columns as byte blocks, and vectorised words.

The operators look at text as UTF-8 bytes.  ``blocks`` cuts the Arrow batches
that Spark hands to a task into blocks of whole documents of about
``BLOCK_BYTES``; ``word_spans`` and ``word_hashes`` work on a whole block with
a few numpy passes, without a Python object per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
HASH_SLICE = 1 << 19
U64 = np.uint64


@dataclass
class Block:
    """Documents ``i`` = ``data[starts[i]:ends[i]]``; ``batch`` holds their rows."""

    batch: pa.RecordBatch
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; nulls count as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES
) -> Iterator[Block]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        raw, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < batch.num_rows:
            j = int(np.searchsorted(off, off[i] + size, side="right")) - 1
            j = min(max(j, i + 1), batch.num_rows)
            base = off[i]
            yield Block(
                batch.slice(i, j - i), raw[base : off[j]], off[i:j] - base, off[i + 1 : j + 1] - base
            )
            i = j
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its tasks, and the
    arrays of one operator should not add to those of the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def byte_class(pattern_bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(pattern_bytes)] = True
    return table


#: [^\x20\x09-\x0D]+ : everything but ASCII white space.
NOT_SPACE = byte_class(set(range(256)) - {0x20, 9, 10, 11, 12, 13})
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, a-z and all beyond ASCII.
ALNUM = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    return LOWER[data]


def word_spans(data, starts, ends, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of every document, and the index of the
    first word of each document (n + 1 entries)."""
    inside = table[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    full = ends > starts
    before[starts[full]] = False
    first = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[ends[full] - 1] = False
    last = np.flatnonzero(inside & ~after) + 1
    return first, last, np.append(np.searchsorted(first, starts), len(first))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    codes = mix(np.arange(1, 257, dtype=U64)) | U64(1)
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    powers = np.full(HASH_SLICE + 1, base, U64)
    powers[0] = 1
    inverses = np.full(HASH_SLICE + 1, inverse, U64)
    inverses[0] = 1
    return codes, np.multiply.accumulate(powers), np.multiply.accumulate(inverses), base


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, from prefix sums of a polynomial; a span has
    the same hash wherever it stands."""
    codes, powers, inverses, base = _tables()
    out = np.empty(len(first), U64)
    i = 0
    while i < len(first):
        j = int(np.searchsorted(last, first[i] + HASH_SLICE, side="right"))
        if j <= i:  # one span longer than a slice: add up its pieces
            total, scale = 0, 1
            for at in range(int(first[i]), int(last[i]), HASH_SLICE):
                piece = codes[data[at : min(at + HASH_SLICE, int(last[i]))]]
                total += scale * int(np.sum(piece * powers[: len(piece)], dtype=U64))
                scale = scale * pow(base, HASH_SLICE, 1 << 64) % (1 << 64)
            out[i] = U64(total % (1 << 64))
            i += 1
            continue
        lo = int(first[i])
        part = codes[data[lo : int(last[j - 1])]]
        part *= powers[: len(part)]
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(part, out=sums[1:])
        a, b = first[i:j] - lo, last[i:j] - lo
        out[i:j] = (sums[b] - sums[a]) * inverses[a]
        i = j
    return mix(out ^ mix((last - first).astype(U64)))


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes, taken element by element."""
    total = np.full(len(parts[0]), len(parts), U64)
    for part in parts:
        total = mix(total * U64(0x9E3779B97F4A7C15) + part)
    return total


def owners(bounds: np.ndarray) -> np.ndarray:
    """Document of each item, from the first item of each document (n + 1)."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
