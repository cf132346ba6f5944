"""Words of many texts at once, in numpy: places, 64-bit hashes and rolling hashes, without a Python object per word.

A span's hash runs over its blocks of eight bytes, each mixed before the next is added, so that no pattern of bytes cancels
out (a polynomial modulo 2 ** 64 gives a Thue-Morse word and its complement one value, whatever its base). Spans of more
than LONG_BYTES, of which a text cannot have many, go through BLAKE2b.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Masks of the first 0 to 8 bytes of a block.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG_BYTES = 512

#: Texts of one batch are worked on in pieces of about this many bytes; a longer text is a piece of its own.
CHUNK_BYTES = 1 << 20

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Bytes of words that white space separates (0x20, 0x09 to 0x0D).
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of letters and digits: 0-9, a-z and all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class Texts:
    """Texts in one byte array; text i is at bytes offsets[i] to offsets[i + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, member: np.ndarray, fold: bool = False) -> "Words":
        return Words(self, member, fold)


def give_back() -> None:
    """Returns freed memory to the system: a worker lives on beside others, and what it keeps for later counts against its executor."""
    gc.collect(0)
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only in the GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def chunks(column: pa.Array | pa.ChunkedArray, most_bytes: int = CHUNK_BYTES, most_rows: int = 256) -> Iterator[Texts]:
    """Pieces of a string column in order; a null is an empty text. `first` is the row at which a piece begins."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    done = 0
    for part in parts:
        if part.null_count:
            part = part.fill_null("")
        part = part.cast(pa.large_string())
        if not len(part):
            continue
        _, off, dat = part.buffers()
        offsets = np.frombuffer(off, np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(dat, np.uint8) if dat is not None else np.zeros(0, np.uint8)
        a = 0
        while a < len(part):
            b = int(np.searchsorted(offsets, offsets[a] + most_bytes, "right")) - 1
            b = min(max(b, a + 1), a + most_rows, len(part))
            yield Texts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], done + a)
            a = b
        done += len(part)
    give_back()


class Words:
    """starts, ends: bytes of each word; counts: words of each text; bounds: the texts' places among the words."""

    def __init__(self, texts: Texts, member: np.ndarray, fold: bool):
        data, offsets = texts.data, texts.offsets
        self.texts, self.bytes = texts, FOLD[data] if fold else data
        inside = member[self.bytes]
        first, last = inside.copy(), inside.copy()
        if len(inside):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            full = offsets[1:] > offsets[:-1]
            begin, end = offsets[:-1][full], offsets[1:][full] - 1
            first[begin], last[end] = inside[begin], inside[end]
        self.inside, self.starts, self.ends = inside, np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self._blocks: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def block(self, at: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """The bytes from each place on, at most `rest` and at most eight of them, as one number."""
        if self._blocks is None:
            padded = np.concatenate([self.bytes, np.zeros(8, np.uint8)])
            self._blocks = np.ndarray(len(self.bytes) + 1, "<u8", padded, 0, (1,))  # read where they lie
        return self._blocks[at] & _FIRST[np.minimum(rest, 8)]

    def spans(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each byte span; equal spans have equal hashes, and another seed gives an independent one."""
        size = (ends - starts).astype(np.int64)
        out = mix((size.astype(np.uint64) + np.uint64(seed << 32)) * _GOLD)
        left = np.flatnonzero(size)
        if len(left) and size.max() > LONG_BYTES:
            raw = memoryview(np.ascontiguousarray(self.bytes))
            for i in np.flatnonzero(size > LONG_BYTES).tolist():
                digest = hashlib.blake2b(raw[int(starts[i]) : int(ends[i])], digest_size=8, key=seed.to_bytes(8, "little")).digest()
                out[i] = int.from_bytes(digest, "little")
            left = left[size[left] <= LONG_BYTES]
        at, rest = starts[left], size[left]
        while len(left):
            out[left] = mix((out[left] ^ self.block(at, rest)) * _GOLD)
            more = rest > 8
            left, at, rest = left[more], at[more] + 8, rest[more] - 8
        return out

    def hashes(self) -> np.ndarray:
        return self.spans(self.starts, self.ends)


def rolling(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of k words that lie in one text, and each window's first word."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n - k + 1, np.uint64)
    factor = 1
    for j in range(k):
        factor = factor * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        total += hashes[j : n - k + 1 + j] * np.uint64(factor)
    room = np.repeat(bounds[1:], np.diff(bounds))[: n - k + 1] - np.arange(n - k + 1) >= k
    at = np.flatnonzero(room)
    return mix(total[at]), at


def totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring bounds, also where two bounds are equal."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[bounds])
