"""Text columns as flat numpy arrays.

The kernels of this subpackage look at a slice of documents at a time: the UTF-8
bytes of all of them stand in one buffer, words are start and end positions in
it, and a word is known by a 64-bit polynomial hash of its bytes.  White space
is the six ASCII characters tab, line feed, vertical tab, form feed, carriage
return and space, so every boundary can be found on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the polynomial hashes; any odd numbers would do.
BYTE_BASE = U64(0x9E3779B97F4A7C15)
WORD_BASE = U64(0xD6E8FEB86659FD93)
MIX_1, MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

#: Bytes of text worked on at once; a longer document makes a slice of its own.
SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> U64(30))
    x = x * MIX_1
    x ^= x >> U64(27)
    x *= MIX_2
    x ^= x >> U64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * BYTE_BASE)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.cumprod(out)


_TABLES: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte base and of its inverse, kept up to one slice."""
    if n > len(_TABLES.get("up", ())):
        inverse = U64(pow(int(BYTE_BASE), -1, 1 << 64))
        up, down = _powers(BYTE_BASE, n), _powers(inverse, n)
        if n > SLICE_BYTES + 1:
            return up, down
        _TABLES["up"], _TABLES["down"] = up, down
    return _TABLES["up"][:n], _TABLES["down"][:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of codes[start:end] for each span; equal content gives equal hashes."""
    up, down = powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


class Texts:
    """A slice of documents: ``buf`` holds their bytes, document i is
    ``buf[off[i]:off[i + 1]]``."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off = buf, off

    def __len__(self) -> int:
        return len(self.off) - 1

    def words(self, lower: bool = False) -> Words:
        return Words(self, lower)


class Words:
    """The words of a slice: ``start`` and ``end`` in the buffer, ``doc`` the
    index of their document, ``first`` the index of each document's first word
    (and one past the last), ``hash`` one number per word."""

    def __init__(self, texts: Texts, lower: bool = False):
        buf, off = texts.buf, texts.off
        self.texts = texts
        space = np.ones(len(buf) + 1, bool)
        np.take(IS_SPACE, buf, out=space[:-1])
        edge = np.empty(len(buf) + 1, bool)
        edge[0] = False
        np.not_equal(space[1:], space[:-1], out=edge[1:])
        if len(buf):
            edge[0] = not space[0]
        flips = np.flatnonzero(edge)
        # a document border inside a run of non-spaces also ends a word and starts one
        cut = off[1:-1]
        cut = cut[(cut > 0) & (cut < len(buf))]
        cut = np.unique(cut)
        cut = cut[~space[cut] & ~space[cut - 1]]
        if len(cut):
            flips = np.sort(np.concatenate([flips, cut, cut]))
        self.start, self.end = flips[0::2], flips[1::2]
        self.first = np.searchsorted(self.start, off)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.lower = lower
        self._hash = None

    def __len__(self) -> int:
        return len(self.start)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            codes = BYTE_CODE[LOWER] if self.lower else BYTE_CODE
            self._hash = span_hashes(codes[self.texts.buf], self.start, self.end)
        return self._hash

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Rabin-Karp hashes of all runs of n words inside one document, and the
        index of each run's first word."""
        count = len(self) - n + 1
        if count <= 0:
            return np.empty(0, U64), np.empty(0, np.int64)
        h = np.zeros(count, U64)
        for k in range(n):
            h *= WORD_BASE
            h += self.hash[k : k + count]
        at = np.flatnonzero(self.doc[:count] == self.doc[n - 1 :])
        return mix(h[at]), at


def slices(column: pa.Array | pa.ChunkedArray, limit: int | None = None) -> Iterator[tuple[int, int, Texts]]:
    """Cut a string column into slices of at most ``limit`` (SLICE_BYTES) bytes, one
    document at least: first row, one past the last row, the texts.  A null is an empty text."""
    limit = limit or SLICE_BYTES
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    _, where, data = column.buffers()
    off = np.frombuffer(where, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b, Texts(buf[off[a] : off[b]], off[a : b + 1] - off[a])
        a = b


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all spans, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64), lengths)
    return shift + np.arange(total)


def int64_column(column: pa.Array) -> np.ndarray:
    """A column of whole numbers; a null becomes the least one."""
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


NO_ID = -(1 << 63)


def ids_back(ids: np.ndarray) -> pa.Array:
    """The reverse of :func:`int64_column`."""
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)
