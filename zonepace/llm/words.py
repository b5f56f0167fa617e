"""Words of whole texts as 64-bit hashes, straight from Arrow buffers.

A word is a maximal run of the bytes 0-9, a-z (A-Z are lower-cased first) and
128-255, i.e. of the characters ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after
lower-casing A-Z.  Texts are hashed in blocks of about a megabyte cut between
words, so memory follows the block and the number of words, not the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); returns a new array."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


with np.errstate(over="ignore"):
    # One random 64-bit value per word byte, 0 for every other byte.
    _BYTE = np.zeros(256, np.uint64)
    _code = np.arange(256)
    _is_word = ((_code >= 48) & (_code <= 57)) | ((_code >= 97) & (_code <= 122)) | (_code >= 128)
    _BYTE[_is_word] = mix(np.flatnonzero(_is_word).astype(np.uint64) * U(0x9E3779B97F4A7C15) + U(1)) | U(1)
    _BYTE[65:91] = _BYTE[97:123]
    RADIX = U(0x9E3779B97F4A7C55)
    INVERSE = U(pow(int(RADIX), -1, 1 << 64))
# The same for words between ASCII white space, case kept.
SPACED = mix(np.arange(1, 257, dtype=np.uint64) * U(0xC2B2AE3D27D4EB4F)) | U(1)
SPACED[[9, 10, 11, 12, 13, 32]] = 0


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > 2 * BLOCK:
        return powers(RADIX, n), powers(INVERSE, n)
    if 0 not in _POW:
        _POW[0] = powers(RADIX, 2 * BLOCK), powers(INVERSE, 2 * BLOCK)
    return _POW[0]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offs, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1] if offs is not None and n else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def _block(data: np.ndarray, heads: np.ndarray, places: bool, table: np.ndarray):
    """Word hashes and word starts of one block; ``heads`` are text starts inside it."""
    value = table[data]
    inside = value != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = heads[heads < len(data)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    power, inverse = _tables(len(data))
    with np.errstate(over="ignore"):
        value *= power[:len(data)]
        hashes = mix(np.add.reduceat(value, starts) * inverse[starts])
    if not places:
        return hashes, starts, starts
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = heads[heads > 0] - 1
    last[before] = inside[before]
    return hashes, starts, np.flatnonzero(last) + 1


def _pieces(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Cuts (begin, end) of about BLOCK bytes that split no word."""
    is_word = table != 0
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(at + BLOCK, end)
        if stop < end:
            back = np.flatnonzero(~is_word[data[at:stop]][::-1])
            if len(back):
                stop -= int(back[0])
            else:  # one word fills the block: take it whole
                while stop < end:
                    ahead = np.flatnonzero(~is_word[data[stop:stop + BLOCK]])
                    if len(ahead):
                        stop += int(ahead[0]) + 1
                        break
                    stop = min(stop + BLOCK, end)
        yield at, stop
        at = stop


def hash_words(data: np.ndarray, offsets: np.ndarray, places: bool = False, table: np.ndarray = _BYTE):
    """(hashes, bounds) of all words; text i has hashes[bounds[i]:bounds[i + 1]].  ``table`` says which bytes make words.

    With ``places`` also the byte positions (starts, ends), counted from the buffer's start.
    """
    parts, begins, ends = [], [], []
    for a, b in _pieces(data, offsets, table):
        heads = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, b)] - a
        h, s, e = _block(data[a:b], heads, places, table)
        parts.append(h)
        begins.append(s + a)
        ends.append(e + a)
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    hashes, starts = cat(parts, np.uint64), cat(begins, np.int64)
    bounds = np.searchsorted(starts, offsets)
    return (hashes, bounds, starts, cat(ends, np.int64)) if places else (hashes, bounds)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, bounds): every run of ``width`` words of a text; all words of a shorter one."""
    count = np.diff(bounds)
    with np.errstate(over="ignore"):
        n = max(len(hashes) - width + 1, 0)
        run = np.zeros(n, np.uint64)
        weight = powers(U(0xD6E8FEB86659FD93), width)
        for k in range(width):
            run += hashes[k:k + n] * weight[k]
        run = mix(run)
        short = np.flatnonzero((count > 0) & (count < width))
        own = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        out = np.zeros(own.sum(), np.uint64)
        to = np.concatenate([[0], np.cumsum(own)]).astype(np.int64)
        long = np.repeat(count >= width, own)
        source = np.arange(len(out), dtype=np.int64) - np.repeat(to[:-1] - bounds[:-1], own)
        out[long] = run[source[long]]
        for i in short:
            part = hashes[bounds[i]:bounds[i + 1]]
            out[to[i]] = mix((part * weight[:len(part)]).sum(dtype=np.uint64, keepdims=True) + U(len(part)))[0]
    return out, to


class Known:
    """Numbers of 64-bit hashes; fixed-width entries, looked up by sorted arrays."""

    def __init__(self):
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for a new one."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)

    def add(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """``hashes`` rise and are new."""
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.numbers = np.insert(self.hashes, at, hashes), np.insert(self.numbers, at, numbers)
