"""Words of whole texts as 64-bit hashes, computed over Arrow buffers in numpy.

A word is a run of bytes other than space and U+0009-U+000D. Work is done in pieces of about
``PIECE`` bytes that end at white space, so the memory for one very long text stays bounded by
eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
PIECE = 1 << 20

_rng = np.random.default_rng(20240117)
#: A random 64-bit number for each byte, and the odd base of the polynomial.
BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


_UP = powers(int(BASE), PIECE)
_DOWN = powers(pow(int(BASE), -1, 1 << 64), PIECE)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset :]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word."""
    space = IS_SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges that together cover the text, each ending at white space."""
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        if end < len(data):
            gaps = np.flatnonzero(IS_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word longer than a piece
                rest = np.flatnonzero(IS_SPACE[data[end:]])
                end = end + int(rest[0]) + 1 if len(rest) else len(data)
        yield at, end
        at = end


def hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """The hash of each word of a text, in order."""
    out = []
    with np.errstate(over="ignore"):
        for at, end in _pieces(data):
            part = data[at:end]
            start, stop = spans(part)
            n = len(part)
            up, down = (_UP[:n], _DOWN) if n <= PIECE else (powers(int(BASE), n), powers(pow(int(BASE), -1, 1 << 64), n))
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(BYTE[LOWER[part] if lower else part] * up, out=total[1:])
            out.append(mix((total[stop] - total[start]) * down[start], 1) + (stop - start).astype(np.uint64))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def batch_hashes(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Groups of rows of about a piece of text: first row, end row, word hashes, and where each row's words begin."""
    data, at = buffers(column)
    row = 0
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, "right")) - 1)
        end = min(end, len(at) - 1)
        if end - row == 1:
            h = hashes(data[at[row] : at[end]], lower)
            first = np.array([0, len(h)])
        else:
            h, first = _rows(data[at[row] : at[end]], at[row : end + 1] - at[row], lower)
        yield row, end, h, first
        row = end


def _rows(part: np.ndarray, at: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Like :func:`hashes` for neighbouring short rows; a word ends where its row ends."""
    n = len(part)
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    word = np.concatenate(([False], ~IS_SPACE[part], [False]))
    start = np.flatnonzero(word[1:-1] & (~word[:-2] | cut[:-1]))
    stop = np.flatnonzero(word[1:-1] & (~word[2:] | cut[1:])) + 1
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE[LOWER[part] if lower else part] * _UP[:n], out=total[1:])
        h = mix((total[stop] - total[start]) * _DOWN[start], 1) + (stop - start).astype(np.uint64)
    return h, np.searchsorted(start, at)


_codec = pa.Codec("zstd", 1)


def planes(values: np.ndarray) -> bytes:
    """An array of whole numbers, compressed; bytes of one weight lie together, so constant high bytes cost nothing."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T) if len(values) else np.zeros(0, np.uint8)
    return len(values).to_bytes(8, "little") + _codec.compress(pa.py_buffer(raw), asbytes=True)


def unplanes(data: bytes, kind: type) -> np.ndarray:
    """The inverse of :func:`planes`."""
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = np.frombuffer(_codec.decompress(data[8:], n * width), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(kind).ravel()
