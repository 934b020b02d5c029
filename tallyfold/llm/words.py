"""Words of many texts as arrays: positions and 64-bit hashes, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
#: Bytes hashed at once: eight-byte numbers per byte are held for so many bytes only.
PIECE = 1 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint64)
#: Letters A-Z and a-z, digits, and every byte of a character outside ASCII.
WORD_BYTES = (
    ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90))
    | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
)
#: All but space, tab, line feed, vertical tab, form feed and carriage return.
SPACED_BYTES = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1), modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(BASE, PIECE)
_INVERSE = _powers(pow(BASE, -1, 1 << 64), PIECE)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers over all bits; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _long_word(data: np.ndarray) -> int:
    """The same hash for a word longer than a piece."""
    total, modulus = 0, 1 << 64
    factor = pow(BASE, PIECE, modulus)
    for at in range((len(data) - 1) // PIECE, -1, -1):
        part = LOWER[data[at * PIECE:(at + 1) * PIECE]] + np.uint64(1)
        total = (total * factor + int((part * _POWERS[:len(part)]).sum())) % modulus
    return total


def hashed_words(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word, and the number of words before each text.

    ``data`` holds the texts' UTF-8 bytes, text i from offsets[i] to offsets[i+1]. A-Z count as
    a-z. A word never reaches from one text into the next. Equal words have equal hashes; two
    different words share one by chance of about 2**-64.
    """
    inside = kind[data]
    breaks = np.zeros(len(data) + 1, dtype=bool)
    breaks[offsets] = True
    before = np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | breaks[:-1]))
    after = np.empty_like(inside)
    if len(data):
        after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | breaks[1:])) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        stop = max(int(np.searchsorted(ends, first + PIECE, side="right")), at + 1)
        if ends[at] - first > PIECE:
            hashes[at] = _long_word(data[first:ends[at]])
        else:
            last = int(ends[stop - 1])
            sums = np.zeros(last - first + 1, dtype=np.uint64)
            np.cumsum((LOWER[data[first:last]] + np.uint64(1)) * _POWERS[:last - first], out=sums[1:])
            s = starts[at:stop] - first
            hashes[at:stop] = (sums[ends[at:stop] - first] - sums[s]) * _INVERSE[s]
        at = stop
    return mixed(hashes), starts, ends, np.searchsorted(starts, offsets)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, null as empty; no copy of the texts."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def slices(column: pa.Array, most: int) -> Iterator[slice]:
    """Runs of rows of at most ``most`` bytes of text; a longer text is a run by itself."""
    _, offsets = text_buffers(column)
    at = 0
    while at < len(column):
        stop = max(int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1, at + 1)
        yield slice(at, stop)
        at = stop
