"""Whole texts as byte arrays: tokens, hashes and per-document reductions without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts worked on at once; a longer text is worked on alone

SPACE, LETTER, PUNCT = 0, 1, 2
_BYTES = np.arange(256)
_WORDLIKE = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
#: Kind of each byte; bytes above 127 belong to letters of other scripts and count as word bytes.
KINDS = np.where(_WORDLIKE, LETTER, np.where(_BYTES <= 32, SPACE, PUNCT)).astype(np.uint8)
#: A-Z in lower case.
FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
RADIX = np.uint64(0x9E3779B97F4A7C15)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows; null counts as empty. Offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        own = offsets[row:end + 1]
        yield row, end, raw[own[0]:own[-1]], own - own[0]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a fixed bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), RADIX, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def tokens(data: np.ndarray, offsets: np.ndarray, keep: tuple[int, ...] = (LETTER,), fold: bool = True):
    """Hashes, starts and kinds of the runs of equal kind, and for each document the index of its first one.

    Only runs of the kinds in ``keep`` come out. ``bounds`` has one entry more than there are documents.
    """
    docs = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none.astype(np.uint8), np.zeros(docs + 1, np.int64)
    kinds = KINDS[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(edge)
    lengths = np.diff(np.append(starts, len(data)))
    kind = kinds[starts]
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    values = ((FOLD[data] if fold else data).astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64))
    kept = np.isin(kind, keep)
    starts, hashes, kind = starts[kept], hashes[kept], kind[kept]
    return hashes, starts, kind, np.searchsorted(starts, offsets)


def runs(hashes: np.ndarray, bounds: np.ndarray, size: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` tokens in a row within a document, and the bounds of the documents among them.

    With ``whole`` a document with fewer tokens, but some, gives one run of all of them.
    """
    counts = np.diff(bounds)
    made = np.maximum(counts - size + 1, 0)
    out_bounds = np.concatenate([[0], np.cumsum(np.maximum(made, (counts > 0) if whole else 0))])
    if len(hashes) >= size:
        rolled = np.zeros(len(hashes) - size + 1, np.uint64)
        for j in range(size):
            rolled = rolled * RADIX + hashes[j:len(hashes) - size + 1 + j]
        rolled = mix(rolled)
    else:
        rolled = np.zeros(0, np.uint64)
    at = np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], np.diff(out_bounds)) + np.repeat(bounds[:-1], np.diff(out_bounds))
    short = np.flatnonzero((counts > 0) & (counts < size)) if whole else np.zeros(0, np.int64)
    out = np.zeros(out_bounds[-1], np.uint64)
    full = np.ones(len(out), bool)
    full[out_bounds[short]] = False
    out[full] = rolled[at[full]]
    for doc in short:
        value = np.zeros(1, np.uint64)
        for h in hashes[bounds[doc]:bounds[doc + 1]]:
            value = value * RADIX + h
        out[out_bounds[doc]] = mix(value + np.uint64(counts[doc]))[0]
    return out, out_bounds


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each document; 0 for one without values."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]
