"""Words of many texts at once, found and hashed on the UTF-8 bytes with numpy.

The word rule is the white-space one: runs of anything but space and U+0009 to U+000D. Work goes
in slices of about a megabyte, so memory stays bounded for any batch and any length of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SLICE_BYTES = 1 << 20
#: Slices of steps of the pipeline, whose workers lie beside what earlier steps left in an executor: a dozen
#: arrays of 64-bit numbers of a slice's length, and the kept powers of the hashes, are alive in each worker.
SMALL_SLICE_BYTES = 256 << 10

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32

#: Odd multipliers of the two polynomial hashes and of the finisher.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * MIX[0]
    h ^= h >> np.uint64(29)
    h *= MIX[1]
    h ^= h >> np.uint64(32)
    return h


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        made = []
        for factor in (base, pow(base, -1, 1 << 64)):
            powers = np.full(size, factor, np.uint64)
            powers[0] = 1
            made.append(np.cumprod(powers, dtype=np.uint64))
        known = made[0], made[1]
        if size <= 8 * SLICE_BYTES:
            _POWERS[base] = known
    return known


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """64-bit hash of every byte span; equal bytes give equal hashes wherever they stand."""
    up, down = _powers(base, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * MIX[1])


@dataclass
class Slice:
    """Words of rows ``first`` to ``last``; a row may go on in the next slice."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: int
    last: int


def _cuts(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int, int, int]]:
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1, row + 1)
        if offsets[stop] - offsets[row] <= 2 * limit:
            yield int(offsets[row]), int(offsets[stop]), row, stop
        else:  # one long text: cut it behind white space
            at, end = int(offsets[row]), int(offsets[stop])
            while at < end:
                cut = min(at + limit, end)
                while cut < end:
                    white = np.flatnonzero(WHITE[data[cut : cut + limit]])
                    if white.size:
                        cut += int(white[0]) + 1
                        break
                    cut = min(cut + limit, end)
                yield at, cut, row, stop
                at = cut
        row = stop


def slices(data: np.ndarray, offsets: np.ndarray, *, lower: bool = True, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices in row order. With ``lower``, A-Z are lower-cased in the slice's bytes."""
    for begin, end, first, last in _cuts(data, offsets, limit):
        part = data[begin:end]
        if lower:
            part = LOWERED[part]
        inside = ~WHITE[part]
        edges = offsets[first + 1 : last] - begin
        is_start = inside.copy()
        is_start[1:] &= ~inside[:-1]
        at_edge = edges[edges < len(part)]
        is_start[at_edge] = inside[at_edge]
        is_end = inside.copy()
        is_end[:-1] &= ~inside[1:]
        before = edges[edges > 0] - 1
        is_end[before] = inside[before]
        starts = np.flatnonzero(is_start)
        yield Slice(
            part, starts, np.flatnonzero(is_end) + 1, np.searchsorted(edges, starts, "right") + first, first, last
        )


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words of a batch, in order, and the row of each."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part in slices(data, offsets, limit=SMALL_SLICE_BYTES):
        hashes.append(span_hashes(part.data, part.starts, part.ends))
        rows.append(part.rows)
    return np.concatenate(hashes), np.concatenate(rows)
