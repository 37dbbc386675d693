"""Digests of all words of many texts at once, from the bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from telltale.llm.tasks import WORD_BREAKS

# Bytes that are summed at once; a word is never cut.
BLOCK = 1 << 19

# Sums of runs are taken modulo this prime, once for either half of a value.
PRIME = (1 << 31) - 1
_BASES = (0x2545F491, 0x5851F42D)
_known: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(found: np.ndarray) -> np.ndarray:
    found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    found = (found ^ (found >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return found ^ (found >> np.uint64(32))


def _reduced(found: np.ndarray) -> np.ndarray:
    """Values below 2^62 modulo the prime."""
    found = (found & np.uint64(PRIME)) + (found >> np.uint64(31))
    return np.where(found >= PRIME, found - np.uint64(PRIME), found)


def _accumulated(factor: int, n: int) -> np.ndarray:
    found = np.ones(1, np.uint64)
    while len(found) < n:
        step = np.uint64(pow(factor, len(found), PRIME))
        found = np.concatenate([found, _reduced(found * step)])
    return found


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base modulo the prime, and of its inverse."""
    if base not in _known or len(_known[base][0]) < n:
        inverse = pow(base, -1, PRIME)
        _known[base] = (_accumulated(base, max(n, BLOCK)), _accumulated(inverse, max(n, BLOCK)))
    up, down = _known[base]
    return up[:n], down[:n]


def run_digests(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A digest of each run of values: two polynomials modulo a prime, from running sums.

    Modulo a power of two, runs in patterns such as abba baab would meet whatever
    the base is.
    """
    found = (ends - starts).astype(np.uint64)
    halves = (values & np.uint64(0xFFFFFFFF), values >> np.uint64(32))
    for base, half in zip(_BASES, halves):
        up, down = powers(base, len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        # Below 2^31 each, so that 2^32 of them fit.
        np.cumsum(_reduced(_reduced(half) * up[:-1]), out=sums[1:])
        run = _reduced(_reduced(_reduced(sums[ends] - sums[starts])) * down[starts])
        found = (found << np.uint64(31)) ^ run
        found = mixed(found) if base != _BASES[-1] else found
    return mixed(found)


# A number for each byte at each of the first places of a word, and for each byte.
_PLACES = 64
_BYTES = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x632BE59BD9B4E019))
_SMALL = _BYTES.copy()
_SMALL[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]


def _at_place(numbers: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mixed(numbers + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


_TABLES = {
    id(numbers): _at_place(numbers[None, :], np.arange(_PLACES)[:, None]).ravel()
    for numbers in (_BYTES, _SMALL)
}
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(map(ord, WORD_BREAKS))] = True


def cut_digests(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, small: bool = False
) -> np.ndarray:
    """Digests of cuts of some bytes, in the order in which they begin, none over another.

    A sum of numbers that are drawn for each byte and place, so no pattern of bytes
    meets another one by its form.
    """
    numbers, found, low = _SMALL if small else _BYTES, [np.zeros(0, np.uint64)], 0
    table = _TABLES[id(numbers)]
    while low < len(starts):
        at = int(starts[low])
        high = max(int(np.searchsorted(starts, at + BLOCK)), low + 1)
        begin, end = starts[low:high], ends[low:high]
        piece = data[at : int(end[-1])]
        # The place in its word of every byte; what lies between words is not summed.
        back = np.zeros(len(piece), np.int64)
        back[begin - at] = np.diff(np.append(0, begin - at))
        place = np.arange(len(piece)) - np.cumsum(back)
        near = np.minimum(place, _PLACES - 1)
        values = table[(near << 8) + piece]
        far = np.flatnonzero(place >= _PLACES)
        if len(far):
            values[far] = _at_place(numbers[piece[far]], place[far])
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        sizes = (end - begin).astype(np.uint64)
        found.append(mixed(sums[end - at] - sums[begin - at] + sizes * np.uint64(_BASES[0])))
        low = high
    return np.concatenate(found)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, and where each begins; NULL as no bytes."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    column = column.cast(pa.binary()).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data or b"", np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Where the words of the texts of a column are, whose they are and their digests.

    ``small`` takes A-Z and a-z for the same. NULL has no words.
    """

    def __init__(self, column: pa.Array, small: bool = False):
        self.bytes, edges = column_bytes(column)
        inside = ~_IS_BREAK[self.bytes]
        new = np.ones(len(inside) + 1, bool)
        new[1:] = False
        new[edges] = True
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | new[1:-1]
        stops[:-1] &= ~inside[1:] | new[1:-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.owner = np.searchsorted(edges, self.starts, "right") - 1
        self.n_texts = len(edges) - 1
        self.digests = cut_digests(self.bytes, self.starts, self.ends, small)

    def joined(self, first: int, last: int) -> bytes:
        """Some words in a row, joined by one space."""
        return b" ".join(self.bytes[self.starts[first] : self.ends[last - 1]].tobytes().split())
