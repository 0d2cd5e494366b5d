"""Anchors: places of a text by which equal windows of a fixed length find each other.

Every window of ``length`` units (bytes or words) has one anchor: the gram of ``gram`` units in it whose hash is
smallest, the rightmost of equal ones. That depends on the window alone, so equal windows have equal anchors at
equal distance. Neighbouring windows mostly share their anchor; all windows of one anchor are consecutive, and
the text they cover together is the anchor's span. A text has about 2 / (length - gram) anchors per unit.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U = np.uint64
# Fixed odd multipliers of the two polynomial hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
PLACE_BITS = 24
# Units handled at once; a longer text is cut into overlapping parts.
UNITS = 4_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xCA5A826395121157)
    return x ^ (x >> U(32))


@lru_cache(maxsize=8)
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and its inverse powers, modulo 2^64, for i < n."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        x = np.full(n, b, U)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


class Prefixes:
    """Hashes of any range of a sequence of numbers, from running sums of a polynomial modulo 2^64."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        n = len(values) + 1
        size = 1 << max(n - 1, 1).bit_length()
        up, self.down = powers(base, size)
        self.sums = np.zeros(n, U)
        np.cumsum((values + U(1)) * up[: n - 1], out=self.sums[1:])

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin] + (end - begin).astype(U))


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of every run of ``width`` neighbours."""
    n = len(keys)
    if n < width:
        return np.empty(0, keys.dtype)
    rows = -(-n // width)
    full = np.full(rows * width, np.iinfo(np.uint64).max, U)
    full[:n] = keys
    table = full.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


@dataclass
class Anchors:
    """Parallel arrays: document number, anchor's place, first and last window of the anchor (unit numbers)."""

    doc: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray


def find(grams: np.ndarray, starts: np.ndarray, length: int, gram: int) -> Anchors:
    """Anchors of documents that lie one after another; ``starts`` has one more entry, the end.

    ``grams[i]`` is the hash of the gram that begins at unit i, for all i (what runs over the end is not used).
    """
    n = int(starts[-1])
    width = length - gram + 1
    parts = []
    for a in range(0, max(n - length + 1, 0), UNITS):
        b = min(a + UNITS + length - 1, n)
        count = b - a - gram + 1
        place = np.arange(count, dtype=U)
        keys = (grams[a : a + count] >> U(PLACE_BITS) << U(PLACE_BITS)) | (U((1 << PLACE_BITS) - 1) - place)
        chosen = U((1 << PLACE_BITS) - 1) - (sliding_least(keys, width) & U((1 << PLACE_BITS) - 1))
        parts.append(chosen.astype(np.int64) + a)
    if not parts:
        return Anchors(*[np.empty(0, np.int64)] * 4)
    chosen = np.concatenate(parts)
    window = np.arange(len(chosen))
    doc = np.searchsorted(starts, window, side="right") - 1
    inside = window + length <= starts[doc + 1]
    window, doc, chosen = window[inside], doc[inside], chosen[inside]
    if not len(window):
        return Anchors(*[np.empty(0, np.int64)] * 4)
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])))
    begin = np.nonzero(new)[0]
    end = np.concatenate((begin[1:], [len(window)])) - 1
    return Anchors(doc[begin], chosen[begin], window[begin], window[end])


def gram_hashes(values: Prefixes, n: int, gram: int) -> np.ndarray:
    begin = np.arange(n)
    return values.ranges(begin, np.minimum(begin + gram, n))


def joined_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, and where each begins (with the end as last entry)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of a union of ranges."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], begin[1:] > reach[:-1]))
    at = np.nonzero(new)[0]
    return begin[at], reach[np.concatenate((at[1:], [len(begin)])) - 1]


def batches_of(sizes: list[int], most: int):
    """(from, to) of runs of documents with at most ``most`` units together, or one document."""
    a = 0
    while a < len(sizes):
        b, held = a, 0
        while b < len(sizes) and (b == a or held + sizes[b] <= most):
            held += sizes[b]
            b += 1
        yield a, b
        a = b
