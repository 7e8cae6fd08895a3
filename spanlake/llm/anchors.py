"""Content-defined anchors: in every window of WINDOW bytes the least of the hashes of its GRAM-byte strings, leftmost on ties.

Equal windows have equal anchors at equal places, so only strings at anchors need to be compared to find every pair of
equal windows: about one anchor to each (WINDOW - GRAM) / 2 bytes of text instead of a suffix at each byte.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

WINDOW, GRAM = 200, 50
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64; grown by doubling and kept."""
    have = _powers.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.r_[have, have * np.uint64(pow(base, len(have), 1 << 64))]
    _powers[base] = have
    return have[:n]


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the bytes [i, i + gram) for each i."""
    n = len(raw)
    if n < gram:
        return np.zeros(0, np.uint64)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
    h = sums[gram:] - sums[:-gram]
    h *= _power(_INVERSE, n - gram + 1)
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i : i + w] for each i, from running minima of blocks of w in both directions."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    size = -(-len(x) // w) * w
    y = np.full(size, np.iinfo(x.dtype).max, x.dtype)
    y[: len(x)] = x
    y = y.reshape(-1, w)
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    fore = np.minimum.accumulate(y, axis=1).ravel()
    return np.minimum(back[:n], fore[w - 1 : w - 1 + n])


class Anchors(NamedTuple):
    """Anchors in the order of texts and places: place in `raw`, its text's number, hash of its gram, and the first and last window start that has it."""

    at: np.ndarray
    text: np.ndarray
    gram: np.ndarray
    first: np.ndarray
    last: np.ndarray


#: Window starts that are looked at together, and the bits of a key that hold the place (the same everywhere, so that ties fall alike).
SEGMENT, _BITS = 1 << 19, np.uint64(32)


def _segment(raw: np.ndarray, start: int, end: int, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...] | None:
    """Anchors of the windows that start in [start, end)."""
    part = raw[start : end + window - 1]
    h = gram_hashes(part, gram)
    keys = (h >> _BITS << _BITS) | np.arange(len(h), dtype=np.uint64)
    at = (sliding_min(keys, window - gram + 1) & np.uint64((1 << 32) - 1)).astype(np.int64)
    text = np.searchsorted(offsets, np.arange(start, start + len(at)), side="right") - 1
    starts = np.flatnonzero(np.arange(start + window, start + window + len(at)) <= offsets[1:][text])
    if not len(starts):
        return None
    at, text = at[starts], text[starts]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
    ends = np.r_[new[1:], len(at)] - 1
    return at[new] + start, text[new], h[at[new]].view(np.int64), starts[new] + start, starts[ends] + start


def find(raw: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM, segment: int = SEGMENT) -> Anchors:
    """Anchors of all windows of each of the texts that lie end to end in `raw`.

    Texts are gone through in segments, so memory doesn't grow with them; where a segment ends, an anchor's windows
    are split in two entries, which changes no window's anchor.
    """
    n = len(raw) - window + 1
    parts = [p for s in range(0, n, segment) if (p := _segment(raw, s, min(s + segment, n), offsets, window, gram)) is not None]
    if not parts:
        return Anchors(*[np.zeros(0, np.int64)] * 5)
    return Anchors(*[np.concatenate(x) for x in zip(*parts)])
