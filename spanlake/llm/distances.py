"""Edit distances of many pairs of texts at once, each within a limit of its own."""

from __future__ import annotations

import numpy as np

#: Code points of the longest text that goes with others, pairs and cells of a step that go together, steps between looks for pairs that are done.
LONGEST, TOGETHER, CELLS, LOOK = 4096, 1024, 1 << 15, 16
_FAR = np.int16(1 << 13)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
    """The code points of all texts from 2 on and each text's bounds; many different ones are numbered, and too many for a short are none."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(flat) and flat.max() > 32_000:
        kinds, flat = np.unique(flat, return_inverse=True)
        if len(kinds) > 32_000:
            return None
    return flat.astype(np.int16) + np.int16(2), np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]


def _rows(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, place: np.ndarray, pad: int) -> np.ndarray:
    """A column for each text with its codes at the given places, and `pad` beyond its bounds."""
    inside = (place[:, None] >= 0) & (place[:, None] < size)
    out = flat[np.where(inside, begin + place[:, None], 0)] if len(flat) else np.zeros(inside.shape, np.int16)
    out[~inside] = pad
    return out


def _batch(flat: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray, n: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether texts of m <= n codes from a and b on are within `most` edits, which is n - m at least.

    Cells of the edit matrix are gone through by antidiagonals, and only on diagonals that a path of so few edits can
    reach. On a pair's last diagonal the distance never falls: a pair is dropped once it is over `most` there.
    """
    out = np.zeros(len(m), bool)
    order = np.argsort(m + n, kind="stable")
    a, m, b, n, most = (x[order] for x in (a, m, b, n, most))
    slack = (most - (n - m)) // 2
    low, high = int(-slack.max()), int((n - m + slack).max())
    low -= low & 1
    half = (high - low + 2) // 2
    steps = int((m + n).max())
    # at step s and row t of the even ones: place (s - low) / 2 - 1 - t of a, which lies backwards, and (s + low) / 2 - 1 + t of b
    last = (steps - low) // 2
    back = _rows(flat, a, m, np.arange(last, -half - 2, -1), 0)
    first = low // 2 - 2
    fore = _rows(flat, b, n, np.arange(first, (steps + low) // 2 + half + 2), 1)
    even, odd = (np.full((half + 1, len(m)), _FAR, np.int16) for _ in range(2))  # even: a row too many at the end, odd: one at the begin
    even[-low // 2] = 0
    ends, limit, live = m + n, most.astype(np.int16), np.arange(len(m))
    done = int(np.searchsorted(ends, 0, side="right"))
    out[order[:done]] = True  # both empty
    differ, near = (np.empty((half, len(m)), np.int16) for _ in range(2))
    for s in range(1, steps + 1):
        if s & 1:
            x, y = last - ((s - low - 1) // 2 - 1), (s + low + 1) // 2 - 1 - first
            mine = odd[1:]
            np.minimum(even[:-1], even[1:], out=near)
        else:
            x, y = last - ((s - low) // 2 - 1), (s + low) // 2 - 1 - first
            mine = even[:-1]
            np.minimum(odd[:-1], odd[1:], out=near)
        np.bitwise_xor(back[x : x + half], fore[y : y + half], out=differ)
        np.minimum(differ, 1, out=differ)
        np.add(mine, differ, out=mine)
        np.add(near, 1, out=near)
        np.minimum(mine, near, out=mine)
        upto = int(np.searchsorted(ends, s, side="right"))
        if upto > done:
            at = np.arange(done, upto)
            row = ((n - m)[at] - low) // 2
            out[order[live[at]]] = mine[row, at] <= limit[at]
            done = upto
        if s % LOOK == 0 or done == len(live):
            at, row = np.arange(len(live)), (n - m - low) // 2
            on_last = np.where((n - m) & 1, odd[1 + row, at], even[row, at])
            keep = np.flatnonzero(((on_last <= limit) | (s < n - m)) & (at >= done))
            if not len(keep):
                break
            if len(keep) < 0.8 * len(live):
                back, fore, even, odd = (np.ascontiguousarray(z[:, keep]) for z in (back, fore, even, odd))
                m, n, ends, limit, live = (z[keep] for z in (m, n, ends, limit, live))
                done = 0
                differ, near = (np.empty((half, len(m)), np.int16) for _ in range(2))
    return out


def within(texts: list[str], i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray | None:
    """Whether the edit distance of the texts i and j of each pair is `most` or less; None where some text is too long or there are too many code points."""
    if not len(i):
        return np.zeros(0, bool)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    if size.max() > LONGEST or (found := _codes(texts)) is None:
        return None
    flat, bounds = found
    i, j = np.where(size[i] <= size[j], i, j), np.where(size[i] <= size[j], j, i)
    out = np.zeros(len(i), bool)
    some = np.flatnonzero(size[j] - size[i] <= most)
    some = some[np.lexsort((size[j[some]], most[some] - (size[j] - size[i])[some] // 2))]
    at = 0
    while at < len(some):
        width = 1 + int(most[some[min(at + TOGETHER, len(some)) - 1]])
        part = some[at : at + max(32, min(TOGETHER, CELLS // width))]
        p, q = i[part], j[part]
        out[part] = _batch(flat, bounds[p], size[p], bounds[q], size[q], np.asarray(most)[part])
        at += len(part)
    return out
