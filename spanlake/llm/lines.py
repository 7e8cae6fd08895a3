"""Fuzzy line deduplication: blocks of a min-hash signature, edit similarity, one occurrence per connected group.

Lines are normalised to their ASCII-folded words and known by a 128-bit cryptographic digest; equal ones are one node.
Every different line has BANDS keys, made of min-hashes over its pairs of neighbouring words (lines of up to SHORT code
points: over its GRAM-byte strings; around that length lines have both, so that no similar pair is parted). Lines that
share a key and have SimHashes of no more than RADIUS differing bits are compared by edit similarity, unless they are
connected already: each key's lines with its least one first, then those that are still in different groups with each
other. Verified links alone make the groups; the first occurrence in the order of id and line stays, all others go. Lines
without a word stay. What is compared holds nearly all similar pairs, not all of them: the README has the measured
recall, and why blocks of the SimHash itself don't do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom, distances, simhash
from .anchors import _power
from .common import bound_batches, by_bytes, column, map_batches, materialize, partitions, text_buffers, text_bytes
from .components import connected_components
from .words import FOLD

SIMILAR = 0.8
#: Keys of a line, and min-hashes a key.
BANDS, PLACES = 8, 3
#: Code points of the lines that are compared by byte strings, and of those compared by word pairs: similar lines differ by a fifth at most.
SHORT, LONG = 64, 51
#: Bytes of a string; bytes beyond which a word (of a script without blanks) counts by its strings as well, and their size.
GRAM, LONG_WORD, PIECE = 4, 24, 6
#: Code points of the shortest line that can be similar to a different one: to one of five, by one edit in five.
LEAST = 4
#: Lines of one key that a task compares with as many others, share of lines in which hot keys are looked for, bits of the filters that spare traffic.
TILE, SAMPLE, FILTER_BITS = 1024, 512, 1 << 22
#: Keys that a task packs together, and lines of one key, as numbers, that go to one task.
PACKED, HOT = 1 << 19, 1 << 16
#: Lines from which on one line is compared with them all at once, and code points of the longest line that others are measured from.
MANY, PIVOT_CHARS = 40, 4096
#: Bits of a SimHash, and those in which lines of one key may differ to be compared: all but few of the similar ones do in less, most others in more.
BITS, RADIUS = 128, 24
_CHUNK, _SEEN, _KEYED = 1 << 20, 500_000, 1 << 17
_LINES = bytes(10 if b == 10 else FOLD[b] for b in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
_SIGNS = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (2048, BITS))
_FACTORS = np.random.default_rng(5).integers(0, 1 << 31, BANDS * PLACES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def normal_lines(text: bytes) -> list[tuple[int, bytes]]:
    """(number, words with one blank between) of each line of a text that has a word."""
    return [(i, b" ".join(w)) for i, x in enumerate(text.translate(_LINES).split(b"\n")) if (w := x.split())]


def split_lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """normal_lines() of many texts at once: the place of each line's text, its number there, and the lines."""
    raw = np.frombuffer((b"\n".join(texts) + b"\n").translate(_LINES), np.uint8)
    # of blanks only one after a word stays, and none at the end of a line
    word = raw > 32
    keep = raw != 32
    keep[1:] |= word[:-1]
    raw = raw[keep]
    keep = raw != 32
    keep[:-1] |= raw[1:] != 10
    raw = raw[keep]
    end = np.flatnonzero(raw == 10)
    begin = np.r_[0, end[:-1] + 1]
    counts = np.fromiter((x.count(b"\n") + 1 for x in texts), np.int64, len(texts))
    of = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    some = np.flatnonzero(end > begin)
    data = raw.tobytes()
    return of[some], number[some], [data[a:b] for a, b in zip(begin[some].tolist(), end[some].tolist())]


def digest(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def row_key(i: int | None, text: bytes) -> bytes:
    """Key of a row by id and text; rows that share both are one occurrence."""
    return hashlib.blake2b(text, digest_size=16, salt=b"" if i is None else i.to_bytes(8, "big", signed=True) + b"i").digest()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [begin, end) of each span, from the running sums of bytes times powers; it only orders features."""
    inverse = _power(pow(_BASE, -1, 1 << 64), len(sums))
    return _mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def _least(values: np.ndarray, weight: np.ndarray | None, count: np.ndarray) -> np.ndarray:
    """For each group of `count` neighbouring values and each place the least of the place's hashes, over the weight if there is one."""
    out = np.empty((BANDS * PLACES, len(count)), np.uint32)
    ends = np.cumsum(count)
    lo = 0
    while lo < len(count):  # so many groups at a time that their features stay in the cache
        base = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + (1 << 15), side="right")))
        part, begins = values[base : ends[hi - 1]], np.r_[0, ends[lo : hi - 1] - base]
        for k in range(BANDS * PLACES):
            if weight is None:
                out[k, lo:hi] = np.minimum.reduceat(part * _FACTORS[k], begins)
            else:
                out[k, lo:hi] = np.minimum.reduceat((part * _FACTORS[k]).astype(np.float32) * weight[base : ends[hi - 1]], begins).view(np.uint32)
        lo = hi
    return out


def _keys_of(least: np.ndarray, kind: int) -> np.ndarray:
    """A row of BANDS keys for each column of min-hashes."""
    h = np.repeat(np.arange(kind * BANDS + 1, kind * BANDS + BANDS + 1, dtype=np.uint64)[:, None], least.shape[1], axis=1)
    for place in range(PLACES):
        h = _mix(h * np.uint64(_BASE) + least[place::PLACES])
    return np.ascontiguousarray(h.T).view(np.int64)


def line_keys(lines: list[bytes]) -> list[np.ndarray]:
    """The keys of each normalised line: none under LEAST code points, BANDS of them, or twice as many between LONG and SHORT."""
    of, keys = _keys(lines)
    return [x.ravel() for x in np.split(keys, np.cumsum(np.bincount(of, minlength=len(lines)))[:-1])]


def _keys(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """line_keys() as rows of BANDS keys, and the place of each row's line, in ascending order."""
    raw = np.frombuffer(b"\n" + b"\n".join(lines) + b"\n", np.uint8)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    begin = np.cumsum(size + 1) - size
    end = begin + size
    inner = np.flatnonzero(raw & 0xC0 == 0x80)  # bytes that begin no code point
    points = size - (np.searchsorted(inner, end) - np.searchsorted(inner, begin))
    sums = np.zeros(len(raw) + 1, np.uint64)
    weighed = raw.astype(np.uint64)
    weighed += np.uint64(1)
    weighed *= _power(_BASE, len(raw))
    np.cumsum(weighed, out=sums[1:])
    of_line, found = [np.zeros(0, np.int64)], [np.zeros((0, BANDS), np.int64)]

    def add(some: np.ndarray, least: np.ndarray, kind: int) -> None:
        of_line.append(some), found.append(_keys_of(least, kind))

    def strings(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.arange(int(counts.sum())) + np.repeat(starts - np.r_[0, np.cumsum(counts)[:-1]], counts)

    some = np.flatnonzero((points >= LEAST) & (points <= SHORT))
    if len(some):  # with the breaks before and after, which mark a line's begin and end
        count = size[some] + 3 - GRAM
        at = strings(begin[some] - 1, count)
        add(some, _least((_span_hash(sums, at, at + GRAM) >> np.uint64(32)).astype(np.uint32), None, count), 0)
    is_long = points >= LONG
    if is_long.any():
        gap = np.flatnonzero(raw <= 32)
        start, stop = gap[:-1] + 1, gap[1:]
        word = _span_hash(sums, start, stop)
        of = np.cumsum(raw[gap[:-1]] == 10) - 1
        pair = np.flatnonzero((of[1:] == of[:-1]) & is_long[of[1:]])
        line, h = of[pair], _mix(word[pair] * np.uint64(_BASE) + word[pair + 1])
        w = 1 / np.minimum(stop[pair + 1] - start[pair], 64).astype(np.float32)
        big = np.flatnonzero((stop - start > LONG_WORD) & is_long[of])
        if len(big):
            count = stop[big] - start[big] - PIECE + 1
            at = strings(start[big], count)
            line, h, w = np.r_[line, np.repeat(of[big], count)], np.r_[h, _span_hash(sums, at, at + PIECE)], np.r_[w, np.full(len(at), 1 / PIECE, np.float32)]
            order = np.argsort(line, kind="stable")
            line, h, w = line[order], h[order], w[order]
        count = np.bincount(line, minlength=len(lines))
        some = np.flatnonzero(count)
        add(some, _least((h >> np.uint64(32)).astype(np.uint32), w, count[some]), 1)
    of, keys = np.concatenate(of_line), np.concatenate(found)
    order = np.argsort(of, kind="stable")
    return of[order], keys[order]


def keys_in_parts(lines: list[bytes], most: int = _KEYED) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """_keys() of so many lines at a time that their running sums stay in the cache."""
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    at = 0
    while at < len(lines):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        of, keys = _keys(lines[at:end])
        yield of + at, keys
        at = end


def distance_at_most(a, b, most: int) -> bool:
    """Whether the edit distance of two sequences is `most` or less: common ends cut, then Myers's bit vectors in a band (Hyyro 2003)."""
    n = min(len(a), len(b))
    lo = 0
    while lo < n and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < n - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return False
    if len(b) <= most:
        return True
    # a bit for each diagonal that a path of so few edits can reach, the uppermost first
    slack = (most - len(b) + len(a)) // 2
    high = len(b) - len(a) + slack
    masks: dict = {}
    for i, x in enumerate(a, high):
        masks[x] = masks.get(x, 0) | 1 << i
    full, last = (1 << high + slack + 1) - 1, 1 << slack
    up, down, cost = full >> high << high, 0, 0
    for j, x in enumerate(b):
        match = masks.get(x, 0) >> j & full
        free = ((((match & up) + up) ^ up) | match | down) & full
        if not free & last:  # on the last diagonal the distance never falls
            cost += 1
            if cost > most:
                return False
        plus = down | (free | up) ^ full
        minus = free & up
        free >>= 1
        up = minus | (free | plus) ^ full
        down = free & plus
    return True


def simhashes(lines: list[bytes]) -> np.ndarray:
    """A SimHash of BITS bits of each line, as rows of 64-bit words: signs of sums over its triples of neighbouring code points, in 2,048 buckets, by the roots of their counts."""
    out = np.empty((len(lines), BITS // 64), np.uint64)
    for lo in range(0, len(lines), 256):
        texts = [x.decode("utf-8", "replace") for x in lines[lo : lo + 256]]
        p = np.frombuffer(("\n" + "\n".join(texts) + "\n\n").encode("utf-32-le"), np.uint32)
        h = ((p[:-2] * np.uint32(0x9E3779B1) + p[1:-1]) * np.uint32(0x85EBCA77) + p[2:]) * np.uint32(0xC2B2AE3D)
        h = (h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA77) >> np.uint32(21)
        counts = np.empty((len(texts), 2048), np.float32)
        at = 0
        for i, x in enumerate(texts):  # a triple from each break or code point but the last one
            counts[i] = np.bincount(h[at : at + len(x)], minlength=2048)
            at += len(x) + 1
        out[lo : lo + 256] = np.packbits(np.sqrt(counts, out=counts) @ _SIGNS > 0, axis=1).view(np.uint64)
    return out


def _prints(array: pa.Array) -> np.ndarray:
    return text_buffers(array)[1].view(np.uint64).reshape(-1, BITS // 64)


def _bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which SimHashes differ, row by row."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _near(bits: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Whether lines of `a` and `b` code points whose SimHashes differ in so many bits are compared: short ones, of which an edit moves more, within twice the radius."""
    return bits <= np.where(np.minimum(a, b) <= SHORT, 2 * radius, radius)


def _aligned_within(a: list[str], b: list[str], most: int) -> bool:
    """Whether one alignment of two lists of words, found in a single pass, takes `most` edits or less; if not, another one may."""
    j = cost = left = 0
    for w in a:
        if j < len(b) and b[j] == w:
            k = j
        else:
            k = next((k for k in range(j, min(j + 8, len(b))) if b[k] == w), -1)
        if k < 0:
            left += len(w) + 1
            continue
        cost += max(left, sum(map(len, b[j:k])) + k - j) if left or k > j else 0
        if cost > most:
            return False
        left, j = 0, k + 1
    return cost + max(left, sum(map(len, b[j:])) + len(b) - j) <= most


def _many_distances(x: str, others: list[str], most: np.ndarray | None = None) -> np.ndarray:
    """Edit distances of one text and many others, all of code points under 256: Myers's bit vectors, 64 bits a block, a column for each other.

    With `most`, it ends when all are found to be further apart than that, and gives numbers beyond it.
    """
    m, n = len(x), np.fromiter(map(len, others), np.int64, len(others))
    width, one = int(n.max()), np.uint64(1)
    texts = np.frombuffer("".join(y.ljust(width, "\0") for y in others).encode("latin-1"), np.uint8).reshape(len(others), width)
    match = np.zeros((-(-m // 64), 256), np.uint64)
    for i, c in enumerate(x.encode("latin-1")):
        match[i >> 6, c] |= np.uint64(1 << (i & 63))
    up, down = np.full((len(match), len(others)), ~np.uint64(0)), np.zeros((len(match), len(others)), np.uint64)
    shift, score = np.uint64(m - 1 & 63), np.full(len(others), m, np.int64)
    for j in range(width):
        more, less = np.ones(len(others), np.uint64), np.zeros(len(others), np.uint64)
        for k, same in enumerate(match[:, texts[:, j]]):
            p, q = up[k], down[k]
            vertical, same = same | q, same | less
            across = (((same & p) + p) ^ p) | same
            plus, minus = q | ~(across | p), p & across
            hp, hm = (plus << one) | more, (minus << one) | less
            more, less = plus >> np.uint64(63), minus >> np.uint64(63)
            up[k], down[k] = hm | ~(vertical | hp), hp & vertical
        step = (plus >> shift & one).astype(np.int64) - (minus >> shift & one).astype(np.int64)
        score += np.where(j < n, step, 0)
        if most is not None and j & 15 == 15 and (score - np.maximum(n - 1 - j, 0) > most).all():
            break
    return score


def _many_within(x: str, others: list[str], most: np.ndarray) -> np.ndarray:
    """distance_at_most() of one text and many others, all of code points under 256."""
    return _many_distances(x, others, most) <= most


def _limit(x: str, y: str, least: float) -> int:
    """Edits that two texts may be apart, or -1 if their lengths alone are further apart."""
    longer, shorter = max(len(x), len(y)), min(len(x), len(y))
    most = int((1 - least) * longer + 1e-9)
    return most if longer - shorter <= most else -1


def similar(a: bytes, b: bytes, least: float = SIMILAR) -> bool:
    """Whether the edit similarity of two normalised lines, 1 - distance / longer length in code points, is `least` or more."""
    x, y = a.decode("utf-8", "replace"), b.decode("utf-8", "replace")
    most = _limit(x, y, least)
    return most >= 0 and (_aligned_within(x.split(" "), y.split(" "), most) or distance_at_most(x, y, most))


def all_similar(a: bytes, others: list[bytes], least: float = SIMILAR) -> list[bool]:
    """similar() of one line and each of others; many of them are held against it at once."""
    x, texts = a.decode("utf-8", "replace"), [y.decode("utf-8", "replace") for y in others]
    limits = [_limit(x, y, least) for y in texts]
    some = [i for i, most in enumerate(limits) if most >= 0 and max(texts[i]) < "\u0100"] if max(x) < "\u0100" else []
    if len(some) < MANY:
        return [most >= 0 and similar(a, y, least) for most, y in zip(limits, others)]
    out = [most >= 0 and max(y) >= "\u0100" and similar(a, z, least) for most, y, z in zip(limits, texts, others)]
    for i, ok in zip(some, _many_within(x, [texts[i] for i in some], np.array([limits[i] for i in some])).tolist()):
        out[i] = ok
    return out


#: Code points of the pairs that are held against each other together.
PAIR_CHARS = 1 << 20


def similar_pairs(a: list[bytes], b: list[bytes], least: float = SIMILAR) -> np.ndarray:
    """similar() of each line of `a` and the one at its place in `b`."""
    out = np.zeros(len(a), bool)
    begin = 0
    while begin < len(a):
        number: dict[bytes, int] = {}
        pairs, chars, end = [], 0, begin
        while end < len(a) and chars < PAIR_CHARS:
            if max(len(a[end]), len(b[end])) > distances.LONGEST:
                out[end] = similar(a[end], b[end], least)
            else:
                pairs.append((end, number.setdefault(a[end], len(number)), number.setdefault(b[end], len(number))))
                chars += len(a[end]) + len(b[end])
            end += 1
        if pairs:
            at, i, j = np.array(pairs).T
            texts = [x.decode("utf-8", "replace") for x in number]
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            most = ((1 - least) * np.maximum(size[i], size[j]) + 1e-9).astype(np.int64)
            ok = distances.within(texts, i, j, most)
            out[at] = [similar(a[k], b[k], least) for k in at.tolist()] if ok is None else ok
        begin = end
    return out


def _first_half(key: str):
    """short_ids() as a Column."""
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("long")


def short_ids(keys: list[bytes]) -> np.ndarray:
    """The first half of each digest, as a signed number."""
    return np.frombuffer(b"".join(keys), ">i8")[::2].astype(np.int64)


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, number, node, keys) of each line that has a word. A task gives a line's keys once, as bytes of 64-bit numbers, where it first meets it; else they are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in by_bytes(batches, "text", _CHUNK):
            texts = text_bytes(column(batch, "text"))
            rows = [row_key(i, x) for i, x in zip(column(batch, "doc_id").to_pylist(), texts)]
            of, numbers, lines = split_lines(texts)
            nodes = [digest(x) for x in lines]
            new = [i for i, d in enumerate(nodes) if d not in seen and not seen.add(d)]
            if len(seen) > _SEEN:
                seen.clear()
            if not nodes:
                continue
            found = list(keys_in_parts([lines[i] for i in new]))
            width = np.zeros(len(nodes) + 1, np.int32)
            if found:
                width[np.array(new) + 1] = 8 * BANDS * np.bincount(np.concatenate([x for x, _ in found]), minlength=len(new))
            keys = np.concatenate([k for _, k in found]) if found else np.zeros(0, np.int64)
            keys = pa.Array.from_buffers(pa.binary(), len(nodes), [None, pa.py_buffer(np.cumsum(width, dtype=np.int32)), pa.py_buffer(keys)])
            at = pa.array(of)
            columns = [pa.array(rows, pa.binary()).take(at), column(batch, "doc_id").take(at), pa.array(numbers.astype(np.int32)), pa.array(nodes, pa.binary()), keys]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "number", "node", "keys"])

    return _docs(docs, id_col, text_col).mapInArrow(run, "row binary, doc_id long, number int, node binary, keys binary")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(key, id) of all keys of rows (node, keys), the id the first half of the node."""
    ends, raw = text_buffers(column(batch, "keys"))
    ids = text_buffers(column(batch, "node"))[1].view(">i8")[::2].astype(np.int64)
    return raw.view(np.int64), np.repeat(ids, np.diff(ends) // 8)


def _numbers(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """64-bit numbers as a binary value for each of the stretches that end there."""
    offsets = np.r_[0, ends] * 8
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _packed(buckets: int, apart: np.ndarray | None):
    """Of rows (node, keys): (bucket, keys, ids) of many keys of one bucket, a range of keys, without those that the filter `apart` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            key, ids = (np.concatenate(x) for x in zip(*held))
            held.clear()
            bucket = ((key.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            ends = np.r_[np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[ends - 1].astype(np.int32)), _numbers(key[order], ends), _numbers(ids[order], ends)], names=["bucket", "keys", "ids"])

        size = 0
        for batch in batches:
            key, ids = _flat(batch)
            if apart is not None:
                cold = ~bloom.contains(apart, key)
                key, ids = key[cold], ids[cold]
            if len(key):
                held.append((key, ids))
                size += len(key)
            if size >= PACKED:
                yield packed()
                size = 0
        if held:
            yield packed()

    return run


def _firsts(key: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """(key, first, id) for each id of a key but its least one, which is the first; each once."""
    order = np.argsort(key)
    twice = np.zeros(len(key) + 1, bool)
    twice[1:-1] = key[order[1:]] == key[order[:-1]]
    order = order[twice[1:] | twice[:-1]]  # few keys have several ids
    key, ids = key[order], ids[order]
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    begin = np.ones(len(key), bool)
    begin[1:] = key[1:] != key[:-1]
    first = ids[np.maximum.accumulate(np.where(begin, np.arange(len(key)), 0))] if len(key) else ids
    take = ids != first
    take[1:] &= begin[1:] | (ids[1:] != ids[:-1])
    return pa.RecordBatch.from_arrays([pa.array(x[take]) for x in (key, first, ids)], names=["key", "first", "id"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_firsts() of each bucket of rows (bucket, keys, ids) sorted by bucket."""
    at, keys, ids = None, [], []
    for batch in batches:
        for bucket, k, i in zip(*(column(batch, c).to_pylist() for c in ("bucket", "keys", "ids"))):
            if bucket != at and keys:
                yield _firsts(*(np.frombuffer(b"".join(x), np.int64) for x in (keys, ids)))
                keys, ids = [], []
            at = bucket
            keys.append(k), ids.append(i)
    if keys:
        yield _firsts(*(np.frombuffer(b"".join(x), np.int64) for x in (keys, ids)))


def shared_keys(rows: DataFrame, most: int = HOT, bits: int = FILTER_BITS, sample: int = SAMPLE) -> DataFrame:
    """(key, first, id) of the keys of rows (node, keys): each id of a key once that isn't the key's first, its least id.

    Keys go in packs, each of one of many ranges, which a task sorts one after the other. A key that a sample of the lines
    shows to have more than `most` isn't sent to one task, but gets its least id by an aggregate with map-side combine and a
    join whose partitions Spark can split; a filter of these keys tells which way a key goes, and either way is right.
    """
    spark = rows.sparkSession
    some = rows.where(F.pmod(F.xxhash64("node"), F.lit(sample)) == 0)
    key = some.select(F.explode(F.expr("transform(sequence(1, length(keys), 8), i -> hex(substring(keys, i, 8)))")).alias("key"))
    hot = key.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * sample > most)
    hot = materialize(hot.select(F.conv(F.concat(*[F.substring("key", 15 - i, 2) for i in range(0, 16, 2)]), 16, -10).cast("long").alias("key")), "hot", small=True)
    apart = None if hot.isEmpty() else bloom.build(hot, "key", bits)
    bound_batches(spark)
    packs = rows.mapInArrow(_packed(8 * partitions(spark), apart), "bucket int, keys binary, ids binary")
    found = packs.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(_unpacked, "key long, first long, id long")
    if apart is not None:

        def picked(batch: pa.RecordBatch) -> pa.RecordBatch:
            key, ids = _flat(batch)
            inside = bloom.contains(apart, key)
            return pa.RecordBatch.from_arrays([pa.array(x[inside]) for x in (key, ids)], names=["key", "id"])

        many = materialize(map_batches(rows, picked, "key long, id long").distinct(), "many")
        found = found.unionByName(many.join(many.groupBy("key").agg(F.min("id").alias("first")), "key").where("id != first").select("key", "first", "id"))
    return materialize(found, "shared")


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _open_pairs(texts: list[str], i: np.ndarray, j: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (i, j) are similar for sure, and which are still open; the others are not similar.

    Edit distance is a metric: what two lines are apart from a third one, the pivot, bounds what they are apart from each
    other from below and above. A pivot costs a distance for each line, and settles pairs, of which there may be
    as many as the lines' square; pivots are taken while there are far more open pairs than lines and each settles more than it costs.
    """
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    limit = np.floor((1 - least) * np.maximum(size[i], size[j]) + 1e-9).astype(np.int64)
    is_open, sure = np.abs(size[i] - size[j]) <= limit, np.zeros(len(i), bool)
    usable = np.array([0 < len(x) <= PIVOT_CHARS and max(x) < "\u0100" for x in texts])
    used = ~usable
    while True:
        at = np.flatnonzero(is_open & usable[i] & usable[j])
        rows = np.unique(np.r_[i[at], j[at]])
        if len(at) < 4 * len(rows) or len(at) < MANY:
            return sure, is_open
        met = np.bincount(np.r_[i[at], j[at]], minlength=len(texts))
        met[used] = 0
        pivot = int(met.argmax())
        if not met[pivot]:
            return sure, is_open
        used[pivot] = True
        far = np.zeros(len(texts), np.int64)
        far[rows] = _many_distances(texts[pivot], [texts[r] for r in rows.tolist()])
        near, apart = far[i[at]] + far[j[at]] <= limit[at], np.abs(far[i[at]] - far[j[at]]) > limit[at]
        sure[at[near]] = True
        is_open[at[near | apart]] = False
        if near.sum() + apart.sum() < len(rows):
            return sure, is_open


@dataclass
class _Part:
    """Lines of one key: the names of their labels, the lines, each one's label by number, what is connected, open pairs, and links found."""

    names: list[int]
    lines: list[bytes]
    at: np.ndarray
    forest: simhash.Forest
    i: np.ndarray
    j: np.ndarray
    links: list[tuple[int, int]] = field(default_factory=list)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        for a, b in zip(self.at[i].tolist(), self.at[j].tolist()):
            if self.forest.join(a, b):
                self.links.append((self.names[a], self.names[b]))

    def rest(self) -> None:
        """Only pairs of labels that aren't connected stay open."""
        roots = np.array([self.forest.root(x) for x in range(len(self.names))])[self.at]
        keep = roots[self.i] != roots[self.j]
        self.i, self.j = self.i[keep], self.j[keep]

    def taken(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to `most` of the open pairs of each two groups, which are no longer open."""
        roots = np.array([self.forest.root(x) for x in range(len(self.names))])[self.at]
        low, high = np.minimum(roots[self.i], roots[self.j]), np.maximum(roots[self.i], roots[self.j])
        order = np.lexsort((high, low))
        begin = np.r_[True, (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])]
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))
        some = np.zeros(len(order), bool)
        some[order[rank < most]] = True
        out = self.i[some], self.j[some]
        self.i, self.j = self.i[~some], self.j[~some]
        return out


#: Open pairs and lines of the parts that are settled together.
OPEN_PAIRS = 20_000


def _settled(parts: list[_Part], least: float) -> list[tuple[int, int]]:
    """The links of parts: of each two groups one pair is compared, then two, four and so on, until they are connected or no pair is left."""
    most = 1
    live = list(parts)
    while live:
        for p in live:
            p.rest()
        live = [p for p in live if len(p.i)]
        took = [(p, *p.taken(most)) for p in live]
        ok = similar_pairs([p.lines[a] for p, i, _ in took for a in i.tolist()], [p.lines[b] for p, _, j in took for b in j.tolist()], least)
        at = 0
        for p, i, j in took:
            yes = ok[at : at + len(i)]
            p.join(i[yes], j[yes])
            at += len(i)
        most *= 2
    return [x for p in parts for x in p.links]


def _across(least: float, radius: int):
    """Of rows (part, side, label, id, fp, line) sorted by part: pairs of labels of a part that a similar pair of lines links, by lines not yet connected.

    side 0: all lines of the part meet; 1 and 2: those of one side meet those of the other.
    """

    def opened(side: list[int], label: list[int], ids: list[int], fps: list[bytes], lines: list[bytes]) -> _Part | None:
        """A part with the pairs of lines that are still to be compared."""
        number = {x: i for i, x in enumerate(dict.fromkeys(label))}
        if len(number) < 2:
            return None
        at, sides = np.array([number[x] for x in label]), np.array(side)
        prints = np.frombuffer(b"".join(fps), np.uint64).reshape(-1, BITS // 64)
        texts = [x.decode("utf-8", "replace") for x in lines]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        found = []
        for lo in range(0, len(ids), 256):  # a stripe of lines against all up to its end
            hi = min(lo + 256, len(ids))
            ok = _near(_bits_apart(prints[lo:hi, None], prints[None, :hi]), size[lo:hi, None], size[None, :hi], radius)
            ok &= (at[lo:hi, None] != at[None, :hi]) & ((sides[lo:hi, None] == 0) | (sides[lo:hi, None] != sides[None, :hi]))
            i, j = np.nonzero(np.tril(ok, lo - 1))
            found.append((i + lo, j))
        i, j = (np.concatenate(x) for x in zip(*found))
        if not len(i):
            return None
        sure, is_open = _open_pairs(texts, i, j, least)
        part = _Part(list(number), lines, at, simhash.Forest(len(number)), i[is_open], j[is_open])
        part.join(i[sure], j[sure])
        return part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, parts, size = ([], [], [], [], []), None, [], 0

        def close() -> None:
            nonlocal size
            if held[0] and (part := opened(*held)) is not None:
                parts.append(part)
                size += len(part.i) + len(part.lines)

        for batch in batches:
            for key, *row in zip(*(column(batch, c).to_pylist() for c in ("part", "side", "label", "id", "fp", "line"))):
                if key != at:
                    close()
                    held, at = ([], [], [], [], []), key
                    if size > OPEN_PAIRS:
                        yield _links(_settled(parts, least))
                        parts, size = [], 0
                for x, v in zip(held, row):
                    x.append(v)
        close()
        if parts:
            yield _links(_settled(parts, least))

    return run


def _dealt(rows: DataFrame, tile: int) -> DataFrame:
    """(part, side, label, id, fp, line) of rows (key, label, id, fp, line).

    A large key is dealt over pairs of tiles. Its most frequent label has tiles of its own, which never meet each other:
    where nearly all lines are connected already, a line is sent once and the few others to each tile.
    """
    per = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    large = per.groupBy("key").agg(F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("most")).where(F.col("all") > 2 * tile)
    tiles = lambda n: F.greatest(F.lit(1), F.ceil(n / tile)).cast("int")
    large = materialize(large.select("key", F.col("most.label").alias("main"), tiles(F.col("most.n")).alias("a"), tiles(F.col("all") - F.col("most.n")).alias("b")), "large")
    plain = ["side", "label", "id", "fp", "line"]
    if large.isEmpty():
        return rows.withColumn("side", F.lit(0)).select(F.col("key").alias("part"), *plain)
    cold = rows.join(large, "key", "left_anti").withColumn("side", F.lit(0)).select(F.col("key").alias("part"), *plain)
    own = F.when(F.col("label") == F.col("main"), F.pmod(F.xxhash64("id"), "a")).otherwise(F.col("a") + F.pmod(F.xxhash64("id"), "b")).cast("int")
    others = F.when(F.col("t") < F.col("a"), F.sequence(F.col("a"), F.col("a") + F.col("b") - 1)).otherwise(F.sequence(F.lit(0), F.col("a") + F.col("b") - 1))
    hot = rows.join(large, "key").withColumn("t", own).withColumn("o", F.explode(others))
    side = F.when(F.col("t") == F.col("o"), 0).when(F.col("t") < F.col("o"), 1).otherwise(2)
    return cold.unionByName(hot.select(F.xxhash64("key", F.least("t", "o"), F.greatest("t", "o")).alias("part"), side.alias("side"), *plain[1:]))


def _texts(docs: DataFrame, ids: DataFrame, bits: int) -> DataFrame:
    """(id, node, line, fp) of the chosen ids, fp their SimHash. Should two lines share an id, which is half of their digest, it stands for one of them."""
    wanted = bloom.build(ids, "id", bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in by_bytes(batches, "text", _CHUNK):
            lines = split_lines(text_bytes(column(batch, "text")))[2]
            nodes = [digest(x) for x in lines]
            short = short_ids(nodes)
            some = [i for i in np.flatnonzero(bloom.contains(wanted, short)).tolist() if nodes[i] not in sent and not sent.add(nodes[i])]
            if len(sent) > _SEEN:
                sent.clear()
            if some:
                yield pa.RecordBatch.from_arrays([pa.array(short[some]), pa.array([nodes[i] for i in some], pa.binary()), pa.array([lines[i] for i in some], pa.binary())], names=["id", "node", "line"])

    def printed(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = simhashes(text_bytes(column(batch, "line")))
        return batch.append_column("fp", pa.array([x.tobytes() for x in prints], pa.binary()))

    found = docs.select("text").mapInArrow(work, "id long, node binary, line binary")
    found = found.join(ids, "id", "left_semi").groupBy("id").agg(F.min(F.struct("node", "line")).alias("x")).select("id", "x.*")
    return materialize(map_batches(found, printed, "id long, node binary, line binary, fp binary"), "lines")


def groups(docs: DataFrame, seen: DataFrame, least: float = SIMILAR, tile: int = TILE, bits: int = FILTER_BITS, radius: int = RADIUS) -> DataFrame:
    """(node, root) of each line that is linked to a different one; docs has the column text, `seen` are its occurrences()."""
    shared = shared_keys(seen.where(F.length("keys") > 0).select("node", "keys"), bits=bits)
    pairs = materialize(shared.select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    texts = _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), bits)

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = [pc.utf8_length(column(batch, c).cast(pa.string())).to_numpy() for c in ("x", "y")]
        near = _near(_bits_apart(_prints(column(batch, "p")), _prints(column(batch, "q"))), *sizes, radius)
        batch = batch.filter(pa.array(near & (np.abs(sizes[0] - sizes[1]) <= np.floor((1 - least) * np.maximum(*sizes) + 1e-9))))
        ok = [similar(x, y, least) for x, y in zip(*(column(batch, c).to_pylist() for c in ("x", "y")))]
        return batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one, other = texts.select(F.col("id").alias("a"), F.col("line").alias("x"), F.col("fp").alias("p")), texts.select(F.col("id").alias("b"), F.col("line").alias("y"), F.col("fp").alias("q"))
    pairs = pairs.join(other, "b").join(one, "a")
    links = materialize(map_batches(pairs, check, "a long, b long"), "links")
    found = connected_components(links)
    # lines of one key, none of them the one that all were held against, that are in different groups so far
    rest = shared.select("key", "id").join(found.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("label"))
    rest = materialize(rest, "labels")
    mixed = rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("key")
    rest = materialize(rest.join(mixed, "key", "left_semi").join(texts.select("id", "line", "fp"), "id"), "mixed")
    if not rest.isEmpty():
        dealt = _dealt(rest, tile).repartition(partitions(docs.sparkSession), "part").sortWithinPartitions("part")
        more = materialize(dealt.mapInArrow(_across(least, radius), "a long, b long"), "more")
        if not more.isEmpty():
            # links of labels: what is connected already isn't gone through again
            over = materialize(connected_components(more).select(F.col("node").alias("_label"), F.col("root").alias("_over")), "over")
            whole = found.join(over, F.col("root") == F.col("_label"), "left").select("node", F.coalesce("_over", "root").alias("root"))
            found = whole.unionByName(over.join(found, F.col("_label") == F.col("node"), "left_anti").select(F.col("_label").alias("node"), F.col("_over").alias("root")))
    return texts.select("id", "node").join(found.select(F.col("node").alias("id"), "root"), "id").select("node", "root")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS, counts: tuple[str, str] = ("n_lines", "n_removed"), **options) -> DataFrame:
    """`docs` with the text of each row without the lines that go; all rows and other columns stay as they are.

    Two columns, named by `counts`, are added, in place of any of these names: the lines of the text given (0 if null)
    and how many went. A null text stays null, and a text of which nothing is left is empty. Rows without an id come last
    in the order of occurrences; rows that share an id follow the order of a digest of id and text, and rows that share
    both count as one. An empty table gives an empty one. A text of any length is held by one task, line by line.
    """
    docs = docs.drop(*counts)
    seen = materialize(occurrences(docs, id_col, text_col), "occurrences")
    linked = materialize(groups(_docs(docs, id_col, text_col), seen, bits=bits, **options), "linked")
    twice = seen.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node")
    # eight bytes name a group of links, sixteen the copies of one line
    group = F.unhex(F.lpad(F.hex("root"), 16, "0"))
    grouped = linked.select("node", group.alias("grp")).unionByName(twice.join(linked, "node", "left_anti").select("node", F.col("node").alias("grp")))
    hits = materialize(seen.select("row", "doc_id", "number", "node").join(grouped, "node").select("row", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "number", "grp"), "hits")
    kept = hits.groupBy("grp").agg(F.min(F.struct("id", "row", "number")).alias("kept"))
    gone = hits.join(kept, "grp").where("row != kept.row OR number != kept.number").select("row", "number")
    per_row = materialize(gone.groupBy("row").agg(F.collect_set("number").alias("gone")), "gone")
    has = bloom.build(per_row.select(_first_half("row").alias("row")), "row", bits)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c: n for c, n in zip(docs.columns, names)}
    text, lines, row = at[text_col], f"_c{len(names)}", f"_c{len(names) + 1}"
    plain = docs.toDF(*names)
    kinds = ", ".join(f"{n} {t}" for n, t in [*plain.dtypes, (lines, "long")])

    def part(moving: bool) -> DataFrame:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = column(batch, at[id_col]).cast(pa.int64()).to_pylist()
            texts = text_bytes(column(batch, text))
            keys = [row_key(i, x) for i, x in zip(ids, texts)]
            counted = [x.count(b"\n") + 1 if given else 0 for x, given in zip(texts, column(batch, text).is_valid().to_pylist())]
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(counted, pa.int64()), pa.array(keys, pa.binary())], names=[*batch.schema.names, lines, row])
            return out.filter(pa.array(bloom.contains(has, short_ids(keys)) == moving))

        return map_batches(plain, work, f"{kinds}, {row} binary", text, _CHUNK)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, removed = [], []
        for x, gone in zip(column(batch, text).to_pylist(), column(batch, "gone").to_pylist()):
            if gone:
                drop = set(gone)
                x = "\n".join(y for i, y in enumerate(x.split("\n")) if i not in drop)
            texts.append(x), removed.append(len(gone or ()))
        i = batch.schema.get_field_index(text)
        cols = [c for c, n in zip(batch.columns, batch.schema.names) if n != "gone"]
        cols[i] = pa.array(texts, batch.schema.field(i).type)
        return pa.RecordBatch.from_arrays([*cols, pa.array(removed, pa.int64())], names=[n for n in batch.schema.names if n != "gone"] + ["n_removed"])

    still = part(False).drop(row).withColumn("n_removed", F.lit(0).cast("long"))
    moved = part(True).join(per_row.withColumnRenamed("row", row), row, "left").drop(row)
    return still.unionByName(map_batches(moved, cut, f"{kinds}, n_removed long", text, _CHUNK)).toDF(*docs.columns, *counts)
