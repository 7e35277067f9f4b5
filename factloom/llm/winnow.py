"""Vectorised fingerprints of words, windows and segments of windows (numpy, no Spark).

A *unit* is a word or a byte.  A *window* is a fixed number of consecutive units of one
document.  Of the short grams inside a window the one with the smallest hash is its *anchor*:
it depends on the window's content only, so equal windows have equal anchors wherever they
stand.  Neighbouring windows with one anchor form a *segment*.  Two occurrences of a window
always lie in segments with the same anchor gram, which lets a corpus be compared through a
few rows per hundred units without losing one window.
"""

from __future__ import annotations

import hashlib
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A string column holds at most 2**31 bytes, so every position of a text fits.
_POSITION_MASK = U64((1 << 32) - 1)
#: Windows looked at together; longer texts are gone through in steps of so many.
_STEP = 1 << 20
#: Longer ranges of bytes are hashed one by one.
_LONG = 512
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the pair (a, b): one to one in either, linear in neither."""
    x = (a ^ U64(0x9E3779B97F4A7C15)) * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x += b
    x *= U64(0xA0761D6478BD642F)
    x ^= x >> U64(29)
    return x


def loads(data: np.ndarray) -> np.ndarray:
    """A view that holds at i the eight bytes from i on; behind the end there are zeros."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end): eight bytes at a time, long ranges by BLAKE2b."""
    n = (end - start).astype(np.int64)
    h = mix(n.astype(U64) + U64(seed + 1) * U64(0x9E3779B97F4A7C15))
    if not len(n):
        return h
    view = loads(data)
    short = n < 8
    last = view[np.where(short, start, end - 8)]
    # Of a short range the bytes behind its end are cut off.
    keep = np.where(short, (U64(1) << (U64(8) * np.minimum(n, 7).astype(U64))) - U64(1), U64(0xFFFFFFFFFFFFFFFF))
    h = join(h, last & keep)
    live, at = np.flatnonzero((n > 8) & (n <= _LONG)), 0
    while len(live):
        h[live] = join(h[live], view[start[live] + at])
        at += 8
        live = live[n[live] > at + 8]
    for i in np.flatnonzero(n > _LONG).tolist():
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        h[i] = int.from_bytes(digest, "little")
    return mix(h)


def digests(raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit BLAKE2b digests of byte ranges, as two arrays: equal digests stand for equal bytes."""
    blake = hashlib.blake2b
    whole = b"".join([blake(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist())])
    pairs = np.frombuffer(whole, "<i8").reshape(-1, 2)
    return np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


def sliding(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of h[i:i + width] for every i with a full range, from ranges of half the length."""
    out, done, size = None, 0, 1
    while True:
        if width & size:
            # Of the parts so far the ones behind are shorter.
            out = h if out is None else join(h[: len(h) - done], out[size:]) if len(h) > done else h[:0]
            done += size
        size *= 2
        if size > width:
            return mix(out)
        half = size // 2
        h = join(h[: max(len(h) - half, 0)], h[half:])


class Texts(NamedTuple):
    """Bytes of some texts laid end to end; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray


def texts(column: pa.Array) -> Texts:
    """The bytes of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(raw, offsets - offsets[0])


def pieces(batch: pa.RecordBatch, text: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each; a longer text stands alone."""
    column = batch.column(batch.schema.get_field_index(text))
    lengths = np.diff(texts(column).offsets)
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield batch.slice(start)


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  #: words of document i are first[i]:first[i + 1]


def words(t: Texts) -> Words:
    """Maximal runs of bytes other than 0x20 and 0x09-0x0D, document by document."""
    n = len(t.data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~_SPACE[t.data]
    edge = np.zeros(n + 1, bool)
    edge[t.offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:]
    ends = np.zeros(n + 1, bool)
    ends[1:] = inside[:-1] & (~inside[1:] | edge[1:])
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    first = np.searchsorted(start, t.offsets)
    doc = np.repeat(np.arange(len(t.offsets) - 1), np.diff(first))
    return Words(start, end, doc, first)


def folded(t: Texts) -> Texts:
    """A-Z as a-z."""
    return Texts(_FOLD[t.data], t.offsets)


def word_hashes(t: Texts, w: Words) -> np.ndarray:
    """A 64-bit hash per word."""
    return range_hashes(t.data, w.start, w.end)


class Spaced(NamedTuple):
    raw: bytes  #: all words, each followed by one space
    start: np.ndarray  #: where word i begins
    end: np.ndarray


def spaced(t: Texts, w: Words) -> Spaced:
    """The words laid end to end with single spaces: equal sequences of words are equal bytes."""
    length = w.end - w.start
    end = np.cumsum(length + 1)
    start = end - length - 1
    inside = np.zeros(len(t.data) + 1, bool)
    inside[: len(t.data)] = ~_SPACE[t.data]
    out = np.full(int(end[-1]) if len(end) else 0, 32, np.uint8)
    spot = np.ones(len(out), bool)
    spot[end - 1] = False
    out[spot] = t.data[inside[:-1]]
    return Spaced(out.tobytes(), start, end - 1)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """min(v[i:i + width]) for every i with a full range."""
    n = len(v)
    if n < width:
        return v[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, U64)
    padded[:n] = v
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Segments(NamedTuple):
    anchor: np.ndarray  #: hash of the anchor gram
    first: np.ndarray  #: unit at which the segment begins
    doc: np.ndarray  #: document's index
    start: np.ndarray  #: first window, counted within the document
    count: np.ndarray  #: windows


def byte_grams(data: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of ``gram`` bytes, a multiple of eight."""
    view = loads(data)[: max(len(data) - 7, 0)]
    # Pairs eight bytes apart: the bytes at i are the numbers i, i + 8, ...
    return _apart(np.array(view), gram // 8)


def _apart(h: np.ndarray, width: int) -> np.ndarray:
    out, done, size = None, 0, 1
    while True:
        if width & size:
            out = h if out is None else join(h[: max(len(h) - 8 * done, 0)], out[8 * size :])
            done += size
        size *= 2
        if size > width:
            return mix(out)
        step = 4 * size
        h = join(h[: max(len(h) - step, 0)], h[step:])


def segments(grams, n: int, doc: np.ndarray, first: np.ndarray, window: int, gram: int) -> Segments:
    """Segments of all windows of n units.

    grams(a, b): hashes of the grams that begin at the units a to b; doc: each unit's document; first:
    units before a document.  Many units are taken in steps, which cuts a segment at their border; its
    parts have the same anchor, so nothing is lost by that.
    """
    found = []
    for lo in range(0, n - window + 1, _STEP):
        hi = min(n - window + 1, lo + _STEP)
        hashes = grams(lo, hi + window - gram)
        at = np.arange(len(hashes), dtype=U64)
        packed = (mix(hashes) & ~_POSITION_MASK) | at
        where = (sliding_min(packed, window - gram + 1) & _POSITION_MASK).astype(np.int64)
        valid = doc[lo:hi] == doc[lo + window - 1 : hi + window - 1]
        new = valid.copy()
        new[1:] &= (where[1:] != where[:-1]) | ~valid[:-1]
        last = valid.copy()
        last[:-1] &= (where[1:] != where[:-1]) | ~valid[1:]
        start, stop = np.flatnonzero(new), np.flatnonzero(last)
        found.append((hashes[where[start]], start + lo, stop - start + 1))
    if not found:
        none = np.zeros(0, np.int64)
        return Segments(none.astype(U64), none, none, none, none)
    anchor, at, count = (np.concatenate(x) for x in zip(*found))
    return Segments(anchor, at, doc[at], at - first[doc[at]], count)


def word_segments(values: np.ndarray, w: Words, window: int, gram: int) -> Segments:
    return segments(lambda a, b: sliding(values[a : b + gram - 1], gram), len(values), w.doc, w.first, window, gram)


def byte_segments(t: Texts, doc: np.ndarray, window: int, gram: int) -> Segments:
    return segments(lambda a, b: byte_grams(t.data[a : b + gram - 1], gram), len(t.data), doc, t.offsets, window, gram)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n units some range [start, end) covers."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:n]) > 0
