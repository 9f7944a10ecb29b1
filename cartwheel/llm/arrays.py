"""Word hashing over Arrow string buffers, shared by the set operators.

Words are runs of bytes other than space and ``\\t\\n\\v\\f\\r`` (all ASCII, so
byte and code point boundaries agree).  A word's 64-bit hash is a polynomial
over its bytes, finished with a mixer; a shingle's hash chains five word
hashes.  Everything is vectorised over blocks of about one megabyte, so memory
does not depend on the size of an Arrow batch; one longer text is hashed block
by block as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_codes(lower: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += _U(32)
    return mix(b + _U(1))


_CODES = {low: _byte_codes(low) for low in (False, True)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[_U(1), np.full(n, _U(_BASE))], dtype=np.uint64)
        down = np.cumprod(np.r_[_U(1), np.full(n, _U(inverse))], dtype=np.uint64)
    return up, down


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        _POWERS.append(_powers(BLOCK + 1))
    return _POWERS[0] if n <= BLOCK else _powers(n + 1)


def _hash_block(data: np.ndarray, breaks: np.ndarray, lower: bool):
    """Word hashes, starts and ends of one block; ``breaks`` are positions at
    which a word ends even without white space (the edges of texts)."""
    n = len(data)
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    inner = breaks[(breaks > 0) & (breaks < n)]
    start[inner] = word[inner]
    end = np.zeros(n + 1, bool)
    end[1:] = word
    end[1:n] &= ~word[1:]
    end[inner] = word[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    up, down = _power_tables(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_CODES[lower][data] * up[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64)), starts, ends


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """``(hashes, first, starts, ends)`` of the texts ``data[offsets[i]:offsets[i+1]]``:
    word hashes in order, the index of each text's first word (one more entry
    than texts), and the words' byte ranges in ``data``."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    parts, at = [], lo
    while at < hi:
        stop = min(hi, at + BLOCK)
        if stop < hi:  # a block ends at white space, or at the word's end if it is longer
            gaps = np.flatnonzero(_SPACE[data[at:stop]])
            while not len(gaps) and stop < hi:
                step = min(hi, stop + BLOCK)
                gaps = stop - at + np.flatnonzero(_SPACE[data[stop:step]])[:1]
                stop = step
            stop = at + int(gaps[-1]) + 1 if len(gaps) else hi
        h, s, e = _hash_block(data[at:stop], offsets - at, lower)
        parts.append((h, s + at, e + at))
        at = stop
    if parts:
        h, s, e = (np.concatenate(x) for x in zip(*parts, strict=True))
    else:
        h, s, e = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return h, np.searchsorted(s, offsets), s, e


def chain(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` consecutive words (fewer than ``k``: none)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out = mix(out * _U(3) + h[i:i + n])
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column (null: empty text)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] and buffers[2].size else np.zeros(0, np.uint8)
    return data, offsets


def row_blocks(offsets: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def word_blocks(column: pa.Array, lower: bool = True):
    """For blocks of rows: ``(lo, hi, hashes, first, starts, ends, data)``."""
    data, offsets = text_buffers(column)
    for lo, hi in row_blocks(offsets):
        h, first, s, e = hash_words(data, offsets[lo:hi + 1], lower)
        yield lo, hi, h, first, s, e, data


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of every text: all windows of
    ``k`` words, or the whole sequence where it is shorter (no word: empty)."""
    for lo, hi, h, first, *_ in word_blocks(column):
        windows = chain(h, k)
        for row in range(lo, hi):
            a, b = int(first[row - lo]), int(first[row - lo + 1])
            if b - a >= k:
                s = np.sort(windows[a:b - k + 1])
                if len(s) > 1:
                    s = s[np.r_[True, s[1:] != s[:-1]]]
            else:
                s = chain(h[a:b], b - a) if b > a else windows[:0]
            yield row, s


class Lists:
    """Lists of ids, one after another, in arrays that grow by half when full."""

    def __init__(self):
        self.n, self.ids, self.ends = 0, np.zeros(1, np.int32), np.zeros(1, np.int32)

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        lo, hi = int(self.ends[self.n]), self.n + len(counts)
        self.ids, self.ends = _room(self.ids, lo, lo + len(ids)), _room(self.ends, self.n + 1, hi + 1)
        self.ids[lo:lo + len(ids)] = ids
        self.ends[self.n + 1:hi + 1] = lo + np.cumsum(counts)
        self.n = hi

    def drop(self, n: int) -> None:
        """Forget the lists from number ``n`` on."""
        self.n, used = n, int(self.ends[n])
        if len(self.ids) > 2 * used + (1 << 20):
            self.ids = self.ids[:used].copy()

    def counts(self, at: np.ndarray) -> np.ndarray:
        return self.ends[at + 1] - self.ends[at]

    def taken(self, at: np.ndarray) -> np.ndarray:
        """The ids of the lists numbered ``at``, in that order."""
        counts = self.counts(at)
        ends = np.cumsum(counts, dtype=np.int64)
        return self.ids[np.repeat((self.ends[at] - (ends - counts)).astype(np.int32), counts) + np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)]


def _room(held: np.ndarray, used: int, wanted: int) -> np.ndarray:
    """``held`` with room for ``wanted`` values, of which ``used`` are kept."""
    if wanted <= len(held):
        return held
    larger = np.zeros(wanted + wanted // 2, held.dtype)
    larger[:used] = held[:used]
    return larger
