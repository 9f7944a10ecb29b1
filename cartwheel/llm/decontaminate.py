"""Operator 2: benchmark decontamination by greedy string tiling.

Words are lower-cased (A-Z) runs between white space.  Seeds are the five-word
windows of the benchmark items; a document meets an item if they share a seed
(items of fewer words are one seed as a whole).  For each such pair, tiles are
marked greedily: the longest match of unmarked words, found by running
Karp-Rabin window hashes under a bisection of the length, is marked at all its
places that do not overlap, and again, until no match of five words is left.  An item is
leaked if its tiles cover at least half of its words, in whatever order the
passages stand.

Equal item texts are tiled once.  The benchmark's distinct texts are split into
blocks of bounded size that are held and broadcast one at a time, so its size does
not matter; documents are read once for each block and never shuffled, so it does
not matter how many share a passage.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import arrays

LEAST = 5  # words of a tile
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20  # of benchmark text that is broadcast at a time, about
FILTER_BITS = 20
SCHEMA = "doc_id long, item_id long, item_words long, covered_words long, n_tiles long, longest_tile long, coverage double"
_U = np.uint64
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Rolling:
    """Karp-Rabin hashes of any window length over one sequence."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.r_[_U(1), np.full(n, _U(_BASE))], dtype=np.uint64)
            self.down = np.cumprod(np.r_[_U(1), np.full(n, _U(_INVERSE))], dtype=np.uint64)
            self.sums = np.r_[_U(0), np.cumsum(h * power[:n], dtype=np.uint64)]
        self.n = n

    def windows(self, size: int, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows without a marked word, and their hashes."""
        m = self.n - size + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        taken = np.r_[0, np.cumsum(marked)]
        starts = np.flatnonzero(taken[size:] == taken[:m])
        return starts, (self.sums[starts + size] - self.sums[starts]) * self.down[starts]


def tiles(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: ``(start in a, start
    in b, words)``, longest first.  Words equal to 0 match nothing."""
    one, two = _Rolling(a), _Rolling(b)
    mark_a, mark_b = a == 0, b == 0
    out: list[tuple[int, int, int]] = []

    def common(size: int) -> list[tuple[int, list[int]]]:
        """Unmarked windows of ``a`` that ``b`` has too, each with its places there;
        equal windows share one list."""
        i, h = one.windows(size, mark_a)
        j, g = two.windows(size, mark_b)
        hit = np.isin(h, g)
        if not hit.any():
            return []
        held = np.isin(g, h[hit])
        places = defaultdict(list)
        for at, key in zip(j[held].tolist(), g[held].tolist(), strict=True):
            places[key].append(at)
        found = [(x, places[key]) for x, key in zip(i[hit].tolist(), h[hit].tolist(), strict=True)]
        return found if any(same(x, y, size) for x, ys in found for y in ys) else []

    def same(x: int, y: int, size: int) -> bool:
        return np.array_equal(a[x:x + size], b[y:y + size])

    high = min(len(a), len(b))
    while high >= least:
        found, size = common(high), high
        if not found:  # the longest match is shorter: bisect (a match of n words holds one of n - 1)
            low, high = least - 1, high - 1
            while low < high:
                middle = (low + high + 1) // 2
                matches = common(middle)
                if matches:
                    low, found = middle, matches
                else:
                    high = middle - 1
            size = low
            if size < least or not found:
                break
        for x, ys in found:
            if mark_a[x:x + size].any():
                continue
            for y in ys:
                if not mark_b[y:y + size].any() and same(x, y, size):
                    mark_a[x:x + size] = mark_b[y:y + size] = True
                    out.append((x, y, size))
                    break
            else:
                continue
            while ys and mark_b[ys[0]:ys[0] + size].any():  # taken for good
                del ys[0]
        high = size
    return out


class _Index:
    """Seeds of a block of items."""

    def __init__(self, items: pa.Table, least: int):
        self.least = least
        self.ids = items.column(0).to_pylist()
        self.words: list[np.ndarray] = []
        for chunk in items.column(1).chunks:
            for lo, hi, h, first, *_ in arrays.word_blocks(chunk):
                self.words += [h[first[k]:first[k + 1]].copy() for k in range(hi - lo)]
        by_size: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for i, h in enumerate(self.words):
            if len(h):
                size = min(least, len(h))
                by_size[size].append((arrays.chain(h, size), i))
        self.seeds = {}
        for size, found in by_size.items():
            keys = np.concatenate([k for k, _ in found])
            owner = np.concatenate([np.full(len(k), i) for k, i in found])
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            filled = np.zeros(1 << FILTER_BITS, bool)
            filled[(keys >> _U(64 - FILTER_BITS)).astype(np.int64)] = True
            self.seeds[size] = keys, owner, filled

    def pairs(self, h: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """(text, item) -> seed places (start, words) in ``h``."""
        out: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for size, (keys, owner, filled) in self.seeds.items():
            windows = arrays.chain(h, size)
            at = np.flatnonzero(filled[(windows >> _U(64 - FILTER_BITS)).astype(np.int64)])
            lo, hi = np.searchsorted(keys, windows[at], "left"), np.searchsorted(keys, windows[at], "right")
            hit = lo < hi
            at, lo, hi = at[hit], lo[hit], hi[hit]
            text = np.searchsorted(first, at, "right") - 1
            inside = at + size <= first[text + 1] if len(at) else hit[:0]
            for p, t, a, b in zip(at[inside].tolist(), text[inside].tolist(), lo[inside].tolist(), hi[inside].tolist(), strict=True):
                for item in set(owner[a:b].tolist()):
                    out[t, item].append((p, size))
        return out


def _leaks(index, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            ids, out = batch.column(0), []
            for lo, _, h, first, *_ in arrays.word_blocks(batch.column(1)):
                for (text, item), places in known.pairs(h, first).items():
                    a = known.words[item]
                    near = np.zeros(first[text + 1] - first[text] + 1, bool)
                    for p, size in places:  # no other word of the text can be in a tile
                        near[p - first[text]:p - first[text] + size] = True
                    if near.sum() < coverage * len(a):
                        continue
                    b = np.where(near[:-1], h[first[text]:first[text + 1]], _U(0))
                    edge = near[:-1] | np.r_[False, near[:-2]]  # one gap word after each stretch
                    found = tiles(a, b[edge], min(known.least, len(a)))
                    covered = sum(n for *_, n in found)
                    if covered >= coverage * len(a):
                        out.append((ids[lo + text].as_py(), known.ids[item], len(a), covered, len(found), max(n for *_, n in found), covered / len(a)))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if n == "coverage" else pa.int64()) for c, n in zip(columns, names, strict=True)], names=names)
    return run


def _blocks(texts: DataFrame, most: int) -> int:
    """So many blocks that none of several texts is over twice ``most`` bytes."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // most) or 1
    while True:
        filled = texts.groupBy(_block(blocks).alias("block")).agg(F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("n"))
        if not filled.where((F.col("size") > 2 * most) & (F.col("n") > 1)).limit(1).count():
            return blocks
        blocks *= 2


def _block(blocks: int):
    return F.pmod(F.xxhash64("text"), F.lit(blocks))


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """``(doc_id, item_id, item_words, covered_words, n_tiles, longest_tile,
    coverage)`` for every row of ``docs`` and item of ``benchmark`` whose tiles
    cover at least ``coverage`` of the item.  Null texts are empty and match
    nothing; ids may be null or repeat (rows are compared one by one, repeated
    items too, though equal item texts are tiled once); of tiles of one length the
    first in the item, and there the first in the text, is marked first; other
    columns are ignored; an empty table on either side gives no rows."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    distinct = stage(items.select("text").distinct().withColumn("key", F.monotonically_increasing_id()), "items")
    blocks = _blocks(distinct, BLOCK_BYTES)
    parts = []
    for k in range(blocks):
        index = spark.sparkContext.broadcast(_Index(distinct.where(_block(blocks) == k).select("key", "text").toArrow(), least))
        found = texts.mapInArrow(_leaks(index, coverage), SCHEMA)
        if blocks > 1:  # one block at a time is held
            found = stage(found, f"leaks-{k}")
            index.destroy()
        parts.append(found)
    keyed = items.join(distinct, "text").select("item_id", "key")
    found = reduce(DataFrame.unionByName, parts).withColumnRenamed("item_id", "key")
    return found.join(keyed, "key").select(*[c.split()[0] for c in SCHEMA.split(", ")])
