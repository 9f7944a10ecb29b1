"""Operator 8: exact Jaccard self-join of documents in metric space.

``d(x, y) = 1 - Jaccard`` over sets of five-word shingles is a metric; two
documents link when ``d <= t`` (t = 0.25).

1. *Classes.* Documents with equal sets collapse to one representative
   (``groupBy`` on a 128-bit fingerprint), however many copies there are.
2. *Regions.* Linked sets must share one of their first ``|x| - ceil(0.75|x|) + 1``
   shingles under any common order.  The order used here puts shingles that are
   frequent in the corpus last, then goes by hash.  The sets that hold one such
   shingle form a region around a pivot, the member of smallest rank; a set lies
   in the regions of several pivots, so boundary documents are replicated and
   each linked pair meets in the region of the first shingle that they share.
   There all that they share stands at or after it, so a member whose place of the
   shingle is ``at`` only links with sets of ``most`` shingles at most, which is
   ``(|x| - at) (100 + 75) / 75 - |x|``.
3. *Distances to pivots.* Every member is joined with its region's pivot, which
   is linear in the region.  A parity bitmap gives a lower bound of the distance
   that rejects nearly all unrelated members; the rest are compared exactly.
   Links to pivots give provisional components.
4. *Windows.* Two members of a region with pivot ``p`` can only link if
   ``|d(x,p) - d(y,p)| <= t``.  So a region is finished if its members are one
   component, or if what lies outside the pivot's ball of radius t is one
   document more than 2t away.  The others keep what lies outside the ball,
   and the part of the ball within t of it.  There are windows on sizes too: in
   order of size, a region is cut before a set larger than any ``most`` before it.
5. *Recursion.* What is kept is joined again inside its region: size-sorted
   cells of bounded size, in each a new pivot, windows on the distance to it,
   and the same on both sides, until nothing is left to compare.  Of the pairs of
   different components that pass the bounds, each member's nearest leaves the task
   and is verified, which joins most of a large group of near copies.
6. *Forests.* Members in further such pairs are put into cells anew, component by
   component, largest first, and cells of one component are not compared with each
   other.  Maps of ``SHARP`` times as many bits, made for these members only, tell
   which of them may still have a link in a pair of cells; only their sets are
   brought there, compared exactly inside the task, nearest first, and what leaves
   it is a spanning forest: fewer rows than members, however many links there are.

The result is exact.  Skew: a frequent shingle is only a hash away from the end
of the order, exact copies are collapsed first, regions are streamed row by
row, and cells bound what one task holds.

Rows with a null ``doc_id`` or with an empty set link with nothing (their
component is their own id).  Repeated rows are copies; rows that share an id
are one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import arrays
from .components import connected_components

SHINGLE_WORDS = 5
PERCENT = 75  # least Jaccard similarity of linked documents, in per cent
BITMAP_BITS = 23  # of the table of frequent shingles: 2^23 bits, whatever the corpus
HEAVY_SHARE = 2000  # a shingle is frequent if it is in more than 1/2000 of the documents
LEAF_BYTES = 1 << 22  # of maps that are compared at a time
CELL = 512  # members that a cell of a region has at most
SHARP = 8  # times the bits of the maps that decide whose sets are compared
FLUSH = 1 << 21  # shingles that a task counts at a time
_U = np.uint64


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document (kind 0: id, size, fingerprint) and for each
    shingle that is frequent among the documents of one flush (kind 1: hash, count)."""
    held, size, docs = [], 0, 0

    def flush():
        u, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        keep = n >= max(3, docs // HEAVY_SHARE)
        u, n = u[keep].view(np.int64), n[keep]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(u), np.int8)), pa.array(u), pa.array(n.astype(np.int64)), pa.nulls(len(u), pa.int64()), pa.nulls(len(u), pa.int64())],
            names=["kind", "id", "n", "fp1", "fp2"])

    for batch in batches:
        sizes, prints = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, 2), np.int64)
        for row, s in arrays.shingle_sets(batch.column(1), SHINGLE_WORDS):
            sizes[row], prints[row] = len(s), _fingerprint(s)
            held.append(s)
            size, docs = size + len(s), docs + 1
            if size >= FLUSH:
                yield flush()
                held, size, docs = [], 0, 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(batch.num_rows, np.int8)), batch.column(0), pa.array(sizes), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy())],
            names=["kind", "id", "n", "fp1", "fp2"])
    yield flush()


def prefix_length(n):
    """So many first shingles of a set of ``n`` meet those of every linked set."""
    return n - (PERCENT * n + 99) // 100 + 1


def _parity(s: np.ndarray, sharp: int = 1) -> np.ndarray:
    """Parity bitmap over a power of two of at least |s| bits (64 at least, both times ``sharp``): one
    differing shingle changes one bit at most, so the bits that differ between
    two sets' maps are no more than the shingles that differ."""
    bits = sharp * (max(64, 1 << int(len(s) - 1).bit_length()) if len(s) else 64)
    at = (arrays.mix(s) & _U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8))


def _fold(b: np.ndarray, size: int) -> np.ndarray:
    while len(b) > size:  # the low bits of the position stay
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return b


def _prefixes(frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, firsts, maps = [], [], [], []
            for row, s in arrays.shingle_sets(batch.column(1), SHINGLE_WORDS):
                if not len(s):
                    continue
                at = s >> _U(64 - BITMAP_BITS)
                late = (frequent[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1
                k = prefix_length(len(s))
                early = s[late == 0]
                first = early[:k] if len(early) >= k else np.concatenate([early, s[late == 1][:k - len(early)]])
                rows.append(row), sizes.append(len(s)), firsts.append(first.view(np.int64)), maps.append(_parity(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(firsts, pa.list_(pa.int64())), pa.array(maps, pa.binary())],
                names=["doc_id", "n", "first", "parity"])
    return run


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token and rank: those whose token has several, with the
    first as pivot; ``more`` if it may have over two.  Streams; a region may span
    any number of batches."""
    names = ["token", "x", "n", "most", "pivot", "pivot_n", "pivot_most", "more"]
    last = None  # (token, x, n, most, emitted) of the region that the previous batch ended in
    row = None  # the previous batch's last; repeated rows are left out
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
        again = np.r_[row is not None and (rows[:, 0] == row).all(), (rows[:, 1:] == rows[:, :-1]).all(axis=0)]
        row = rows[:, -1]
        if again.all():
            continue
        t, x, n, most = rows[:, ~again]
        new = np.r_[True, t[1:] != t[:-1]]
        starts = np.flatnonzero(new)
        lengths = np.diff(np.r_[starts, len(t)])
        first, several = np.repeat(starts, lengths), np.repeat(lengths > 1, lengths)
        pivot, pivot_n, pivot_most = x[first], n[first], most[first]
        joined = last is not None and last[0] == t[0]
        edge = lengths.copy()  # regions at either end of the batch may have more members
        edge[-1] = 3
        if joined:
            pivot[:lengths[0]], pivot_n[:lengths[0]], pivot_most[:lengths[0]], several[:lengths[0]], edge[0] = *last[1:4], True, 3
        more = np.repeat(edge > 2, lengths)
        out = [v[several] for v in (t, x, n, most, pivot, pivot_n, pivot_most, more)]
        if joined and not last[4]:
            out = [np.r_[v, o] for v, o in zip((*last[:4], *last[1:4], True), out, strict=True)]
        if len(out[0]):
            yield pa.RecordBatch.from_arrays([pa.array(o.astype(np.int64)) for o in out[:-1]] + [pa.array(out[-1].astype(bool))], names=names)
        if len(starts) == 1 and joined:
            last = (*last[:4], True)
        else:
            last = (t[-1], x[starts[-1]], n[starts[-1]], most[starts[-1]], bool(lengths[-1] > 1))


def _bound(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lower bound of the distance of each pair from its parity bitmaps."""
    for p in pairs:
        bound = np.zeros(len(p))
        for i, (a, b, n, m) in enumerate(zip(p.parity, p.pivot_parity, p.n, p.pivot_n, strict=True)):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            size = min(len(a), len(b))
            differ = int(np.bitwise_count(_fold(a, size) ^ _fold(b, size)).sum())
            # |x - y| + |y - x| >= differ; the distance is that over the union
            bound[i] = _distance_bound(differ, n, m)
        yield pd.DataFrame({"x": p.x, "pivot": p["pivot"], "bound": bound})


def _distance_bound(differ, n, m):
    """d = D / ((n + m + D) / 2) grows with D, the size of the symmetric difference."""
    differ = np.maximum(differ, np.abs(n - m))
    return 2 * differ / (n + m + differ)


def _exact(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in pairs:
        shared = np.array([len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
                           for a, b in zip(p.s, p.pivot_s, strict=True)], np.int64)
        union = p.s.map(len).to_numpy(np.int64) // 8 + p.pivot_s.map(len).to_numpy(np.int64) // 8 - shared
        yield pd.DataFrame({"x": p.x, "pivot": p["pivot"], "distance": 1 - shared / union, "linked": 100 * shared >= PERCENT * union})


T = 1 - PERCENT / 100
#: Added to windows on distances, which are floats.
EPS = 1e-9


def _join_cell(ids, sizes, maps, comps, left, right, out) -> None:
    """Pairs (i of left, j of right; i < j if both are the same) of different
    components that the bounds leave.  Recursive: a pivot splits what is to be
    compared into those near it and those far from it; windows on the bitmap
    distance, a metric, say which go to both sides."""
    same = left is right
    if not len(left) or not len(right) or (same and len(left) < 2):
        return
    if len(left) * len(right) * maps.shape[1] <= LEAF_BYTES or len(left) < 8 or len(right) < 8:
        for a in range(0, len(left), max(1, LEAF_BYTES // max(1, len(right) * maps.shape[1]))):
            rows = left[a:a + max(1, LEAF_BYTES // max(1, len(right) * maps.shape[1]))]
            differ = np.bitwise_count(maps[rows][:, None, :] ^ maps[right][None, :, :]).sum(axis=2, dtype=np.int64)
            far = _distance_bound(differ, sizes[rows][:, None], sizes[right][None, :])
            ok = (far <= T + EPS) & (comps[rows][:, None] != comps[right][None, :])
            if same:
                ok &= rows[:, None] < right[None, :]
            x, y = np.nonzero(ok)
            if len(x):
                out.append((ids[rows[x]], ids[right[y]], far[x, y]))
        return
    members = left if same else np.concatenate([left, right])
    # the most bits by which the maps of two linked members can differ
    reach = T / (2 - T) * 2 * float(sizes[members].max())
    pivot = members[len(members) // 2]
    to = np.bitwise_count(maps[members] ^ maps[pivot]).sum(axis=1).astype(np.int64)
    middle = float(np.median(to))
    near = to <= middle
    in_left = near[:len(left)]
    in_right = in_left if same else near[len(left):]
    to_left = to[:len(left)]
    to_right = to_left if same else to[len(left):]
    # pairs on one side, and pairs across it within the window
    l1, l2 = left[in_left], left[~in_left]
    r1, r2 = (l1, l2) if same else (right[in_right], right[~in_right])
    if len(l1) in (0, len(left)) and len(r1) in (0, len(right)):
        half = len(left) // 2
        a, b = left[:half], left[half:]
        if same:
            _join_cell(ids, sizes, maps, comps, a, a, out)
            _join_cell(ids, sizes, maps, comps, b, b, out)
            _join_cell(ids, sizes, maps, comps, a, b, out)
        else:
            _join_cell(ids, sizes, maps, comps, a, right, out)
            _join_cell(ids, sizes, maps, comps, b, right, out)
        return
    _join_cell(ids, sizes, maps, comps, l1, r1, out)
    _join_cell(ids, sizes, maps, comps, l2, r2, out)
    edge_l1, edge_r2 = l1[to_left[in_left] >= middle - reach], r2[to_right[~in_right] <= middle + reach]
    _join_cell(ids, sizes, maps, comps, edge_l1, edge_r2, out)
    if not same:
        edge_l2, edge_r1 = l2[to_left[~in_left] <= middle + reach], r1[to_right[in_right] >= middle - reach]
        _join_cell(ids, sizes, maps, comps, edge_l2, edge_r1, out)


def _join_region(cell: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One cell, or two cells of a region: the pairs that may link, and bounds of
    their distances.  Maps of one length are compared, and with those of twice that
    length folded; sets with maps of other lengths differ too much in size."""
    maps = [np.frombuffer(b, np.uint8) for b in cell.parity]
    ids, sizes, comps = cell.x.to_numpy(), cell.n.to_numpy(np.int64), cell.component.to_numpy()
    lengths = np.fromiter(map(len, maps), np.int64, len(maps))
    side = cell.side.to_numpy()
    two = bool(side.any())
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero((lengths == length) | (lengths == 2 * length))
        stacked = np.stack([_fold(maps[i], length) for i in at])
        short = lengths[at] == length
        first = side[at] == 0
        args = (ids[at], sizes[at], stacked, comps[at])
        if two:
            sides = ((first & short, ~first & short), (first & short, ~first & ~short), (first & ~short, ~first & short))
        else:
            sides = ((short, short), (short, ~short))
        for k, (a, b) in enumerate(sides):
            a, b = np.flatnonzero(a), np.flatnonzero(b)
            _join_cell(*args, a, a if k == 0 and not two else b, out)
    if not out:
        return ids[:0], ids[:0], np.zeros(0)
    x, y, far = (np.concatenate(v) for v in zip(*out, strict=True))
    return np.maximum(x, y), np.minimum(x, y), far


def _nearest(x: np.ndarray, y: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Indices of the pairs that are the nearest of one of their members."""
    ends, pairs = np.r_[x, y], np.r_[np.arange(len(x)), np.arange(len(x))]
    order = np.lexsort((pairs, far[pairs], ends))
    first = np.r_[True, ends[order][1:] != ends[order][:-1]]
    return np.unique(pairs[order][first])


def _region_pairs(nearest: bool):
    """Of rows sorted by region and cells: the pairs (``a``, ``b``) of each that may
    link, or of these the nearest of each member and, as ``open`` rows, what of region
    ``a`` is in others too: members ``b`` of one cell, or, of two, the cells ``b`` (``c`` is 1)."""
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        key = rows[["token", "i", "j"]].to_numpy(np.int64)
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        found, unfinished = [], [np.zeros((0, 3), np.int64)]
        for a, b in zip(starts, [*starts[1:], len(rows)], strict=True):
            x, y, far = _join_region(rows.iloc[a:b])
            if nearest and len(x):
                keep = _nearest(x, y, far)
                token, i, j = key[a]
                if i == j:
                    more = np.unique(np.r_[np.delete(x, keep), np.delete(y, keep)])
                    unfinished.append(np.stack([np.full(len(more), token), more, np.zeros(len(more), np.int64)], axis=1))
                elif len(keep) < len(x):
                    unfinished.append(np.array([(token, i, 1), (token, j, 1)]))
                x, y = x[keep], y[keep]
            found.append(np.stack([x, y, np.zeros(len(x), np.int64)], axis=1))
        pairs, cells = (pd.DataFrame(np.concatenate(v) if v else np.zeros((0, 3), np.int64), columns=["a", "b", "c"]) for v in (found, unfinished))
        pairs.insert(0, "open", False)
        cells.insert(0, "open", True)
        return pd.concat([pairs.drop_duplicates(), cells], ignore_index=True)

    return _by_cells(join)


def _by_cells(join):
    """Runs ``join`` on whole cells, or pairs of them, of rows sorted by region and
    cells; one may span any number of batches."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in frames:
            if not len(rows):
                continue
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            last = rows[["token", "i", "j"]].iloc[-1]
            open_ = (rows.token == last.token) & (rows.i == last.i) & (rows.j == last.j)
            held = rows[open_]
            if not open_.all():
                yield join(rows[~open_])
        if held is not None:
            yield join(held)
    return run


def _parts(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows of each pair of cells."""
    key = rows[["token", "i", "j"]].to_numpy(np.int64)
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
    for a, b in zip(starts, [*starts[1:], len(rows)], strict=True):
        yield rows.iloc[a:b]


def _undecided(rows: pd.DataFrame) -> pd.DataFrame:
    """The members of each pair of cells that are in a pair the bounds leave."""
    out = []
    for part in _parts(rows):
        x, y, _ = _join_region(part)
        out.append(part.loc[part.x.isin(np.unique(np.r_[x, y])), ["token", "i", "j", "side", "x", "n", "component"]])
    return pd.concat(out, ignore_index=True)


def _forest(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between members of different components of each pair of cells, by their
    sets: those that join two components that earlier ones have not."""
    found = []
    for part in _parts(rows):
        sets = [np.frombuffer(b, np.uint64) for b in part.s]
        # by place: rows that share an id may have several sets
        x, y, far = _join_region(part.assign(x=np.arange(len(part)), parity=[_parity(v, SHARP).tobytes() for v in sets]))
        ids = part.x.to_numpy()
        parent = {c: c for c in part.component.tolist()}
        component = part.component.to_numpy()

        def root(c: int, parent: dict = parent) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        for k in np.argsort(far, kind="stable").tolist():
            i, j = int(x[k]), int(y[k])
            a, b = root(int(component[i])), root(int(component[j]))
            if a == b:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * shared >= PERCENT * (len(sets[i]) + len(sets[j]) - shared):
                parent[max(a, b)] = min(a, b)
                found.append((ids[i], ids[j]))
    return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["x", "pivot"])


def _bits(slots: DataFrame, bits: int) -> np.ndarray:
    """Bit table of a column of slots below 2^bits."""
    at = slots.distinct().toArrow().column(0).to_numpy().astype(np.int64)
    table = np.zeros((1 << bits) // 8, np.uint8)
    np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return table


def _sets(wanted, make):
    """What ``make`` gives for the sets of the documents whose hashed id is in the bit table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = wanted.value
            slot = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(((table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)))
            sets = [make(s).tobytes() for _, s in arrays.shingle_sets(batch.column(1), SHINGLE_WORDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "s"])
    return run


def _made(base: DataFrame, ids: DataFrame, make=lambda s: s) -> DataFrame:
    """``(doc_id, s)``: what ``make`` gives for the sets of the documents ``ids``, in
    one shuffle.  Sets are made anew from the texts: a bit table of hashed ids, of
    fixed size, spares the other documents, and a semi-join removes what slips through
    (where the sets are: the ids, which grow with the corpus, are not broadcast)."""
    slot = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - BITMAP_BITS).cast("long")
    ids = stage(ids.distinct(), "candidates")
    wanted = base.sparkSession.sparkContext.broadcast(_bits(ids.select(slot.alias("slot")), BITMAP_BITS))
    return (base.where("doc_id IS NOT NULL").withColumn("slot", slot)
            .mapInArrow(_sets(wanted, make), "doc_id long, s binary").repartition("doc_id")
            .join(ids.hint("shuffle_hash"), "doc_id", "left_semi").distinct())


def _verified(base: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exact distances of pairs (x, pivot)."""
    sets = _made(base, pairs.select(F.explode(F.array("x", "pivot")).alias("doc_id")))
    both = (pairs.join(sets.withColumnRenamed("doc_id", "x"), "x")
            .join(sets.select(F.col("doc_id").alias("pivot"), F.col("s").alias("pivot_s")), "pivot"))
    return both.mapInPandas(_exact, "x long, pivot long, distance double, linked boolean")


def _with_components(members: DataFrame, known: DataFrame) -> DataFrame:
    """``members`` with the component of ``x``: its own id where no link is known."""
    return (members.join(known.select(F.col("node").alias("x"), F.col("component").alias("known")), "x", "left")
            .withColumn("component", F.coalesce("known", "x")).drop("known"))


def _bounds(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """Lower bounds of the distances of pairs (x, pivot)."""
    other = maps.select(F.col("x").alias("pivot"), F.col("n").alias("pivot_n"), F.col("parity").alias("pivot_parity"))
    return pairs.join(maps, "x").join(other, "pivot").mapInPandas(_bound, "x long, pivot long, bound double")


def _size_runs(members: DataFrame) -> DataFrame:
    """``members`` (token, x, n, most, component) with their regions cut wherever the
    next larger set is too large to link with any before it."""
    by_size = "OVER (PARTITION BY token ORDER BY n, x)"
    return (members.withColumn("gap", F.expr(f"CASE WHEN n > max(most) {by_size[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END"))
            .withColumn("run", F.expr(f"sum(gap) {by_size}"))
            .select(F.xxhash64("token", "run").alias("token"), "x", "n", "component"))


def _cells(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (token, x, n, component) of regions in size-sorted cells, and the
    pairs (token, i, j) of cells whose sizes let members link.  Regions of the same
    members are taken once."""
    signature = left.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("x")).alias("h1"), F.sum(F.hash("x").cast("long")).alias("h2"),
                                          F.min("component").alias("c1"), F.max("component").alias("c2"))
    chosen = signature.where("c1 < c2").groupBy("size", "h1", "h2").agg(F.min("token").alias("token")).select("token")
    placed = stage(left.join(chosen, "token").withColumn("cell", F.expr(f"(row_number() OVER (PARTITION BY token ORDER BY n, x) - 1) div {CELL}")), "placed")
    return placed, _tasks(placed)


def _tasks(placed: DataFrame) -> DataFrame:
    """The pairs (token, i, j), i <= j, of a region's cells whose sizes let members
    link, without those of one component."""
    cells = placed.groupBy("token", "cell").agg(*(f(c).alias(n) for f, c, n in (
        (F.min, "n", "n1"), (F.max, "n", "n2"), (F.min, "component", "c1"), (F.max, "component", "c2"))))
    other = cells.select("token", F.col("cell").alias("j"), F.col("n1").alias("m1"), F.col("n2").alias("m2"), F.col("c1").alias("d1"), F.col("c2").alias("d2"))
    return (cells.withColumnRenamed("cell", "i").join(other, "token")
            .where(f"i <= j AND 100 * n2 >= {PERCENT} * m1 AND 100 * m2 >= {PERCENT} * n1 AND NOT (c1 = c2 AND d1 = d2 AND c1 = d1)")
            .select("token", "i", "j"))


def _by_component(placed: DataFrame) -> DataFrame:
    """Regions cut into cells anew, the largest component first."""
    sizes = placed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("size"))
    return (placed.drop("cell").join(sizes, ["token", "component"])
            .withColumn("cell", F.expr(f"(row_number() OVER (PARTITION BY token ORDER BY size DESC, component, n, x) - 1) div {CELL}"))
            .select("token", "x", "n", "component", "cell"))


def _sided(placed: DataFrame, tasks: DataFrame) -> DataFrame:
    """Members (token, i, j, side, x, n, component) of pairs of cells.  Merged: a table
    of members by two keys is large on the driver before its files are."""
    sides = (tasks.select("token", "i", "j", F.col("i").alias("cell"), F.lit(0).alias("side"))
             .unionByName(tasks.where("i < j").select("token", "i", "j", F.col("j").alias("cell"), F.lit(1).alias("side"))))
    return placed.hint("merge").join(sides, ["token", "cell"]).select("token", "i", "j", "side", "x", "n", "component")


def _together(members: DataFrame) -> DataFrame:
    return members.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "side", "n", "x")


def _nearest_pairs(placed: DataFrame, tasks: DataFrame, maps: DataFrame) -> DataFrame:
    """What ``_region_pairs`` finds in pairs of cells.  The maps are joined last, so
    that they are moved once."""
    return (_together(_sided(placed, tasks).join(maps.select("x", "parity"), "x"))
            .mapInPandas(_region_pairs(True), "open boolean, a long, b long, c long").distinct())


def _forests(base: DataFrame, placed: DataFrame) -> DataFrame:
    """Links (x, pivot) that join all linked components of the regions ``placed``."""
    sharp = _made(base, placed.select(F.col("x").alias("doc_id")), lambda s: _parity(s, SHARP))
    members = _sided(placed, _tasks(placed)).join(sharp.select(F.col("doc_id").alias("x"), F.col("s").alias("parity")), "x")
    left = stage(_together(members).mapInPandas(_by_cells(_undecided), "token long, i long, j long, side int, x long, n long, component long"), "undecided")
    sets = _made(base, left.select(F.col("x").alias("doc_id")))
    return _together(left.join(sets.select(F.col("doc_id").alias("x"), "s"), "x")).mapInPandas(_by_cells(_forest), "x long, pivot long").distinct()


def _pairs_of(found: DataFrame) -> DataFrame:
    return found.where("NOT open").select(F.col("a").alias("x"), F.col("b").alias("pivot"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs`` (columns
    ``doc_id`` and ``text`` are read, others ignored): the size of its shingle
    set, and the smallest id that links reach from it."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profiles = stage(base.mapInArrow(_profiles, "kind byte, id long, n long, fp1 long, fp2 long"), "profiles")
    documents = profiles.where("kind = 0").select(F.col("id").alias("doc_id"), "n", "fp1", "fp2")
    total = documents.count()
    frequent = (profiles.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= max(10, total // HEAVY_SHARE))
                .select(F.shiftrightunsigned("id", 64 - BITMAP_BITS).alias("slot")))
    order = _bits(frequent, BITMAP_BITS)

    # classes of equal sets, and their first shingles
    classes = documents.where("n > 0 AND doc_id IS NOT NULL").groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("rep"))
    classes = stage(classes, "classes")
    prefixes = stage(base.where("doc_id IS NOT NULL").mapInArrow(_prefixes(order), "doc_id long, n long, first array<bigint>, parity binary")
                     .join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "prefixes")
    maps = prefixes.select(F.col("doc_id").alias("x"), "n", "parity")

    # regions, and the distances of their members to the pivots
    regions = stage(prefixes.select(F.posexplode("first").alias("at", "token"), F.col("doc_id").alias("x"), "n")
                    # size and place in one long: this is the largest shuffle
                    .select("token", "x", F.expr("shiftleft(cast(at AS long), 32) + n").alias("placed"))
                    .repartition("token").sortWithinPartitions("token", F.xxhash64("x"), "x", "placed")
                    .select("token", "x", F.expr("placed & 4294967295").alias("n"), F.expr("shiftright(placed, 32)").alias("at"))
                    .select("token", "x", "n", F.expr(f"({100 + PERCENT} * (n - at)) div {PERCENT} - n").alias("most"))
                    .mapInArrow(_regions, "token long, x long, n long, most long, pivot long, pivot_n long, pivot_most long, more boolean"), "regions")
    pairs = regions.where("x != pivot AND n <= pivot_most AND pivot_n <= most").select("x", "pivot").distinct()
    bounds = stage(_bounds(pairs, maps), "bounds")
    first = stage(_verified(base, bounds.where(F.col("bound") <= T + EPS).select("x", "pivot").distinct()), "links")
    links = first.where("linked").select("x", "pivot")
    known = connected_components(links, "x", "pivot")

    # windows: what of each region is left to compare
    distances = (bounds.groupBy("x", "pivot").agg(F.min("bound").alias("bound"))
                 .join(first.groupBy("x", "pivot").agg(F.min("distance").alias("distance"), F.max("linked").alias("linked")), ["x", "pivot"], "left"))
    members = _with_components(regions.where("more").select("token", "x", "n", "most", "pivot", "pivot_n").join(distances, ["x", "pivot"], "left"), known)
    members = (members.withColumn("inside", F.expr("x = pivot OR coalesce(linked, false)"))
               # bounds of pairs of too different sizes follow from the sizes
               .withColumn("far", F.expr("CASE WHEN x = pivot THEN 0 ELSE coalesce(distance, bound, 2 * abs(n - pivot_n) / (n + pivot_n + abs(n - pivot_n))) END")))
    region = members.groupBy("token").agg(
        F.min(F.expr(f"CASE WHEN NOT inside AND far <= {2 * T + EPS} THEN far END")).alias("nearest"),
        F.count(F.when(~F.col("inside"), 1)).alias("outside"),
        F.min("component").alias("c1"), F.max("component").alias("c2"))
    region = region.where("c1 < c2 AND (nearest IS NOT NULL OR outside > 1)")
    left = stage(_size_runs(members.join(region.select("token", "nearest"), "token")
                            .where(f"NOT inside OR far >= nearest - {T + EPS}").select("token", "x", "n", "most", "component")), "left")

    # recursion: every member with its nearest first, which joins most of a large group in linear output;
    # then forests of those in further pairs, in regions where they are of several components
    placed, tasks = _cells(left)
    near = stage(_nearest_pairs(placed, tasks, maps), "near")
    links = stage(links.unionByName(_verified(base, _pairs_of(near)).where("linked").select("x", "pivot")).distinct(), "links")
    known = connected_components(links, "x", "pivot")
    more = near.where("open").select(F.col("a").alias("token"), "b", "c")
    kept = (placed.join(more.where("c = 0").select("token", F.col("b").alias("x")), ["token", "x"], "left_semi")
            .unionByName(placed.join(more.where("c = 1").select("token", F.col("b").alias("cell")), ["token", "cell"], "left_semi")).distinct())
    placed = stage(_with_components(kept.drop("component"), known), "placed")
    mixed = placed.groupBy("token").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 < c2").select("token")
    placed = stage(_by_component(placed.join(mixed, "token", "left_semi")), "mixed")
    links = links.unionByName(stage(_forests(base, placed), "forests"))

    found = connected_components(links, "x", "pivot")
    labels = (classes.join(found.select(F.col("node").alias("rep"), F.col("component")), "rep", "left")
              .select("fp1", "fp2", "n", F.coalesce("component", "rep").alias("component_id")))
    return (documents.join(labels, ["fp1", "fp2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))
