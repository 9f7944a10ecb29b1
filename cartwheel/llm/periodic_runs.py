"""Operator 13: periodic runs of words by scale-tiled distribution.

A run of period q is a stretch whose words q apart are equal, at least
``max(6, 4 q)`` words long, that cannot be extended, and that has no smaller
period.  Its matches (places i with word i = word i + q) are then at least 3 q
in a row, so with P the power of two at or below q they fill two whole blocks
of P words that start at multiples of P.

* A document is exploded into overlapping tiles per octave P <= q < 2 P.  Only
  tiles with two neighbouring blocks that equal the blocks q further on are made;
  window hashes of P words, doubled from octave to octave, tell that for all q at
  once.  A tile owns about ``TILE`` words of blocks and overlaps one block to the
  left and three to the right.
* Tiles are solved on their own.  At a block's start a Z-function over the words
  ahead gives, for every q, how far the words there match those q further on, and
  whether the root is a power of a shorter word; one over the reversed words
  before gives the same to the left.  What is found is an interval fragment of
  matches, cut at one block on each side.
* Fragments are shuffled by document and period and overlapping or touching ones
  stitched to whole intervals by window functions.  Blocks of an interval that is
  long enough are neighbours, so nothing is lost between fragments.

Word equality is exact (words are numbered); hashes only choose tiles, and a tile
without a run yields none.  Batches of tiles flow from exploding to solving inside
a task; what is written and shuffled are fragments and the texts that have tiles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from . import arrays
from .token_counts import text_groups

#: Words of blocks that a tile owns, where its octave is smaller.
TILE = 256
#: Bytes of text whose words are numbered and hashed together.
GROUP = 1 << 19
LEAST, EXPONENT = 6, 4

_ROWS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("text", pa.string()), ("collapsed_sha256", pa.string()),
                   ("octave", pa.int64()), ("origin", pa.int64()), ("own", pa.int64()), ("blocks", pa.binary()), ("words", pa.binary())])
_FOUND = pa.schema([*list(_ROWS)[:5], ("period", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
_DDL = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, one after another with a number of its
    own between texts and at the end, and each text's first place."""
    known: dict[bytes, int] = {}
    parts, firsts, at = [], [], 0
    for i, text in enumerate(texts):
        words = text.split()
        for w in dict.fromkeys(words):
            known.setdefault(w, len(known))
        firsts.append(at)
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        parts.append(np.array([-1 - i]))
        at += len(words) + 1
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), np.array([*firsts, at], np.int64)


def tiles(numbers: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, int, int, int, np.ndarray, np.ndarray]]:
    """``(text, octave, origin, own, blocks, words)`` of every tile that may hold
    matches: its words start at ``origin`` in the text, ``own`` is the first
    word that it owns and ``blocks`` the starts of the blocks to look at, both from
    the tile's start.  Blocks are counted from the group's start, not the text's."""
    with np.errstate(over="ignore"):
        h = arrays.mix(numbers.astype(np.uint64) + np.uint64(1 << 32))
        longest = int(np.diff(firsts).max(initial=1)) - 1
        octave = 1
        while EXPONENT * octave <= longest:
            fill = arrays.mix(np.arange(-len(h) % octave, dtype=np.uint64))  # equal to no window but by chance
            grid = np.concatenate([h, fill]).reshape(-1, octave)
            whole = np.zeros(len(grid) + 1, bool)
            if len(grid) > 2:
                same = grid[1:] == grid[:-1, :1]  # block k against the windows q = octave .. 2 octave - 1 further on
                both = np.flatnonzero((same[1:] & same[:-1]).any(axis=1))
                whole[both] = whole[both + 1] = True
            starts = np.flatnonzero(whole) * octave
            if len(starts):
                size = max(octave, TILE)
                text = np.searchsorted(firsts, starts, "right") - 1
                cuts = np.flatnonzero(np.r_[True, (np.diff(text) != 0) | (np.diff(starts // size) != 0)])
                for a, b in zip(cuts, [*cuts[1:], len(starts)], strict=True):
                    i = int(text[a])
                    begin, end = int(firsts[i]), int(firsts[i + 1]) - 1
                    lo = max(begin, int(starts[a]) - octave)
                    hi = min(end, int(starts[b - 1]) + 4 * octave)
                    yield i, octave, lo - begin, int(starts[a]) - lo, starts[a:b] - lo, numbers[lo:hi]
            h = arrays.mix(h[:-octave] * np.uint64(3) + h[octave:]) if len(h) > octave else h[:0]
            octave *= 2


def z_function(s: list[int]) -> list[int]:
    """For every place of ``s``, how many elements from there equal those from its start."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _primes(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return [*out, q] if q > 1 else out


def solve(octave: int, blocks: list[int], words: list[int]) -> list[tuple[int, int, int]]:
    """``(period, first, last)`` of the match intervals of a tile's blocks (last
    exclusive, places in the tile), touching ones of a period joined."""
    found: dict[int, list[list[int]]] = {}
    for b in blocks:
        ahead = z_function(words[b:b + 4 * octave])
        periods = [q for q in range(octave, min(2 * octave, len(ahead))) if ahead[q] >= octave]
        # the root of a run is no power: no period q / prime over its q words
        periods = [q for q in periods if not any(ahead[q // p] >= q - q // p for p in _primes(q))]
        if not periods:
            continue
        before = words[max(0, b - octave):b][::-1]
        behind = z_function([*before, -1, *words[b:b + 2 * octave][::-1]])
        turn = len(before) + 1 + min(2 * octave, len(words) - b)  # one past the place of word b
        for q in periods:
            right = min(ahead[q] - octave, octave)
            left = min(behind[turn - q], octave) if before else 0
            if left < octave and right < octave and left + octave + right < max(LEAST, EXPONENT * q) - q:
                continue  # whole and too short
            first, last = b - left, b + octave + right
            spans = found.setdefault(q, [])
            if spans and first <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], last)
            else:
                spans.append([first, last])
    return [(q, a, z) for q, spans in found.items() for a, z in spans]


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for every text, and one for every tile."""
    for batch in batches:
        rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi, texts in text_groups(batch.column(2), GROUP):
            raw = [t.encode() for t in texts]
            numbers, firsts = word_numbers(raw)
            out = [(rows[lo + i], None, None, None, None, octave, origin, own, blocks.astype("<i4").tobytes(), words.astype("<i4").tobytes())
                   for i, octave, origin, own, blocks, words in tiles(numbers, firsts)]
            tiled = {r[0] for r in out}
            for i, (text, data) in enumerate(zip(texts, raw, strict=True)):
                row, n = rows[lo + i], int(firsts[i + 1] - firsts[i]) - 1
                mine = (row, ids[lo + i], n, *((text, None) if row in tiled else (None, _sha(b" ".join(data.split())))))
                out.append((*mine, *[None] * 5))
            yield _batch(out, _ROWS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as they are, tiles to fragments of matches."""
    for batch in batches:
        out = []
        for row, doc, n, text, sha, octave, origin, own, blocks, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if octave is None:
                out.append((row, doc, n, text, sha, None, None, None))
                continue
            places, numbers = np.frombuffer(blocks, "<i4").tolist(), np.frombuffer(words, "<i4").tolist()
            out += [(row, None, None, None, None, q, origin + a, origin + z) for q, a, z in solve(octave, places, numbers)]
        yield _batch(out, _FOUND)


def fragments(docs: DataFrame) -> DataFrame:
    """Written once: a row ``(row, doc_id, n, text, collapsed_sha256)`` for every row
    of ``docs`` (the text only where it was tiled, the digest where not), and a row
    ``(row, period, first, last)`` for every fragment; ``row`` numbers the rows."""
    found = (docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .mapInArrow(lambda batches: _solve(_explode(batches)), _ddl(_FOUND)))
    return stage(found, "fragments")


def stitch(found: DataFrame) -> DataFrame:
    """Fragments to runs: ``(row, period, start, length)``."""
    place = Window.partitionBy("row", "period").orderBy("first", "last")
    reach = F.max("last").over(place.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("_reach") >= F.col("first"), 0).otherwise(1)).over(place)
    length = F.col("last") - F.col("first") + F.col("period")
    return (found.where("period IS NOT NULL").withColumn("_reach", reach).withColumn("_island", island)
            .groupBy("row", "period", "_island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .select("row", "period", F.col("first").alias("start"), length.alias("length"))
            .where(F.col("length") >= F.greatest(F.lit(LEAST), EXPONENT * F.col("period"))))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run ``(start, length, period)`` repeats, joined by one space."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def summary(runs: list[tuple[int, int, int]]) -> tuple:
    """``(n_runs, start, length, period, exponent_milli, runs_sha256)`` of sorted runs."""
    listed = _sha("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode())
    if not runs:
        return 0, None, None, None, None, listed
    start, length, period = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    return len(runs), start, length, period, 1000 * length // period, listed


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
                     ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, text, sha, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs = [(r["start"], r["length"], r["period"]) for r in runs or []]
            out.append((doc, *summary(runs), sha if text is None else _sha(collapsed(text.encode().split(), runs))))
        yield _batch(out, _RESULT)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256)`` for every row of ``docs``: the run of greatest length over
    period (ties: smallest start, then period; none: nulls), the digest of all runs
    and that of the text without what runs repeat.  Words are what stands between
    ASCII white space.  Null texts are empty; ids may be null or repeat, equal rows
    are each given; other columns are ignored; an empty table gives none."""
    found = fragments(docs)
    runs = (stitch(found).groupBy("row")
            .agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs")))
    rows = found.where("period IS NULL").select("row", "doc_id", "text", "collapsed_sha256")
    tiled = rows.where("text IS NOT NULL").join(runs, "row", "left")
    plain = rows.where("text IS NULL").withColumn("runs", F.lit(None).cast(runs.schema["runs"].dataType))
    columns = ["doc_id", "text", "collapsed_sha256", "runs"]
    return tiled.select(*columns).unionByName(plain.select(*columns)).mapInArrow(_finish, _ddl(_RESULT))


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` with the text of every row whose id's CRC-32 ends in 0 made periodic
    from some word on: of n words, word i >= a becomes word ``a + (i - a) % p``, with
    g = CRC-32 // 10, a = g % n and p = 1 + (n - a) // (3 + g % 8).  Null ids stay."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    words = F.filter(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return (docs.withColumn("_g", F.floor(h / 10))
            .withColumn("_words", F.when(h % 10 == 0, words))
            .withColumn("_n", F.size("_words"))
            .withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
            .withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
            .withColumn("text", F.when(F.col("_n") > 0, F.array_join(F.transform(
                F.sequence(F.lit(0), F.col("_n") - 1),
                lambda i: F.get("_words", F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))), " "))
                .otherwise(F.col("text")))
            .drop("_g", "_words", "_n", "_a", "_p"))
