"""Operator 13: periodic runs, against the definition."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import periodic_runs

from .conftest import ODD, words


def runs_of(w):
    """Every run by its definition: (start, length, period)."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        at = 0
        while at + q < len(w):
            end = at
            while end + q < len(w) and w[end] == w[end + q]:
                end += 1
            length = end - at + q
            if length >= max(6, 4 * q):
                part = w[at:at + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((at, length, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(text):
    w = words(text)
    runs = runs_of(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def rewritten(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return text
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[i if i < a else a + (i - a) % p] for i in range(n))


def check(got, rows):
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(i, *expected(t)) for i, t in rows], key=str)


def texts(seed=3):
    rng = random.Random(seed)
    out = []
    for _ in range(120):  # few letters: many short runs, powers and overlaps
        out.append(" ".join(rng.choice("ab") for _ in range(rng.randrange(60))))
    for _ in range(60):  # runs of random roots between random words
        parts = []
        for _ in range(rng.randrange(1, 5)):
            root = [rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 15, 16, 17, 31, 33, 64, 100]))]
            n = rng.randrange(2 * len(root), 9 * len(root))
            parts += (root * 9)[:n] + [rng.choice("abcdefgh") for _ in range(rng.randrange(20))]
        out.append(" ".join(parts))
    a, b = "a", "ab"
    for _ in range(11):  # Fibonacci words: runs of every scale, none of them long enough, and their powers
        a, b = b, b + a
    out += [" ".join(b), " ".join(b[:34] * 6), " ".join(b[:55] * 4 + "x" + b[:55] * 5)]
    return out


def test_runs_equal_the_definition(spark, docs):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(texts())]]
    rows += [(900, "a " * 700), (901, "a\x0bb\x0cc " * 300), (902, "a\xa0b a\x85b " * 9), (903, "x " * 5), (904, "x " * 6), (905, "é ü " * 4)]
    check(periodic_runs.periodic_runs(docs(rows)), rows)
    assert periodic_runs.periodic_runs(docs([])).collect() == []


@pytest.mark.parametrize("tile", [1, 7, 64])
def test_tiles_of_any_size_give_the_same(monkeypatch, tile):
    monkeypatch.setattr(periodic_runs, "TILE", tile)
    group = [t.encode() for t in texts(tile)]
    numbers, firsts = periodic_runs.word_numbers(group)
    spans: dict = {}
    for i, octave, origin, own, blocks, part in periodic_runs.tiles(numbers, firsts):
        assert 0 <= own <= octave and len(part) <= max(tile, octave) + 5 * octave
        for q, a, z in periodic_runs.solve(octave, blocks.tolist(), part.tolist()):
            spans.setdefault((i, q), []).append((origin + a, origin + z))
    found = {i: [] for i in range(len(group))}
    for (i, q), parts in spans.items():
        last = None
        for a, z in sorted(parts):
            if last and a <= last[1]:
                last[1] = max(last[1], z)
            else:
                last = [a, z]
                found[i].append((last, q))
    for i, text in enumerate(group):
        mine = sorted([(a, z - a + q, q) for (a, z), q in found[i] if z - a + q >= max(6, 4 * q)], key=lambda r: (r[0], r[2]))
        assert mine == runs_of(words(text.decode()))


def test_z_function():
    assert periodic_runs.z_function([]) == []
    rng = random.Random(1)
    for _ in range(50):
        s = [rng.randrange(2) for _ in range(rng.randrange(1, 40))]
        assert periodic_runs.z_function(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def test_rewritten_documents_equal_the_definition(spark, docs):
    rows = [(i, " ".join(f"w{j * j % 97}" for j in range(i))) for i in range(150)] + [(None, "a b c"), (27, None), (1, "\x1fa b")]
    got = periodic_runs.planted(docs(rows))
    assert got.columns == docs(rows).columns
    assert {r.text for r in got.collect()} == {rewritten(i, t) for i, t in rows}
    check(periodic_runs.periodic_runs(got), [(i, rewritten(i, t)) for i, t in rows])


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.length("text") < 6000)
    rows = [(r.doc_id, rewritten(r.doc_id, r.text)) for r in table.collect()]
    check(periodic_runs.periodic_runs(periodic_runs.planted(table)), rows)
