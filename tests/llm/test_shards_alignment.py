"""Operators 11 and 12: shards and alignment, against their definitions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwheel.llm import alignment, perfect_hash, rendezvous

from .conftest import ODD

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ shards
def shard_of(key, weights):
    name = "null" if key is None else f"k{key}"
    u = [(int(hashlib.md5(f"{s}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13 for s in range(len(weights))]
    return min(range(len(weights)), key=lambda s: -math.log(u[s]) / weights[s])


def expected_slots(rows, weights, grown=1.0):
    out, taken = [], Counter()
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, len((r[1] or "").encode()), zlib.crc32((r[1] or "").encode()))):
        s = shard_of(i, weights)
        data = (t or "").encode()
        out.append((i, len(data) + 1, zlib.crc32(data), "key", s, taken[s], shard_of(i, [*weights, grown])))
        taken[s] += 1
    return out


@pytest.mark.parametrize("weights", [[1.0] * 16, [1.0], [0.5, 2.0, 3.5]])
def test_slots_equal_the_definition(spark, docs, weights):
    rows = [*ODD, *[(100 + i, f"text {i % 7}") for i in range(200)], *[(5000, "a copy")] * 90, *[(None, None)] * 40]
    got = rendezvous.shard_slots(docs(rows), weights=weights, grown_weight=1.5)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected_slots(rows, weights, 1.5), key=str)


def test_slots_of_no_rows(spark, docs):
    assert rendezvous.shard_slots(docs([])).collect() == []
    with pytest.raises(ValueError):
        rendezvous.rendezvous(F.lit("a"), [1.0, 0.0])


def test_weights_rule_the_shares_and_growth_only_adds(spark):
    keys = spark.range(20000)
    old, new = [1.0, 2.0, 5.0], [1.0, 2.0, 5.0, 2.0]
    rows = rendezvous.with_shards(rendezvous.with_shards(keys, "id", old, "old"), "id", new, "new").collect()
    share = Counter(r.old for r in rows)
    assert all(abs(share[s] / 20000 - w / 8) < 0.015 for s, w in enumerate(old))
    moved = [r for r in rows if r.old != r.new]
    assert {r.new for r in moved} == {3} and abs(len(moved) / 20000 - 0.2) < 0.015
    heavier = rendezvous.with_shards(keys, "id", [1.0, 4.0, 5.0], "s").collect()
    assert {h.s for h, r in zip(heavier, rows) if h.s != r.old} == {1}


def test_written_shards_hold_whole_rows(spark, docs, tmp_path):
    rows = [(i, f"text {i}") for i in range(50)] + [(None, None)]
    rendezvous.write_shards(docs(rows), "doc_id", [1.0] * 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(((r.doc_id, r.text, r.shard) for r in back.collect()), key=str) == \
        sorted([(i, t, shard_of(i, [1.0] * 4)) for i, t in rows], key=str)
    assert set(docs(rows).columns) < set(back.columns)


# --------------------------------------------------------------- alignment
def brute(rows):
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    back = {c: i for i, c in alignment.byte_alphabet().items()}
    a_bytes = lambda i: bytes(back[c] for c in a.id_to_token(i))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    found, held = [], defaultdict(int)
    for doc_id, text in rows:
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(map(a_bytes, x)) != whole or b"".join(map(b_bytes, y)) != whole:
            x, y = [], []
        groups, left, right, i, j, at_a, at_b = [], [], [], 0, 0, 0, 0
        while i < len(x) or j < len(y):
            if at_a <= at_b:
                at_a += len(a_bytes(x[i]))
                left.append(x[i])
                i += 1
            else:
                at_b += len(b_bytes(y[j]))
                right.append(y[j])
                j += 1
            if at_a == at_b:
                groups.append((left, right))
                left, right = [], []
        links = [(p, q) for g, h in groups for p in g for q in h]
        for pair in set(links):
            held[pair] += 1
        found.append((doc_id, x, y, groups, links))
    best = defaultdict(int)
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    for doc_id, x, y, groups, links in found:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        yield (doc_id, len(x), len(y), len(groups), len(links), sum(held[k] == best[k[0]] for k in links),
               sum(held[k] for k in links), hashlib.sha256(text.encode()).hexdigest() if x else "")


HARD = ["a▁b", " lead", "trail ", "two  spaces", "\t\n\r tabs", "<|endoftext|> <s> </s> <unk>", "日本語 text ½ ﬁ", "é combining", "aaaaaaaaaaaaaaaaaaaaaaaaaaa" * 300,
        "'tis DON'T it's", "😀 emoji 👩‍👩‍👧", "\x00 nul \x1c", " " * 500, "1234567890" * 50, "----====----" * 40, "　wide\xa0space"]


def check(got, rows):
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("block, fold, shards", [(alignment.BLOCK, alignment.FOLD, alignment.SHARDS), (2000, 1, 3)])
def test_alignment_equals_the_definition(spark, docs, monkeypatch, block, fold, shards):
    monkeypatch.setattr(alignment, "FOLD", fold)
    monkeypatch.setattr(alignment, "FAN", 2)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(40)
    rows = [*ODD, *[(200 + i, t) for i, t in enumerate(HARD)], *[(r.doc_id + 1000, r.text) for r in table.collect()]]
    check(alignment.token_alignment(docs(rows).repartition(3), A_PATH, B_PATH, P.PATTERN, block, shards), rows)


def test_alignment_of_nothing(spark, docs):
    made = lambda rows: alignment.token_alignment(docs(rows), A_PATH, B_PATH, P.PATTERN).collect()
    assert made([]) == []
    assert [tuple(r) for r in made([(1, None)])] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_large_groups_are_counted_not_listed(monkeypatch):
    made = alignment.Tokenizers(A_PATH, B_PATH, P.PATTERN)
    totals = []
    for many in (alignment._MANY, 0):
        monkeypatch.setattr(alignment, "_MANY", many)
        docs, pairs, number = alignment.Aligned(made, ["".join(h) for h in HARD]).links()
        total = Counter()
        for d, p, n in zip(docs.tolist(), pairs.tolist(), number.tolist()):
            total[d, p] += n
        totals.append(total)
    assert totals[0] == totals[1]


def test_endless_white_space_goes_to_the_library():
    made = alignment.Tokenizers(A_PATH, B_PATH, P.PATTERN)
    library = Tokenizer.from_file(A_PATH)
    for text in ("x" + " " * 1_500_000 + "y", "\n" * 120_000):
        assert made.encode(text)[0].tolist() == library.encode(" " + text, add_special_tokens=False).ids


def test_texts_put_together_from_chunks_equal_whole_ones(monkeypatch, spark):
    made = alignment.Tokenizers(A_PATH, B_PATH, P.PATTERN)
    assert made.splits
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(200).collect()
    texts = [r.text for r in table] + HARD + ["a\nb c", "a \nb", "a\n b", "x\xa0y z", "\x1c a", "a b\n", "\na b", "it 's 'tis", "1 2 ½ ٣", "ok a▁b ok"]

    def lists(a, n_a, b, n_b):
        return [(x.tolist(), y.tolist()) for x, y in zip(np.split(a, np.cumsum(n_a)[:-1]), np.split(b, np.cumsum(n_b)[:-1]))]
    whole = [tuple(x.tolist() for x in made.encode(t)) for t in texts]
    assert lists(*made.encode_all(texts)) == whole and lists(*made.encode_all(texts)) == whole
    monkeypatch.setattr(alignment, "KEPT", 0)
    assert [x for t in texts for x in lists(*made.encode_all([t]))] == whole
    assert lists(*made.encode_all([""])) == [([], [])]


def test_a_block_is_aligned_in_slices():
    """Some dozen arrays over a whole block made op12's workers too large."""
    import tracemalloc
    made = alignment.Tokenizers(A_PATH, B_PATH, P.PATTERN)
    texts = [w + " of the same words" * 40 for w in HARD] * 60 + ["", "x " * 300_000]
    made.encode_all(texts)
    whole, parts = alignment.Aligned(made, texts), list(alignment.aligned(made, texts, 1000))
    assert len(parts) > 100 and sum((p.digests() for p in parts), []) == whole.digests()
    assert [n for p in parts for n in p.n_groups.tolist()] == whole.n_groups.tolist()
    assert sum(int(p.links()[2].sum()) for p in parts) == int(whole.links()[2].sum())
    del whole, parts
    out = alignment._first_pass(A_PATH, B_PATH, P.PATTERN, alignment.BLOCK, 4)
    table = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(range(500)), pa.array([" ".join(["over and", "under it"] * 250)] * 500)],
                                       names=["block", "doc_id", "text"])
    list(out(iter([table])))  # kept from now on
    tracemalloc.start()
    list(out(iter([table])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50 << 20, most  # 36 MB; 77 before


@pytest.mark.parametrize("n", [0, 1, 2, 9, 1000, 50_000])
def test_perfect_hash(n):
    rng = random.Random(n)
    keys = np.array(rng.sample(range(1 << 31), n), np.int64)
    levels = perfect_hash.build(keys)
    assert sorted(perfect_hash.lookup(levels, keys).tolist()) == list(range(n))
    assert perfect_hash.lookup(levels, np.array([5, 6], np.int64)).max(initial=-1) < max(n, 1)
