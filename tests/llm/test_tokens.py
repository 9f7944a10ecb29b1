"""Operators 4, 7 and 9: tokens and packing, against the library and round trips."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from cartwheel.llm import best_fit, bpe, packed_output, token_counts

from .conftest import ODD

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
HARD = ["", " ", "  a  b ", " x", "x ", "a\n b\n\n c\n", "foo<|endoftext|>bar <|endoftext|> b", "<|endoftext|>", "Σας ΣΑΣ İstanbul ǅ", "aaaaaaaaaaa aaaa",
        "日本語 text１２ ½¾ ²", "a\x1cb c\x85d\xa0e f", "it's we'll 'tis DON'T", "ẹ́ x", "tab\tand\x0bvt", "emoji 😀😀!", "<|startoftext|>a", "a < b <| c"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return [r.text for r in rows] + HARD


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_equal_the_library(texts, path):
    made = bpe.ByteTokens(path, True) if path == BYTE else bpe.WordTokens(path)
    library = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in made(texts)] == library


def test_counts_survive_a_full_dictionary(texts, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 5000)
    made = bpe.ByteTokens(BYTE, False)
    library = [len(e.ids) for e in Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)]
    assert [n for i in range(0, len(texts), 7) for n in made(texts[i:i + 7])] == library


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_workers_keep_no_chunks(path):
    """Chunks are numbered by Arrow in large groups; a dictionary of them in Python cost
    time for each chunk and stayed in the worker."""
    import tracemalloc
    made = bpe.ByteTokens(path, True) if path == BYTE else bpe.WordTokens(path)
    first = made(["some words to start"])
    texts = [" ".join(f"{random.Random(i * 1000 + j).getrandbits(40):x}" for j in range(1000)) for i in range(40)]
    tracemalloc.start()
    found = made(texts)
    del found
    left = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert left < 1 << 20, left
    assert made(["some words to start"]) == first and token_counts.GROUP >= 8 << 20


def test_token_counts(spark, docs):
    rows = ODD + [(100 + i, t) for i, t in enumerate(HARD)]
    library = Tokenizer.from_file(BYTE)
    got = sorted(map(tuple, token_counts.token_counts(docs(rows), BYTE, limit=100).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t in rows]
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(docs([]), BYTE).collect() == []


def document_ids(text):
    return Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids + [0]


def test_packing_round_trip(spark, docs):
    rows = ODD + [(100 + i, t) for i, t in enumerate(HARD)]
    capacity = 64
    got = best_fit.pack_documents(docs(rows), WORD, capacity, keep_ids=True).collect()
    pieces = sorted(((r.doc_id, r.piece, r.start, r.length, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=str)
    want = []
    for i, t in rows:
        ids = document_ids(t)
        want += [(i, k, at, len(ids[at:at + capacity]), ids[at:at + capacity]) for k, at in enumerate(range(0, len(ids), capacity))]
    assert pieces == sorted(want, key=str)
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in got)
    check_places(got, capacity)
    assert best_fit.pack_documents(docs([]), WORD).collect() == []


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def brute_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_assignments_equal_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else capacity // 3 for _ in range(rng.choice([1, 20, 300]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = best_fit.assignments(counts, capacity)
    used = {}
    for k, (n, first_rank, first, each, offset) in enumerate(plan.tolist()):
        last = plan[k + 1][1] if k + 1 < len(plan) and plan[k + 1][0] == n else counts[n]
        for rank in range(first_rank, last):
            nth = rank - first_rank
            used.setdefault(first + nth // each, []).append((offset + nth % each * n, n))
    for places in used.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in used.values()) == brute_best_fit(lengths, capacity)


def test_ranks_in_several_shards(spark, docs, monkeypatch):
    monkeypatch.setattr(best_fit, "SHARD_ROWS", 3)
    got = best_fit.pack_documents(docs([(i, "a b c") for i in range(50)] + [(90, "a b")]), WORD, 9).collect()
    check_places(got, 9)
    assert len(got) == 51 and len({r.sequence_id for r in got}) == 26


@pytest.mark.parametrize("seed", range(4))
def test_tree_packs_as_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 100])
    lengths = [rng.randint(1, capacity) for _ in range(200)]
    rows = packed_output.best_fit_decreasing(np.array(lengths), capacity)
    assert sorted(i for r in rows for i in r) == list(range(200))
    assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == brute_best_fit(lengths, capacity)


def test_packed_files_round_trip(spark, docs, tmp_path):
    rows = ODD + [(100 + i, t) for i, t in enumerate(HARD)]
    target, capacity = str(tmp_path / "packed"), 128
    packed_output.write_packed(docs(rows), target, BYTE, capacity=capacity)
    library = Tokenizer.from_file(BYTE)
    pieces = sorted(((r.doc_id, r.piece, r.start, list(r.ids)) for r in packed_output.unpacked(spark, target).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [50256]
        want += [(i, k, at, ids[at:at + capacity]) for k, at in enumerate(range(0, len(ids), capacity))]
    assert pieces == sorted(want, key=str)
    check_places(packed_output.piece_digests(spark, target).collect(), capacity)
    for r in spark.read.parquet(target).collect():
        assert len(r.ids) == 2 * capacity and r.cu_seqlens[0] == 0 and list(r.position_resets) == list(r.cu_seqlens)[:-1]
    empty = str(tmp_path / "empty")
    packed_output.write_packed(docs([]), empty, BYTE)
    assert packed_output.piece_digests(spark, empty).collect() == []
