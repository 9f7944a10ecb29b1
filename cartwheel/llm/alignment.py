"""Operator 12: alignment of two tokenizers, with corpus-wide counts of id pairs
behind a minimal perfect hash.

Both tokenizers cut the bytes of a space and the text.  Offsets where tokens of
both end cut them into groups; the tokens of A and of B in a group are linked, and
an id pair's count is the number of documents that hold it linked.

1. The first pass aligns blocks of documents (about ``BLOCK`` bytes, or one text)
   and writes them once, with each block's distinct pairs and in how many of its
   documents they are, by shard (``SHARDS`` by hash).
2. Each shard's distinct pairs get a minimal perfect hash; the pairs themselves are
   kept in the order of their index, so that every lookup is verified.
3. The blocks' counts of a shard are dealt to leaves, added up into dense vectors
   indexed by the hash, and the vectors summed by a tree of ``FAN`` branches.
4. Blocks look their pairs up at the shards, and a second pass re-aligns each block
   beside its pairs' counts.

A block is aligned in slices of about ``_SLICE`` tokens.  A block's texts and pairs and a shard's pairs (at most one ``SHARDS``-th of all id
pairs) bound the memory of a task; leaves are as many as keep a shard's requests
within ``FOLD`` vectors each.  The highest count of each id of A is a row an id of
its vocabulary, the only thing that passes through the driver.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import arrays, perfect_hash
from .bpe import byte_alphabet
from .token_counts import text_groups

BLOCK = 2 << 20
SHARDS = 256
FAN = 4
FOLD = 4
#: Bits of an id of B in a pair; 31 hold both.
BITS = 15
#: Links of a group beyond which its repeated ids are counted, not listed.
_MANY = 4096
#: Bytes (about) of chunks whose ids a worker keeps; it starts anew beyond.
KEPT = 56 << 20
#: Chunks that are encoded together.
_TOGETHER = 5000
#: Tokens of A (about, or one text) that are aligned at a time: an array over them is
#: one megabyte, and a task holds some dozens.
_SLICE = 1 << 17
#: Stands for chunks that are empty or have white space at an edge.
_APART = -2
#: White space in a row from which the slower library takes a text: the faster one's
#: pattern matcher runs out of its stack.
_ENDLESS = 100_000
_WHITE = re.compile(r"\s{%d}" % _ENDLESS)


_NONE = np.zeros(0, np.int32)


class Tokenizers:
    """Ids and the bytes they stand for under both tokenizers."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        import sentencepiece
        import tiktoken
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"] for x in spec["added_tokens"]}
        back = {c: b for b, c in byte_alphabet().items()}
        vocab = {i: bytes(back[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a_bytes = [vocab.get(i, b"") for i in range(max(vocab) + 1)]
        self.path = a_path
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={t: i for i, t in vocab.items()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        if len(self.b_bytes) > 1 << BITS or len(self.a_bytes) > 1 << (31 - BITS):
            raise ValueError("a pair of ids does not fit 31 bits")
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        self.splits = not any("▁" in p.lstrip("▁") for p in map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self._forget()
        # each id followed by what separates it from the next: same side, other side or group
        self.a_text = np.array([[f"{i}{s}" for i in range(len(self.a_bytes))] for s in ",|"], object)
        self.b_text = np.array([[f"{i}{s}" for i in range(len(self.b_bytes))] for s in ",;"], object)

    def _forget(self) -> None:
        self.chunks: dict[str, int] = {}
        self.kept_a, self.kept_b = arrays.Lists(), arrays.Lists()
        self.held = 0

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a non-null text under A (of a space and the text) and B; none where
        the bytes differ."""
        if not text:
            return _NONE, _NONE
        whole = " " + text
        if len(text) >= _ENDLESS and _WHITE.search(text):
            a = _library(self.path).encode(whole, add_special_tokens=False).ids
        else:
            a = self.a.encode_ordinary(whole)
        b = self.b.encode(text)
        a, data = np.array(a, np.int32), whole.encode()
        # A's tokens are bytes of the text by construction: their sum tells if one is missing
        if self.a_size[a].sum() != len(data) or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return _NONE, _NONE
        return a, np.array(b, np.int32)

    def _keep(self, chunks: list[str]) -> None:
        """Encode chunks as one text and cut its ids where they end."""
        a, b = self.encode(" ".join(chunks))
        if len(a):
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, chunks)), np.int64, len(chunks)) + 1)
            count_a, count_b = (np.diff(np.searchsorted(np.cumsum(size[ids]), ends, "right"), prepend=0)
                                for size, ids in ((self.a_size, a), (self.b_size, b)))
        else:  # one of them is not given back
            parts = [self.encode(c) for c in chunks]
            a, b = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            count_a, count_b = (np.array([len(p[i]) for p in parts], np.int64) for i in (0, 1))
        self.chunks.update(zip(chunks, range(self.kept_a.n, self.kept_a.n + len(chunks)), strict=True))
        self.kept_a.add(a, count_a), self.kept_b.add(b, count_b)
        self.held += 200 * len(chunks) + 4 * sum(map(len, chunks))

    def _known(self, chunks: list[str]) -> np.ndarray:
        """The number of each chunk's lists; ``_APART`` where it may not be encoded apart."""
        if self.held > KEPT:
            self._forget()
        at = np.fromiter(map(self.chunks.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(at == -1)
        fresh = [chunks[i] for i in new.tolist()]
        plain = [c for c in fresh if c and not c[0].isspace() and not c[-1].isspace()]
        for lo in range(0, len(plain), _TOGETHER):
            self._keep(plain[lo:lo + _TOGETHER])
        at[new] = np.fromiter(map(self.chunks.get, fresh, repeat(_APART)), np.int64, len(fresh))
        return at

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``encode`` of all texts: ids of A and their number in each text, and of B.
        Neither tokenizer has a token across a single space between two characters
        that are no white space, so texts with no other spaces are put together from
        their chunks, which are kept between calls."""
        chunks = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        doc = np.repeat(np.arange(len(texts)), chunks.value_lengths().to_numpy())
        numbered = chunks.flatten().dictionary_encode()
        at = self._known(numbered.dictionary.to_pylist())[numbered.indices.to_numpy()]
        apart = np.zeros(len(texts), bool) if self.splits else np.ones(len(texts), bool)
        apart[doc[at == _APART]] = True
        whole = [self.encode(texts[i]) for i in np.flatnonzero(apart).tolist()]
        a, b, kept = self.kept_a, self.kept_b, self.kept_a.n
        if whole:  # a text encoded whole is one list, after the kept ones
            rest = ~apart[doc]
            at = np.r_[at[rest], kept + np.arange(len(whole))]
            doc = np.r_[doc[rest], np.flatnonzero(apart)]
            order = np.argsort(doc, kind="stable")
            at, doc = at[order], doc[order]
            for i, x in enumerate((a, b)):
                x.add(np.concatenate([w[i] for w in whole]), np.array([len(w[i]) for w in whole], np.int64))
        # a text with a chunk that is not given back has no tokens
        lost = np.zeros(len(texts), bool)
        lost[doc[a.counts(at) == 0]] = True
        if lost.any():
            at, doc = at[~lost[doc]], doc[~lost[doc]]
        counts = [np.bincount(doc, x.counts(at), len(texts)).astype(np.int64) for x in (a, b)]
        found = a.taken(at), counts[0], b.taken(at), counts[1]
        a.drop(kept), b.drop(kept)
        return found


@lru_cache
def _library(path: str):
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


@lru_cache
def tokenizers(a_path: str, b_path: str, pattern: str) -> Tokenizers:
    """One per worker process."""
    return Tokenizers(a_path, b_path, pattern)


class Aligned:
    """The alignment of a list of texts: flat arrays over all of them.  ``ids`` is what
    ``encode_all`` gives for the texts, where it is known."""

    def __init__(self, made: Tokenizers, texts: list[str], ids: tuple | None = None):
        self.made = made
        self.a, self.n_a, self.b, self.n_b = ids or made.encode_all(texts)
        self.a, self.b = self.a.astype(np.int64), self.b.astype(np.int64)
        ends_a, ends_b = np.cumsum(made.a_size[self.a]), np.cumsum(made.b_size[self.b])
        cut = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, bool)
        cut[ends_a] = True
        other = np.zeros(len(cut), bool)
        other[ends_b] = True
        cut &= other
        before = np.cumsum(cut) - cut  # groups that end before an offset
        self.group_a, self.group_b = before[ends_a], before[ends_b]
        groups = int(cut.sum())
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        self.first_a, self.first_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        self.doc_a = np.repeat(np.arange(len(texts)), self.n_a)
        self.doc = self.doc_a[self.first_a]  # of each group
        self.n_groups = np.bincount(self.doc, minlength=len(texts))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair and number of links (a pair may come several times)."""
        product = self.size_a * self.size_b
        few = product <= _MANY
        times = np.where(few, self.size_b, 0)[self.group_a]
        i = np.repeat(np.arange(len(self.a)), times)
        nth = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
        j = self.first_b[self.group_a[i]] + nth
        docs, pairs, number = [self.doc_a[i]], [(self.a[i] << BITS) | self.b[j]], [np.ones(len(i), np.int64)]
        for g in np.flatnonzero(~few):
            a, x = np.unique(self.a[self.first_a[g]:self.first_a[g] + self.size_a[g]], return_counts=True)
            b, y = np.unique(self.b[self.first_b[g]:self.first_b[g] + self.size_b[g]], return_counts=True)
            pairs.append(((a[:, None] << BITS) | b).ravel())
            number.append((x[:, None] * y).ravel())
            docs.append(np.full(len(pairs[-1]), self.doc[g]))
        return np.concatenate(docs), np.concatenate(pairs), np.concatenate(number)

    def digests(self) -> list[str]:
        """SHA-256 of every text's groups as text; '' without tokens."""
        last_a = np.zeros(len(self.a), np.int64)
        last_a[self.first_a + self.size_a - 1] = 1
        last_b = np.zeros(len(self.b), np.int64)
        last_b[self.first_b + self.size_b - 1] = 1
        parts = np.empty(len(self.a) + len(self.b), object)
        parts[np.arange(len(self.a)) + self.first_b[self.group_a]] = self.made.a_text[last_a, self.a]
        parts[np.arange(len(self.b)) + (self.first_a + self.size_a)[self.group_b]] = self.made.b_text[last_b, self.b]
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append(hashlib.sha256("".join(parts[at:at + n].tolist())[:-1].encode()).hexdigest() if n else "")
            at += n
        return out


def aligned(made: Tokenizers, texts: list[str], most: int = _SLICE) -> Iterator[Aligned]:
    """The alignments of the texts in slices of about ``most`` tokens of A, or one text."""
    a, n_a, b, n_b = made.encode_all(texts)
    ends_a, ends_b = np.r_[0, np.cumsum(n_a)], np.r_[0, np.cumsum(n_b)]
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends_a, ends_a[lo] + most, "right")) - 1)
        yield Aligned(made, texts[lo:hi], (a[ends_a[lo]:ends_a[hi]], n_a[lo:hi], b[ends_b[lo]:ends_b[hi]], n_b[lo:hi]))
        lo = hi


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values, kind))


def _first_pass(a_path: str, b_path: str, pattern: str, block_bytes: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        made = tokenizers(a_path, b_path, pattern)
        for batch in batches:
            for lo, hi, texts in text_groups(batch.column(2), block_bytes):
                held = []
                for part in aligned(made, texts):
                    docs, pairs, _ = part.links()
                    held.append((np.unique((docs << 31) | pairs) & ((1 << 31) - 1)).astype(np.int32))  # each pair once a document
                pairs, counts = np.unique(np.concatenate(held), return_counts=True)
                shard = (arrays.mix(pairs.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                found, ends = np.unique(shard, return_counts=True)
                ends = np.cumsum(ends)
                n, m = hi - lo, len(found)
                block = batch.column(0)[lo].as_py()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n + m, block)),
                    pa.concat_arrays([batch.column(1).slice(lo, n), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([batch.column(2).slice(lo, n).fill_null(""), pa.nulls(m, pa.string())]),
                    pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(found, pa.int32())]),
                    pa.concat_arrays([pa.nulls(n, pa.list_(pa.int32())), _lists(pairs[order], ends, pa.int32())]),
                    pa.concat_arrays([pa.nulls(n, pa.list_(pa.int64())), _lists(counts[order], ends, pa.int64())]),
                ], names=["block", "doc_id", "text", "shard", "pairs", "counts"])
    return run


def _flat(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False)


def _hashed(table: pa.Table) -> pa.Table:
    """A shard's pairs: their perfect hash, and they themselves in its order."""
    pairs = table.column("pair").to_numpy()
    levels = perfect_hash.build(pairs)
    keys = np.empty(len(pairs), "<i4")
    keys[perfect_hash.lookup(levels, pairs)] = pairs
    return pa.table({"shard": table.column("shard").slice(0, 1), "levels": pa.array([levels], pa.list_(pa.binary())),
                     "keys": pa.array([keys.tobytes()], pa.binary())})


def _verified(levels: list[bytes], keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    at = perfect_hash.lookup(levels, pairs)
    if len(pairs) and ((at < 0).any() or (keys[at] != pairs).any()):
        raise ValueError("a pair is not among the hashed ones")
    return at


def _dense(requests: pa.Table, hashed: pa.Table) -> pa.Table:
    """A leaf's counts of a shard as a dense vector."""
    levels, keys = hashed.column("levels")[0].as_py(), np.frombuffer(hashed.column("keys")[0].as_py(), "<i4")
    vector = np.zeros(len(keys), "<i8")
    if requests.num_rows:
        np.add.at(vector, _verified(levels, keys, _flat(requests, "pairs")), _flat(requests, "counts"))
    return pa.table({"shard": hashed.column("shard"), "leaf": hashed.column("leaf"), "vector": pa.array([vector.tobytes()], pa.binary())})


def _added(vectors: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(v.as_py(), "<i8") for v in vectors.column("vector")], axis=0).astype("<i8")
    return pa.table({"shard": vectors.column("shard").slice(0, 1), "leaf": vectors.column("leaf").slice(0, 1),
                     "vector": pa.array([total.tobytes()], pa.binary())})


def _highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row ``(a, best)`` for every id of A in a shard."""
    for batch in batches:
        for keys, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.frombuffer(keys, "<i4").astype(np.int64) >> BITS
            best = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
            np.maximum.at(best, ids, np.frombuffer(vector, "<i8"))
            held = np.flatnonzero(best)
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(best[held])], names=["a", "best"])


def _answers(requests: pa.Table, counted: pa.Table) -> pa.Table:
    """The requests' pairs with their corpus-wide counts."""
    if not requests.num_rows:
        return pa.table({"block": pa.array([], pa.int64()), "pairs": pa.array([], pa.list_(pa.int32())), "totals": pa.array([], pa.list_(pa.int64()))})
    row = {n: counted.column(n)[0].as_py() for n in ("levels", "keys", "vector")}
    pairs = _flat(requests, "pairs")
    totals = np.frombuffer(row["vector"], "<i8")[_verified(row["levels"], np.frombuffer(row["keys"], "<i4"), pairs)]
    ends = np.cumsum(requests.column("pairs").combine_chunks().value_lengths().to_numpy())
    return pa.table({"block": requests.column("block"), "pairs": _lists(pairs, ends, pa.int32()), "totals": _lists(totals, ends, pa.int64())})


_RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _second_pass(a_path: str, b_path: str, pattern: str, best):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        columns = {n: [] for n in _RESULT}
        if texts.num_rows:
            known = _flat(answers, "pairs") if answers.num_rows else np.zeros(0, np.int32)
            totals = _flat(answers, "totals") if answers.num_rows else np.zeros(0, np.int64)
            order = np.argsort(known)
            known, totals = known[order].astype(np.int64), totals[order]
            parts = []
            for made in aligned(tokenizers(a_path, b_path, pattern), texts.column("text").to_pylist()):
                docs, pairs, number = made.links()
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                if len(pairs) and (not len(known) or (known[at] != pairs).any()):
                    raise ValueError("a pair of the second pass was not in the first")
                count = totals[at] if len(pairs) else np.zeros(0, np.int64)
                part = {"n_a": made.n_a, "n_b": made.n_b, "n_groups": made.n_groups, "groups_sha256": made.digests()}
                for name, values in {"n_links": number, "n_best": number * (count == best.value[pairs >> BITS]), "count_sum": number * count}.items():
                    part[name] = np.zeros(len(made.n_a), np.int64)
                    np.add.at(part[name], docs, values)
                parts.append(part)
            columns = {n: texts.column(n) if n == "doc_id" else np.concatenate([p[n] for p in parts]) for n in _RESULT}
        return pa.table({n: columns[n] if n == "doc_id" and texts.num_rows else pa.array(columns[n], pa.string() if n == "groups_sha256" else pa.int64())
                         for n in _RESULT})
    return run


def _by_leaf(requests: DataFrame, shards: DataFrame, leaves: int):
    """Requests beside their shard's row, both grouped by shard and leaf."""
    left = requests.withColumn("leaf", F.pmod(F.xxhash64("block"), F.lit(leaves)).cast("int"))
    right = shards.withColumn("leaf", F.explode(F.sequence(F.lit(0), F.lit(leaves - 1))))
    return left.groupBy("shard", "leaf").cogroup(right.groupBy("shard", "leaf"))


def pair_counts(requests: DataFrame) -> tuple[DataFrame, int]:
    """``(shard, levels, keys, vector)`` of blocks' ``(block, shard, pairs, counts)``:
    each shard's perfect hash, pairs and summed counts in its order, written once;
    and the number of leaves that keep a shard's requests within ``FOLD`` vectors."""
    pairs = requests.select("shard", F.explode("pairs").alias("pair")).distinct()
    hashed = stage(pairs.groupBy("shard").applyInArrow(_hashed, "shard int, levels array<binary>, keys binary"), "hashed")
    asked = requests.agg(F.sum(F.size("pairs"))).first()[0] or 0
    distinct = hashed.agg(F.sum(F.octet_length("keys")) / 4).first()[0] or 1
    leaves = left = max(1, -(-int(asked) // (FOLD * int(distinct))))
    vectors = _by_leaf(requests, hashed, leaves).applyInArrow(_dense, "shard int, leaf int, vector binary")
    while left > 1:
        left = -(-left // FAN)
        vectors = (vectors.withColumn("leaf", F.floor(F.col("leaf") / FAN).cast("int"))
                   .groupBy("shard", "leaf").applyInArrow(_added, "shard int, leaf int, vector binary"))
    return stage(hashed.join(vectors.drop("leaf"), "shard"), "counted"), leaves


def token_alignment(docs: DataFrame, a_path: str, b_path: str, pattern: str, block_bytes: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for
    every row of ``docs``.  A is a byte-level BPE file of the ``tokenizers`` library
    whose ids are in the order of its merges, with its pre-tokenizer's ``pattern``; B
    a sentencepiece model.  Texts that are null, empty or that one of the two does not
    give back byte for byte have no tokens: zeros and an empty digest.  Ids may be null
    or repeat, equal rows count as documents of their own; other columns are ignored;
    an empty table gives no rows."""
    paths = (a_path, b_path, pattern)
    staged = stage(docs.select(F.monotonically_increasing_id().alias("block"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                   .mapInArrow(_first_pass(*paths, block_bytes, shards), "block long, doc_id long, text string, shard int, pairs array<int>, counts array<long>"), "blocks")
    requests = staged.where("shard IS NOT NULL").select("block", "shard", "pairs", "counts")
    counted, leaves = pair_counts(requests)
    rows = (counted.select("keys", "vector").mapInArrow(_highest, "a long, best long")
            .groupBy("a").agg(F.max("best").alias("best")).collect())  # at most A's vocabulary
    best = np.zeros(max((r.a for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        best[r.a] = r.best
    answers = (_by_leaf(requests.drop("counts"), counted, leaves)
               .applyInArrow(_answers, "block long, pairs array<int>, totals array<long>"))
    texts = staged.where("shard IS NULL").select("block", "doc_id", "text")
    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in _RESULT)
    held = docs.sparkSession.sparkContext.broadcast(best)
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_second_pass(*paths, held), schema)
