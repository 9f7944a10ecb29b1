"""Rank-synchronous byte-pair merging on ragged numpy arrays, and the token
counts and ids of whole texts built on it.

A batch of pre-tokens is one flat symbol array plus start offsets.  Each round
finds every sequence's lowest-rank adjacent pair and applies it at all its
places at once (left to right where places overlap); pairs made by a merge rank
higher than it, so this equals merging one at a time.  Finished sequences leave
the arrays.

Most words of a corpus repeat, so each different chunk (what stands between white
space) of a group of texts is merged once; a chunk's tokens never depend on its
neighbours.  Arrow splits the texts and numbers their different chunks, and a text's
ids are gathered from flat arrays by these numbers.  Files: the ``tokenizers`` JSON format.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import arrays

NONE = np.int32(2**31 - 1)
KEPT = 1 << 20  # bytes of different chunks that are merged together
_TOGETHER = 1 << 18  # chunks whose ids are put together at a time, or those of one text


def _classes(major: str, stop: int) -> str:
    """Regular-expression class body of a general category's code points."""
    points = [c for c in range(stop) if unicodedata.category(chr(c))[0] == major]
    out, lo = [], points[0]
    for a, b in zip(points, [*points[1:], None], strict=True):
        if b != a + 1:
            out.append(f"\\U{lo:08x}-\\U{a:08x}")
            lo = b
    return "".join(out)


@lru_cache
def patterns(stop: int = sys.maxunicode + 1) -> tuple[re.Pattern, re.Pattern]:
    """The pre-tokenizers' patterns in terms of ``re`` for code points below
    ``stop``: the byte-level one, and that of the tokenizer with word ends (with
    line feeds, which end chunks here).  Fixed values: the contractions, and white
    space as Unicode defines it."""
    letter, number = _classes("L", stop), _classes("N", stop)
    space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    short = "'s|'t|'re|'ve|'m|'ll|'d"
    other = f"[^{space}{letter}{number}]+"
    return (re.compile(f"{short}| ?[{letter}]+| ?[{number}]+| ?{other}|[{space}]+(?![^{space}])|[{space}]+"),
            re.compile(f"{short}|[{letter}]+|[{number}]|{other}|\\n"))


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the rest follows from code point 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Merger:
    """The merges of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        alphabet = byte_alphabet()
        self.first = np.array([vocab[alphabet[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[alphabet[b] + suffix] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 16) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        # a hash table of the pairs: most slots hold one, the rest are searched
        slots = self._slot(self.keys)
        self.table = np.zeros(1 << 18, np.int32)
        self.table[slots] = np.arange(len(slots))
        self.shared = np.bincount(slots, minlength=1 << 18) > 1

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key * 0x9E3779B1) >> 14) & 0x3FFFF

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 16) | b
        slot = self._slot(key)
        at = self.table[slot]
        found = self.keys[at] == key
        again = np.flatnonzero(self.shared[slot] & ~found)
        if len(again):
            at[again] = np.minimum(np.searchsorted(self.keys, key[again]), len(self.keys) - 1)
            found[again] = self.keys[at[again]] == key[again]
        return np.where(found, self.ranks[at], NONE)

    def merge(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their numbers, in order, of non-empty words given as
        UTF-8 bytes and end offsets."""
        sym = self.first[raw]
        lengths = np.diff(np.r_[0, ends])
        sym[ends - 1] = self.last[raw[ends - 1]]
        ids = np.arange(len(ends))
        done_ids, done_sym, done_len = [], [], []
        rank = np.full(len(sym), NONE, np.int32)
        if len(sym) > 1:
            rank[:-1] = self._rank(sym[:-1], sym[1:])
        rank[ends - 1] = NONE
        while len(ids):
            starts = np.cumsum(lengths) - lengths
            least = np.minimum.reduceat(rank, starts)
            live = least != NONE
            if not live.all():
                rows = np.repeat(~live, lengths)
                done_ids.append(ids[~live]), done_sym.append(sym[rows]), done_len.append(lengths[~live])
                rows = ~rows
                sym, rank, ids, lengths, least = sym[rows], rank[rows], ids[live], lengths[live], least[live]
                if not len(ids):
                    break
            owner = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
            at = np.flatnonzero(rank == least[owner])
            # of places that overlap (a run of one symbol), every other one from the left
            run = np.flatnonzero(np.r_[True, np.diff(at) > 1])
            if len(run) < len(at):
                at = at[(at - np.repeat(at[run], np.diff(np.r_[run, len(at)]))) % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            lengths = lengths - np.bincount(owner[at], minlength=len(ids))
            sym, rank, owner = sym[keep], rank[keep], owner[keep]
            new = at - np.arange(len(at))  # where the merged symbols stand now
            touched = np.zeros(len(sym), bool)
            touched[new] = True
            touched[new[new > 0] - 1] = True
            at = np.flatnonzero(touched)
            inside = at[at + 1 < len(sym)]
            inside = inside[owner[inside] == owner[inside + 1]]
            rank[at] = NONE
            rank[inside] = self._rank(sym[inside], sym[inside + 1])
        ids, sym, lengths = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_ids, done_sym, done_len))
        order = np.argsort(ids, kind="stable")
        starts = np.cumsum(lengths) - lengths
        flat = np.repeat(starts[order] - (np.cumsum(lengths[order]) - lengths[order]), lengths[order]) + np.arange(len(sym))
        return sym[flat], lengths[order]

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer("".join(words).encode("utf-8", "surrogatepass"), np.uint8)
        chars = np.flatnonzero((raw & 0xC0) != 0x80)
        ends = np.r_[chars, len(raw)][np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
        return self.merge(raw, ends)

    def merge_chunks(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their numbers of chunks whose words stand one after another,
        each chunk's last followed by a line feed."""
        stops = np.array([i for i, w in enumerate(words) if w == "\n"], np.int64)
        flat, lengths = self.merge_words([w for w in words if w != "\n"])
        return flat, np.diff(np.r_[0, np.cumsum(lengths)][stops - np.arange(len(stops))], prepend=0)


def _different(chunks: pa.Array, encoded) -> tuple[arrays.Lists, np.ndarray]:
    """The ids of the different ones of ``chunks``, and each chunk's place among them.
    ``encoded(some)`` gives chunks' flat ids, and how many each has."""
    numbered = chunks.dictionary_encode()
    texts, lists = numbered.dictionary, arrays.Lists()
    rank = np.zeros(len(texts), np.int32)
    plain = pc.match_substring_regex(texts, _PLAIN).to_numpy(zero_copy_only=False)
    for kind, rows in ((True, np.flatnonzero(plain)), (False, np.flatnonzero(~plain))):
        rank[rows] = lists.n + np.arange(len(rows))
        some = texts.take(pa.array(rows))
        for lo, hi in arrays.row_blocks(arrays.text_buffers(some)[1], KEPT):
            lists.add(*encoded(some.slice(lo, hi - lo).to_pylist(), kind))
    return lists, rank[numbered.indices.to_numpy()]


_SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"  # as str.isspace has them
_UNSAFE = rf"^ | $| [{_SPACES}]|[{_SPACES}] "
LATIN = 0x250
_PLAIN = "^[!-;=-~¡-ɏ]+$"  # below LATIN, no white space, no special string


def _bytes(flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
    raw, ends = flat.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def _sums(values: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Sums of the first ``numbers[0]`` values, of the next ``numbers[1]`` and so on."""
    return np.diff(np.r_[0, np.cumsum(values, dtype=np.int64)][np.r_[0, np.cumsum(numbers)]])


def _values(lists: arrays.Lists, at: np.ndarray, numbers: np.ndarray) -> list[bytes]:
    """The ids of texts that are so many chunks each; a few texts at a time."""
    out, ends = [], np.r_[0, np.cumsum(numbers)]
    for lo, hi in arrays.row_blocks(ends, _TOGETHER):
        some = at[ends[lo]:ends[hi]]
        out += _bytes(lists.taken(some), _sums(lists.counts(some), numbers[lo:hi]))
    return out


class ByteTokens:
    """Tokens of the byte-level tokenizer: numbers (``ids=False``), or their ids
    as little-endian uint32 bytes.  The special string is one token wherever it
    stands, as the library has it by default."""

    def __init__(self, path: str, ids: bool):
        self.merger, self.ids = Merger(path), ids
        with open(path, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        self.special = {x["content"]: x["id"] for x in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.pattern, self.latin = patterns()[0], patterns(LATIN)[0]

    def _apart(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of texts of any kind, and how many each has."""
        words, spans, known = [], [], {}
        for t in texts:
            parts = self.cut.split(t) if "<" in t else [t]
            mine = [w for p in parts for w in ([p] if p in self.special else self.pattern.findall(p))]
            spans.append(mine)
            words += mine
        listed = [w for w in dict.fromkeys(words) if w not in self.special]
        if listed:
            known = dict(zip(listed, _bytes(*self.merger.merge_words(listed)), strict=True))
        known |= {s: i.to_bytes(4, "little") for s, i in self.special.items()}
        raw = [b"".join([known[w] for w in mine]) for mine in spans]
        return np.frombuffer(b"".join(raw), "<u4").astype(np.int32), np.fromiter(map(len, raw), np.int64, len(raw)) // 4

    def _encoded(self, chunks: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of chunks with a space before them."""
        if plain:
            return self.merger.merge_chunks(self.latin.findall(" " + "\n ".join(chunks) + "\n"))
        return self._apart([" " + c for c in chunks])

    def __call__(self, texts: list[str]) -> list:
        """The value of every text."""
        column = pa.array(texts, pa.large_string())
        apart = pc.or_(pc.equal(pc.binary_length(column), 0), pc.match_substring_regex(column, _UNSAFE)).to_numpy(zero_copy_only=False)
        chunks = pc.split_pattern(column.filter(pa.array(~apart)), " ")
        numbers = np.ones(len(texts), np.int64)  # of a text's chunks; a text that is no chunks is one list
        numbers[~apart] = chunks.value_lengths().to_numpy()
        chunks, first = chunks.flatten(), np.cumsum(numbers) - numbers
        rest = np.ones(int(numbers.sum()), bool)
        rest[first] = False
        at = np.zeros(len(rest), np.int32)
        lists, at[rest] = _different(chunks.filter(pa.array(np.delete(rest, first[apart]))), self._encoded)
        # first chunks have no space before them
        at[first] = lists.n + np.arange(len(first))
        lists.add(*self._apart([t if whole else t.split(" ", 1)[0] for t, whole in zip(texts, apart.tolist(), strict=True)]))
        return _values(lists, at, numbers) if self.ids else _sums(lists.counts(at), numbers).tolist()


class WordTokens:
    """Ids (little-endian uint32 bytes) of the tokenizer with word ends.  New
    chunks of Latin letters, digits and punctuation are merged in a batch; any
    other chunk goes to the library itself, white space that is not ASCII included."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.merger = Merger(path)
        self.library = Tokenizer.from_file(path)
        self.latin = patterns(LATIN)[1]

    def _encoded(self, chunks: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        if plain:
            return self.merger.merge_chunks(self.latin.findall(("\n".join(chunks) + "\n").lower()))
        found = [self.library.encode(c, add_special_tokens=False).ids for c in chunks]
        return np.fromiter(chain.from_iterable(found), np.int32), np.fromiter(map(len, found), np.int64, len(found))

    def __call__(self, texts: list[str]) -> list[bytes]:
        chunks = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        numbers = chunks.value_lengths().to_numpy()
        lists, at = _different(chunks.flatten(), self._encoded)
        return _values(lists, at, numbers)


@lru_cache
def byte_tokens(path: str, ids: bool) -> ByteTokens:
    """One per worker process."""
    return ByteTokens(path, ids)


@lru_cache
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)
