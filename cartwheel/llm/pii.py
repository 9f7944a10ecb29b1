"""Operator 5: personal data by anchor expansion.

One Aho-Corasick pass finds anchors: the at sign, scheme marks, digits and
identifier cues.  From each, a deterministic local parser expands to the
boundaries of what it may belong to and validates that: an address to both sides
of an at sign, a stretch of digits and number punctuation for IP addresses, cards
and telephone numbers, a URL around its scheme mark, an account name after a
lone at sign, a secret after its cue.  Parsers look at the stretch around the
anchor only, and a stretch is parsed once, so a text costs time in proportion to
its length.  Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .token_counts import text_groups, uncollected

#: The kinds in the order of results; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
BASE = KINDS[:4]
#: What stands before a secret, in lower case.
CUES = ("password", "passwd", "secret", "token", "api_key", "api-key", "apikey")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMERIC = frozenset("0123456789. ()+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_NUMERIC = re.compile(r"[^0-9.\x20()+-]")
_NOT_DIGIT = re.compile("[^0-9]")
_NAME = re.compile(r"[A-Za-z0-9_]{3,30}(?![A-Za-z0-9_@])")
_URL = re.compile(r"[^\s<>\"'`|\\^{}\[\]]+")
#: A value in quotes ends at the closing one, any other at white space or a quote.
_VALUE = re.compile(r"[\x20]{0,3}[=:][\x20]{0,3}(?:\"([^\"\r\n]{8,})\"|'([^'\r\n]{8,})'|[\"']?([^\s\"']{8,}))")
#: ASCII letters only, where ``lower`` would move offsets.
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SPAN = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


@lru_cache
def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for mark in ("@", "://", *"0123456789"):
        a.add_word(mark, (mark[0] if mark[0] in "@:" else "0", len(mark)))
    for cue in CUES:
        a.add_word(cue, ("k", len(cue)))
    a.make_automaton()
    return a


def _email(text: str, at: int, floor: int) -> _SPAN | None:
    """Around the at sign at ``at``; the local part starts at ``floor`` or later."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1)
    return (start, domain.end()) if domain and start < at else None


def _numbers(text: str, lo: int, hi: int, out: dict[str, list[_SPAN]]) -> None:
    """Numbers in a stretch of digits and number punctuation."""
    for m in _IP.finditer(text, lo, hi):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text, lo, hi):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    for m in _PHONE.finditer(text, lo, hi):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out["phone"].append(m.span())


def find(text: str) -> dict[str, list[_SPAN]]:
    """Spans of every kind, by start."""
    out: dict[str, list[_SPAN]] = {k: [] for k in KINDS}
    email_end = number_end = url_end = secret_end = 0
    lowered = text.lower()
    if len(lowered) != len(text):
        lowered = text.translate(_LOWER)
    for last, (kind, length) in _automaton().iter(lowered):
        if kind == "0":
            if last < number_end:
                continue
            lo = last
            while lo > number_end and text[lo - 1] in _NUMERIC:
                lo -= 1
            stop = _NOT_NUMERIC.search(text, last)
            number_end = stop.start() if stop else len(text)
            _numbers(text, lo, number_end, out)
        elif kind == "@":
            if last < email_end:
                continue
            if span := _email(text, last, email_end):
                out["email"].append(span)
                email_end = span[1]
            elif last >= url_end and (last == 0 or not (text[last - 1].isalnum() or text[last - 1] in "._@/")) and (m := _NAME.match(text, last + 1)):
                out["account"].append((last, m.end()))
        elif kind == ":":
            mark = last - 2
            if mark < url_end:
                continue
            start = mark
            while start > url_end and mark - start < 20 and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
                start -= 1
            m = _URL.match(text, last + 1)
            if m and start < mark and text[start].isalpha():
                end = m.end()
                while end > last + 1 and text[end - 1] in ".,;:!?)":
                    end -= 1
                if end > last + 1:
                    out["url"].append((start, end))
                    url_end = end
        elif last >= secret_end:
            start = last - length + 1
            if (start == 0 or not text[start - 1].isalnum()) and (m := _VALUE.match(text, last + 1)):
                out["secret"].append(m.span(m.lastindex))
                secret_end = m.end()
    return out


def described(spans: dict[str, list[_SPAN]], kinds: tuple[str, ...] = KINDS) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


#: What redaction replaces: URLs and account names are public.
REDACTED = (*BASE, "secret")


def redact(text: str, spans: dict[str, list[_SPAN]]) -> str:
    """Spans replaced by their kind in angle brackets; of spans that overlap, the
    union is replaced, with the first one's kind."""
    merged: list[list] = []
    for a, b, k in sorted((a, b, k) for k in REDACTED for a, b in spans[k]):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, k])
    out, at = [], 0
    for a, b, k in merged:
        out += [text[at:a], f"<{k.upper()}>"]
        at = b
    return "".join(out) + text[at:]


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for every
    row of ``docs``.  Null texts are empty; ids may be null or repeat; other
    columns are ignored.  Needs no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with uncollected():
            for batch in batches:
                counts, digests, spans = [[] for _ in BASE], [], []
                for _, _, texts in text_groups(batch.column(1)):
                    for text in texts:
                        found = find(text)
                        for column, k in zip(counts, BASE, strict=True):
                            column.append(len(found[k]))
                        digests.append(hashlib.sha256(described(found, BASE).encode()).hexdigest())
                        spans.append(described(found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                    names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; every row and every
    other column stays as it is (a null text too)."""
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with uncollected():
            for batch in batches:
                texts = batch.column(at)
                new = [redact(t, find(t)) for _, _, group in text_groups(texts) for t in group]
                column = pa.array(new, pa.string(), mask=texts.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], column, *batch.columns[at + 1:]], names=names)

    return docs.mapInArrow(run, docs.schema)
