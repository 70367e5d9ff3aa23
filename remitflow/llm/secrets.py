"""Secrets in texts: fixed patterns, and random-looking strings by sliding-window entropy.

Base spans, leftmost and not overlapping per kind: ``assign`` (a key word, a separator and a value of
12 or more characters), ``access`` (18 or more), ``hex`` (16 or more).  A match that is too short is
dropped but has used up its characters.

Further spans (kind ``entropy``) come from candidate strings, the runs of one character class
(hexadecimal with capitals, or base64) that are long enough.  A window slides over the string; the
Shannon entropy of its characters is kept by incremental counts: one character enters, one leaves,
and the sum of c log c changes by two table look-ups.  Windows at or over the class's threshold are
merged into spans.  The allow-list is looked up in the parts of a candidate (cut at / = - _), not
the whole of it: a part with a listed word is cut out, only the word itself where ``LEAST_REST`` or more
characters of the part are left beside it, and so are rulers; what stands before and after them is
judged as any other string.  Strings of digits are numbers.  Strings without a digit may be words or
paths, so their windows need ``WORD_BITS``; random letters of one case do not reach that and stay.
Base spans are never suppressed.

Positions are code points, ends exclusive.  Null texts are empty and hold nothing; every row gives
one row; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import batched, column_or_empty, documents, text_slices

# The base patterns, their order and their shortest lengths.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is the whole maximal run
LEAST_VALUE, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "entropy")

# A key word needs one of these before it can match; most texts have none.
_KEY_WORD = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
_SLICE_BYTES = 8 << 20

Span = tuple[int, int, str]


@dataclass(frozen=True)
class EntropyClass:
    """A class of characters with its window, and the bits a character has at least in a secret."""

    pattern: str
    window: int
    bits: float


CLASSES = (EntropyClass(r"[0-9A-F]{24,}", 24, 3.2), EntropyClass(r"[A-Za-z0-9+/_=-]{24,}", 24, 4.0))
#: Words that mark public test values.
ALLOWED = (re.compile(r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]"),)
#: A part with such a word is a test value as a whole only if less than this is left beside the word.
LEAST_REST = 24
#: Bits of a character in a window of a string without digits: 24 letters with five pairs of equal ones reach it, words do not.
WORD_BITS = 4.16
_PART = re.compile(r"[^/=_-]+")
_RULER = re.compile(r"0123456789(?:ABCDEF)?|ABCDEFGHIJKLMNOPQRSTUVWXYZ|abcdefghijklmnopqrstuvwxyz")
_NUMBER, _DIGIT = re.compile(r"[0-9_=+/-]+"), re.compile(r"[0-9]")


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base patterns, by start, then kind in the order of ``KINDS``."""
    spans: list[Span] = []
    if _KEY_WORD.search(text):
        spans += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def random_windows(string: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Spans of ``string`` covered by windows whose characters have ``bits`` of entropy or more."""
    weight = [c * math.log2(c) if c else 0.0 for c in range(window + 1)]
    most = window * (math.log2(window) - bits)  # entropy >= bits  <=>  the sum of c log c <= this
    count: dict[str, int] = {}
    total, spans = 0.0, []
    for i, c in enumerate(string):
        n = count[c] = count.get(c, 0) + 1
        total += weight[n] - weight[n - 1]
        if i >= window:
            gone = string[i - window]
            n = count[gone] = count[gone] - 1
            total -= weight[n + 1] - weight[n]
        if i >= window - 1 and total <= most + 1e-9:
            begin = i - window + 1
            if spans and begin <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((begin, i + 1))
    return spans


def judged(string: str, allowed: tuple[re.Pattern, ...] = ALLOWED) -> Iterator[tuple[int, str]]:
    """What is left of ``string`` between its allowed parts and rulers, with the places."""
    out = []
    for m in _PART.finditer(string):
        words = [w.span() for a in allowed for w in a.finditer(m.group())]
        if words:
            rest = len(m.group()) - sum(b - a for a, b in words)
            out += [m.span()] if rest < LEAST_REST else [(m.start() + a, m.start() + b) for a, b in words]
    at = 0
    for a, b in sorted(out + [m.span() for m in _RULER.finditer(string)]):
        if a > at:
            yield at, string[at:a]
        at = max(at, b)
    if at < len(string):
        yield at, string[at:]


def entropy_spans(text: str, classes: tuple[EntropyClass, ...] = CLASSES, allowed: tuple[re.Pattern, ...] = ALLOWED) -> list[Span]:
    found: set[tuple[int, int]] = set()
    for kind in classes:
        for m in _compiled(kind.pattern).finditer(text):
            for begin, string in judged(m.group(), allowed):
                if len(string) >= kind.window and not _NUMBER.fullmatch(string):
                    bits = kind.bits if _DIGIT.search(string) else max(kind.bits, WORD_BITS)
                    found.update((m.start() + begin + a, m.start() + begin + b) for a, b in random_windows(string, kind.window, bits))
    merged: list[Span] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]), "entropy")
        else:
            merged.append((a, b, "entropy"))
    return merged


def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern)  # kept by the re module


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy of every row."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", _SLICE_BYTES):
            rows = []
            for doc, text in zip(part.column("doc_id").to_pylist(), column_or_empty(part.column("text"))):
                base, more = base_spans(text), entropy_spans(text)
                counts = [sum(kind == k for _, _, kind in base) for k in KINDS[:3]]
                rows.append((doc, *counts, hashlib.sha256(joined(base).encode()).hexdigest(),
                             joined(sorted(base + more, key=_order)), len(more)))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return batched(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        find, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long")


PLACEHOLDER = "[secret]"


def redacted_text(text: str) -> str:
    """``text`` with every span replaced; spans that overlap or touch are one."""
    spans = sorted((a, b) for a, b, _ in [*base_spans(text), *entropy_spans(text)])
    if not spans:
        return text
    out, at = [], 0
    for a, b in spans:
        if a > at or not out:
            out += [text[at:a], PLACEHOLDER]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text``; other columns, and null texts, stay as they are."""
    columns = docs.columns
    at = columns.index("text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", _SLICE_BYTES):
            texts = [x if x is None else redacted_text(x) for x in part.column("text").to_pylist()]
            yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return batched(docs).mapInArrow(replace, docs.schema)


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
