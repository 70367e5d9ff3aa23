"""Vector bin packing of tokenised examples under simultaneous limits on tokens, segments and
loss-bearing tokens.

An example is the ids of its prompt (if there is one, without loss), those of its text and an end id (with loss).
What is left of an example is a vector of demands (tokens, one segment, loss-bearing tokens).  A sequence is
filled by the dot-product heuristic: of all that fit under the three limits together the one with the greatest
product of its demands and what is still free, each limit weighed by the mean demand for it.  When nothing
fits whole, the piece with the greatest product is cut off and fills the sequence.

Each task packs its own rows slice by slice and keeps what is less than a sequence's tokens for the next slice;
what is left at its end is packed with what other tasks left, in groups of bounded size, until one group
remains.  A sequence that a limit or the end of the examples leaves open is shortened to a power of two, which
needs no padding, and the rest goes on.

Rows: null or empty texts and prompts have no ids, so a row without either is the end id alone; repeated rows
are packed like any others; an empty table gives no rows.  Among equal products the example met first is
taken.  Very long texts are cut into as many pieces as they need.  Columns beside those named are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import batched, column_or_empty, documents, drop_stored, stored, text_slices

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END = 1
_SLICE_BYTES = 4 << 20
#: What tasks leave is packed in groups of about so many sequences.
GROUP_SEQUENCES = 256
_PLACED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                     ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()), ("loss_from", pa.int64())])
_PLACED_SQL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, sequence_id long, offset long, "
               "ids binary, loss_from long")
OUT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


class Packer:
    """Fills sequences from a pool of spans (example, start, length).

    The pool is kept by demand: spans of the same (tokens, loss-bearing tokens) are alike to the heuristic.
    """

    def __init__(self, limits: Limits):
        self.limits = limits
        self.loss_from: dict[int, int] = {}
        self.pooled = self.spans = 0  # tokens and spans in the pool
        self._at: dict[tuple[int, int], int] = {}
        self._stacks: list[list[tuple[int, int]]] = []
        self._tokens, self._loss, self._free = (np.zeros(64, dtype=np.int64) for _ in range(3))

    def _loss_of(self, example: int, start: int, length: int) -> int:
        return length - min(length, max(0, self.loss_from[example] - start))

    def add(self, example: int, start: int, length: int) -> None:
        key = (length, self._loss_of(example, start, length))
        k = self._at.get(key)
        if k is None:
            k = self._at[key] = len(self._stacks)
            if k == len(self._tokens):
                self._tokens, self._loss, self._free = (np.concatenate((x, np.zeros_like(x))) for x in (self._tokens, self._loss, self._free))
            self._stacks.append([])
            self._tokens[k], self._loss[k] = key
        self._stacks[k].append((example, start))
        self._free[k] += 1
        self.pooled += length
        self.spans += 1

    def _take(self, k: int) -> tuple[int, int]:
        self._free[k] -= 1
        self.pooled -= int(self._tokens[k])
        self.spans -= 1
        return self._stacks[k].pop()

    def _tidy(self) -> None:
        """Forget demands that no span has any more."""
        left = [(s, int(t)) for s, t in zip(self._stacks, self._tokens) if s]
        self.pooled = self.spans = 0
        self._at, self._stacks = {}, []
        self._free[:] = 0
        for stack, length in left:
            for example, start in stack:
                self.add(example, start, length)

    def _fill(self, weights: tuple[float, float]) -> list[tuple[int, int, int]]:
        room, segments, loss = self.limits.tokens, self.limits.segments, self.limits.loss
        inside: list[tuple[int, int, int]] = []
        while room and segments and self.spans:
            n = len(self._stacks)
            tokens, losses, there = self._tokens[:n], self._loss[:n], self._free[:n] > 0
            a, b = weights[0] * room, weights[1] * loss  # the segment's share is the same for all
            whole = there & (tokens <= room) & (losses <= loss)
            score = np.where(whole, a * tokens + b * losses, -1.0)
            k = int(score.argmax())
            if whole[k]:
                length = int(tokens[k])
                example, start = self._take(k)
            else:
                # The longest beginning of each that the limits still take.
                cut = np.where(there, np.minimum(np.minimum(tokens, room), tokens - losses + loss), 0)
                score = a * cut + b * np.maximum(cut - (tokens - losses), 0)
                k = int(np.where(cut > 0, score, -1.0).argmax())
                length = int(cut[k])
                if length <= 0:
                    break
                left = int(tokens[k]) - length
                example, start = self._take(k)
                self.add(example, start + length, left)
            inside.append((example, start, length))
            room -= length
            segments -= 1
            loss -= self._loss_of(example, start, length)
        return inside

    def sequences(self, flush: bool) -> Iterator[list[tuple[int, int, int]]]:
        """Sequences as lists of spans: full ones; with ``flush`` all that is left, too."""
        if not self.spans:
            return
        self._tidy()
        limits, n = self.limits, len(self._stacks)
        mean = [float((x[:n] * self._free[:n]).sum()) / self.spans for x in (self._tokens, self._loss)]
        weights = (mean[0] / limits.tokens ** 3, mean[1] / max(limits.loss, 1) ** 3)  # mean share x share x free share
        while self.spans and (flush or self.pooled >= limits.tokens):
            inside = self._fill(weights)
            used = sum(x[2] for x in inside)
            if used == limits.tokens:
                yield inside
                continue
            if not used:
                raise ValueError("the limits leave no room for a single token")
            excess = used - (1 << (used.bit_length() - 1))
            while excess:
                example, start, length = inside.pop()
                back = min(length, excess)
                self.add(example, start + length - back, back)
                if back < length:
                    inside.append((example, start, length - back))
                excess -= back
            yield inside


class _Examples:
    """The ids of examples that still have spans to place, and the rows of placed spans."""

    def __init__(self, limits: Limits, first_sequence: int):
        self.packer = Packer(limits)
        self.sequence = first_sequence
        self._known: dict[int, tuple] = {}  # doc_id, its tokens, ids from ``base`` on, base
        self._unplaced: dict[int, int] = {}
        self._next = 0

    def add(self, doc_id: int | None, ids: bytes, loss_from: int, doc_tokens: int | None = None, start: int = 0) -> None:
        length = len(ids) // 4
        i, self._next = self._next, self._next + 1
        self._known[i] = (doc_id, doc_tokens or length, ids, start)
        self._unplaced[i] = length
        self.packer.loss_from[i] = loss_from
        self.packer.add(i, start, length)

    def _row(self, i: int, start: int, length: int, sequence: int | None, offset: int | None, keep: bool) -> tuple:
        doc_id, doc_tokens, ids, base = self._known[i]
        own = ids[4 * (start - base):4 * (start - base + length)]
        self._unplaced[i] -= length
        loss, loss_from = self.packer._loss_of(i, start, length), self.packer.loss_from[i]
        if not self._unplaced[i]:
            del self._known[i], self._unplaced[i], self.packer.loss_from[i]
        return doc_id, start, length, zlib.crc32(own), doc_tokens, loss, sequence, offset, own if keep else None, loss_from

    def placed(self, flush: bool) -> pa.RecordBatch | None:
        rows = []
        for inside in self.packer.sequences(flush):
            offset = 0
            for i, start, length in inside:
                rows.append(self._row(i, start, length, self.sequence, offset, False))
                offset += length
            self.sequence += 1
        return _batch(rows)

    def left(self) -> pa.RecordBatch | None:
        """What no sequence has taken, with its ids."""
        rows = []
        for (length, _), k in self.packer._at.items():
            for i, start in self.packer._stacks[k]:
                rows.append(self._row(i, start, length, None, None, True))
        return _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch | None:
    if not rows:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _PLACED)], schema=_PLACED)


def _first(turn: int, group: int) -> int:
    """The first sequence number of a group (or task) of a turn."""
    return (turn << 56) | (group << 28)


def _in_tasks(docs: DataFrame, vocabulary: str, limits: Limits, end: int, prompt: str | None) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from remitflow.llm.word_tokens import word_tokens

        tokens, tail = word_tokens(vocabulary), np.array([end], dtype="<u4").tobytes()
        examples = _Examples(limits, _first(0, TaskContext.get().partitionId()))
        for part in text_slices(batches, "text", _SLICE_BYTES):
            texts = tokens.encode(column_or_empty(part.column("text")))
            heads = tokens.encode(column_or_empty(part.column("prompt"))) if prompt else [b""] * len(texts)
            for doc, head, ids in zip(part.column("doc_id").to_pylist(), heads, texts):
                examples.add(doc, b"".join((head, ids, tail)), len(head) // 4)
            if (rows := examples.placed(False)) is not None:
                yield rows
        if (rows := examples.left()) is not None:
            yield rows

    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string")] + ([F.col(prompt).cast("string").alias("prompt")] if prompt else [])
    return batched(docs).select(*columns).mapInArrow(pack, _PLACED_SQL)


def _together(left: DataFrame, groups: int, turn: int, limits: Limits, flush: bool) -> DataFrame:
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        examples = _Examples(limits, _first(turn, key[0].as_py()))
        rows = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending"), ("length", "ascending")])
        for doc, start, tokens, ids, loss_from in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids", "loss_from"))):
            examples.add(doc, ids, loss_from, tokens, start)
        parts = [b for b in (examples.placed(flush), examples.left()) if b is not None]
        return pa.Table.from_batches(parts, schema=_PLACED)

    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "length"), F.lit(groups)) if groups > 1 else F.lit(0).cast("long")
    return left.withColumn("_group", group).groupBy("_group").applyInArrow(pack, _PLACED_SQL)


def vector_packing(docs: DataFrame, vocabulary: str = VOCABULARY, limits: Limits = Limits(), end: int = END, prompt: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    ``prompt`` names a column whose ids come first and bear no loss.
    """
    done = [stored(_in_tasks(docs, vocabulary, limits, end, prompt), "packed")]
    turn = 0
    while True:
        turn += 1
        left = done[-1].where("sequence_id IS NULL")
        tokens = left.agg(F.sum("length")).first()[0]
        if not tokens:
            break
        # A group leaves less than a sequence's tokens, so turns get smaller; the last one, a single group, closes all.
        groups = -(-tokens // (GROUP_SEQUENCES * limits.tokens))
        done.append(stored(_together(left, groups, turn, limits, groups == 1), "packed"))
    last = done.pop() if len(done) > 1 and not done[-1].take(1) else None
    if last is not None:
        drop_stored(last)
    return reduce(DataFrame.unionByName, [d.where("sequence_id IS NOT NULL") for d in done]).select(*OUT)


def op12_instruction_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing(documents(spark, sf_dir))
