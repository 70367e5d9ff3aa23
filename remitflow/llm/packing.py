"""Best-fit packing of tokenised documents into fixed-length sequences by large-item matching.

Each document is its ids followed by one separator id; one longer than the capacity is cut into
pieces of the capacity and a rest.  Pieces above a third of the capacity ("large") go at most two to
a sequence: greedy matching gives each, largest first, the largest other large piece that still fits.
Smaller pieces, longest first, go into the fullest sequence with room (best fit).

Only lengths matter, and there are at most ``capacity`` different ones, so the plan is made on the
histogram of lengths (bounded by the capacity, however many documents there are) and covers all
documents together.  The plan says which ranks within a length go to which sequences; pieces are
numbered within their length in salted groups (no task holds a whole length) and joined to it.

Rows: null or empty texts are the separator alone; repeated rows are packed like any others; an
empty table gives no rows.  Columns beside ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from remitflow.llm.common import batched, column_or_empty, documents, stored, text_slices

CAPACITY = 2048
SEPARATOR = 0
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SLICE_BYTES = 4 << 20
_RANK_GROUP = 100_000  # pieces numbered by one task


def tokenised_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
                     separator: int = SEPARATOR) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from remitflow.llm.word_tokens import word_tokens

        tokens = word_tokens(vocabulary)
        tail = np.array([separator], dtype="<u4").tobytes()
        for part in text_slices(batches, "text", _SLICE_BYTES):
            rows: list[tuple] = []
            for doc, ids in zip(part.column("doc_id").to_pylist(), tokens.encode(column_or_empty(part.column("text")))):
                ids += tail
                for k, begin in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[begin:begin + 4 * capacity]
                    rows.append((doc, k, begin // 4, len(own) // 4, zlib.crc32(own)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return batched(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, _PIECES)


@dataclass(frozen=True)
class Slot:
    """Pieces of ``length`` with rank in [rank_from, rank_to): ``per`` to a sequence, one after the
    other, in the sequences from ``first``, beginning at ``offset``."""

    length: int
    rank_from: int
    rank_to: int
    first: int
    per: int
    offset: int


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Best-fit plan for ``histogram`` (pieces by length), the same for all pieces of a length."""
    slots: list[Slot] = []
    used = dict.fromkeys(histogram, 0)
    opened = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, how many)
    order: list[int] = []  # the rooms in ``gaps``, ascending

    def place(length: int, first: int, sequences: int, per: int, offset: int, pieces: int) -> None:
        slots.append(Slot(length, used[length], used[length] + pieces, first, per, offset))
        used[length] += pieces

    def leave(room: int, first: int, sequences: int) -> None:
        if room and sequences:
            if room not in gaps:
                gaps[room] = []
                bisect.insort(order, room)
            gaps[room].append((first, sequences))

    # Large pieces: the largest with the largest that fits beside it.
    left = {n: c for n, c in histogram.items() if 3 * n > capacity}
    sizes = sorted(left)
    while sizes:
        a = sizes[-1]
        if not left[a]:
            sizes.pop()
            continue
        i = bisect.bisect_right(sizes, capacity - a) - 1
        while i >= 0 and not left[sizes[i]]:
            sizes.pop(i)
            i -= 1
        b = sizes[i] if i >= 0 else None
        if b is None:
            count = left[a]
            place(a, opened, count, 1, 0, count)
            left[a] = 0
        elif b == a:
            count = (left[a] + 1) // 2
            pairs = left[a] // 2
            place(a, opened, count, 2, 0, left[a])
            leave(capacity - 2 * a, opened, pairs)
            leave(capacity - a, opened + pairs, count - pairs)
            left[a] = 0
            opened += count
            continue
        else:
            count = min(left[a], left[b])
            place(a, opened, count, 1, 0, count)
            place(b, opened, count, 1, a, count)
            left[a] -= count
            left[b] -= count
        leave(capacity - a - (b or 0), opened, count)
        opened += count
    # Smaller pieces, longest first, into the smallest sufficient room, else into new sequences.
    for length in sorted((n for n in histogram if 3 * n <= capacity), reverse=True):
        pieces = histogram[length]
        while pieces:
            i = bisect.bisect_left(order, length)
            if i < len(order):
                room = order[i]
                first, sequences = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room]
                    order.pop(i)
            else:
                room, first, sequences = capacity, opened, -(-pieces // (capacity // length))
                opened += sequences
            per = room // length
            full = min(sequences, pieces // per)
            if full:
                place(length, first, full, per, capacity - room, full * per)
                leave(room - per * length, first, full)
                pieces -= full * per
            rest = min(pieces, per) if full < sequences else 0
            if rest:
                place(length, first + full, 1, per, capacity - room, rest)
                leave(room - rest * length, first + full, 1)
                pieces -= rest
            leave(room, first + full + bool(rest), sequences - full - bool(rest))
    return slots


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = spark.createDataFrame(
        [(s.length, s.rank_from, s.rank_to, s.first, s.per, s.offset) for s in packing_plan(counts, capacity)] or [],
        "p_length long, p_from long, p_to long, p_first long, p_per long, p_offset long")
    groups = 1 + sum(counts.values()) // _RANK_GROUP
    rest = [c for c in pieces.columns]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*rest), F.lit(groups)))
    # Where a salt's ranks begin within its length: a running count over at most capacity x groups rows.
    sizes = salted.groupBy("length", "_salt").count()
    begins = sizes.withColumn("_begin", F.sum("count").over(
        Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)))
    begins = begins.select(F.col("length"), F.col("_salt"), F.coalesce("_begin", F.lit(0)).alias("_begin"))
    ranked = (salted.withColumn("_rank", F.row_number().over(
        Window.partitionBy("length", "_salt").orderBy(*rest)) - 1)
        .join(begins, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_begin")))
    # At most a few slots for each of `capacity` lengths: a bounded table.
    joined = ranked.join(F.broadcast(plan), (F.col("length") == F.col("p_length"))
                         & (F.col("_rank") >= F.col("p_from")) & (F.col("_rank") < F.col("p_to")))
    at = F.col("_rank") - F.col("p_from")
    return joined.select(*rest, (F.col("p_first") + F.floor(at / F.col("p_per"))).cast("long").alias("sequence_id"),
                         (F.col("p_offset") + (at % F.col("p_per")) * F.col("length")).cast("long").alias("offset"))


def best_fit_packing(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    return pack(stored(tokenised_pieces(docs, vocabulary, capacity), "pieces"), capacity)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir))
