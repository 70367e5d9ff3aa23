"""Repeated runs of lines, found by winnowing.

Lines are what stands between newlines.  A run of consecutive lines counts when it has ``run`` lines or more, or
``words`` words or more (words: what ASCII white space separates).  A run that counts and occurs again, in the same
document or in one with a larger doc_id, is deleted where it occurs later; all runs are judged on the
input.  Put per window, the shortest runs that count (``run`` lines; fewer lines that hold ``words`` words): its
first occurrence, by (doc_id, line), stays, and every line of its other occurrences goes.  Longer runs are the
union of their windows.

Winnowing.  Every line has a hash; of each window the smallest hash (the leftmost of equal ones) is selected, so
any two equal windows share a selected line at the same place.  Each selected line is written once, with the
windows that selected it and the digests of the lines that these reach.  Positions are joined on the hash:
lines that are selected once in the corpus are done with.  Around each other position the match is extended to both
sides over the lines of its windows, by the digests (128 bits) of these lines: where a whole window is matched,
its later occurrences are deleted.  No pairs of occurrences are formed.

A line or window that a large part of all positions share (more than a ``_HOT``th of them, so there are few) is told apart by a broadcast table and takes no part in the shuffled joins.

Rows: null texts have no lines, empty texts one empty line; texts without a window stay as they are, and so
do rows without a doc_id, which no other row is compared with.  Rows with the same doc_id and text are one document
and fare alike; different texts under one doc_id are ordered by a hash of the text.  Of equal hashes in a window
the leftmost is selected.  Very long texts are read whole, a slice each.  An empty table gives no rows.  Other
columns are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import batched, column_or_empty, documents, drop_stored, stored, text_slices

RUN, WORDS = 3, 20
_HOT, _HOT_ROWS = 5_000, 1_000
_SLICE_BYTES = 8 << 20
_DIGEST = 16
_SELECTED = "doc_id long, version long, fp long, at int, lead int, shapes long, near binary"


def shapes(run: int) -> list[tuple[int, int]]:
    """(lines before the selected one, lines) of every window that can select a line; its place is its bit."""
    return [(before, size) for size in range(1, run + 1) for before in range(size)]


def winnowed(text: str, run: int = RUN, words: int = WORDS) -> list[tuple[int, int, int, int, bytes]]:
    """(hash, line, lines in ``near`` before it, bits of its windows, digests of the lines near it) of each selected line."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    hashes = np.array([xxhash.xxh64_intdigest(x) for x in lines], dtype=np.uint64)
    count = np.concatenate(([0], np.cumsum([len(x.split()) for x in lines])))
    bits = np.zeros(len(lines), dtype=np.int64)
    left, right = np.zeros(len(lines), dtype=np.int64), np.zeros(len(lines), dtype=np.int64)
    first_bit = 0
    for size in range(1, min(run, len(lines)) + 1):
        start = np.arange(len(lines) - size + 1)
        if size < run:
            start = start[count[start + size] - count[start] >= words]
        if len(start):
            before = np.lib.stride_tricks.sliding_window_view(hashes, size)[start].argmin(axis=1)
            at = start + before
            np.bitwise_or.at(bits, at, np.left_shift(1, first_bit + before))
            np.maximum.at(left, at, before)
            np.maximum.at(right, at, size - 1 - before)
        first_bit += size
    selected = np.flatnonzero(bits).tolist()
    if not selected:
        return []
    digests = [hashlib.blake2b(x, digest_size=_DIGEST).digest() for x in lines]
    signed = hashes.view(np.int64).tolist()
    return [(signed[t], t, int(left[t]), int(bits[t]), b"".join(digests[t - int(left[t]):t + int(right[t]) + 1])) for t in selected]


def selected_lines(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """The selected lines of every document, each once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("fp", pa.int64()), ("at", pa.int32()), ("lead", pa.int32()), ("shapes", pa.int64()), ("near", pa.binary())])
        for part in text_slices(batches, "text", _SLICE_BYTES):
            found = [winnowed(t, run, words) for t in column_or_empty(part.column("text"))]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            rows = list(zip(*[r for x in found for r in x])) or [()] * 5
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(owner), part.column("version").take(owner),
                                              *[pa.array(c, f.type) for c, f in zip(rows, schema)]], ["doc_id", "version", *schema.names])

    keyed = batched(docs).where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("version"), "text")
    return keyed.mapInArrow(cut, _SELECTED)


def _shared(rows: DataFrame, key: str, place: Column, least: int) -> DataFrame:
    """``rows`` whose ``key`` stands at two places or more, with its ``first`` place.

    Keys with more than ``least`` rows join by broadcast (so few that they fit, whatever the input), the others by a shuffle.
    """
    groups = rows.groupBy(key).agg(F.min(place).alias("first"), F.max(place).alias("_last"), F.count(F.lit(1)).alias("_n")).where("first <> _last")
    groups = stored(groups.select(key, "first", "_n"), "line-groups")
    hot, cold = (groups.where(F.col("_n") > least if much else F.col("_n") <= least).select(key, "first") for much in (True, False))
    marked = rows.join(F.broadcast(hot), key, "left")
    return marked.where("first IS NOT NULL").unionByName(marked.where("first IS NULL").drop("first").join(cold.hint("merge"), key))


def deletions(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """doc_id, version, gone (the line numbers to delete, ascending) of documents that lose lines."""
    found = stored(selected_lines(docs, run, words), "selected-lines")
    least = max(_HOT_ROWS, found.count() // _HOT)
    joined = _shared(found, "fp", F.struct("doc_id", "version", "at"), least)
    every = F.array(*[F.struct(F.lit(before).alias("before"), F.lit(size).alias("size"), F.lit(1 << k).cast("long").alias("bit"))
                      for k, (before, size) in enumerate(shapes(run))])
    window = F.explode(F.filter(every, lambda w: F.col("shapes").bitwiseAND(w["bit"]) != 0))
    reached = F.expr(f"substring(near, (lead - _w.before) * {_DIGEST} + 1, _w.size * {_DIGEST})")
    matches = stored(joined.withColumn("_w", window).select(
        "doc_id", "version", (F.col("at") - F.col("_w.before")).alias("start"), "_w.size", F.unhex(F.md5(reached)).alias("run")), "line-matches")
    drop_stored(found)
    place = F.struct("doc_id", "version", "start")
    later = _shared(matches, "run", place, least).where(place > F.col("first"))
    covered = later.select("doc_id", "version", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("line"))
    gone = stored(covered.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("line")).alias("gone")), "line-deletions")
    drop_stored(matches)
    return gone


def dedup_lines(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """``docs`` with the deleted lines taken out of ``text``, and ``_lines``, ``_gone`` (numbers of lines, line numbers deleted)."""
    keyed = docs.withColumn("_id", F.col("doc_id").cast("long")).withColumn("_version", F.xxhash64("text"))
    gone = deletions(docs, run, words).select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("gone").alias("_gone"))
    lines = F.split("text", "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    joined = keyed.join(gone.hint("merge"), ["_id", "_version"], "left")  # both grow with the input: the same plan at every size
    return joined.withColumns({
        "_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)),
        "text": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left),
    }).drop("_id", "_version")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_deleted, n_runs (maximal runs deleted), kept_sha256 of every document."""
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    runs = F.size(F.filter(gone, lambda x, i: (i == 0) | (F.get(gone, i - 1) != x - 1)))
    return out.select("doc_id", F.col("_lines").cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_deleted"),
                      runs.cast("long").alias("n_runs"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL
), counted AS (
  SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM lines
), windows AS (
  SELECT doc_id, i, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c, n, n + lead(n, 1) OVER w AS n2
  FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), runs AS (
  SELECT doc_id, i, 3 AS size, a, b, c FROM windows WHERE c IS NOT NULL
  UNION ALL SELECT doc_id, i, 2, a, b, '' FROM windows WHERE b IS NOT NULL AND n2 >= 20
  UNION ALL SELECT doc_id, i, 1, a, '', '' FROM windows WHERE n >= 20
), ranked AS (
  SELECT doc_id, i, size, row_number() OVER (PARTITION BY size, a, b, c ORDER BY doc_id, i) AS n FROM runs
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM ranked, (VALUES (0), (1), (2)) AS t(k) WHERE n > 1 AND k < size
), marked AS (
  SELECT l.doc_id, l.i, l.line, g.i IS NOT NULL AS out, coalesce(lag(g.i IS NOT NULL) OVER (PARTITION BY l.doc_id ORDER BY l.i), FALSE) AS before
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i
)
SELECT d.doc_id, count(m.doc_id) AS n_lines, count(*) FILTER (m.out) AS n_deleted, count(*) FILTER (m.out AND NOT m.before) AS n_runs,
       sha256(coalesce(string_agg(m.line, chr(10) ORDER BY m.i) FILTER (NOT m.out), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id
GROUP BY d.doc_id
"""
