"""Near-duplicate documents by SimHash, compared exactly in tiles.

A fingerprint's bit is 1 if more than half of the document's shingle hashes (XXH64) have it.  Two
documents link if their fingerprints differ in at most ``radius`` bits; what links form together is
a component, named by its smallest doc_id.

Comparison.  Equal fingerprints are one first.  A tile is a set of fingerprints with the same
population counts (bits set) in the lower and the upper half; two fingerprints differ in at least as
many bits as their counts do, so tile pairs whose counts differ by more than ``radius`` in total are
skipped, and each tile meets at most 40 others however many documents there are.  A tile above
``TILE_ROWS`` is cut into chunks by a hash, and each pair of chunks is a group of its own, so no task
holds more than two chunks.  Within a group the same rule on the counts of the four quarters skips
smaller tiles; what is left is compared by exclusive-or and bit counts of whole blocks.  A group
returns a spanning forest of the links it finds, not the links, so thousands of near copies give
thousands of rows, not millions.

Rows: a null or empty text, or one without a word, has the fingerprint zero and links like any
other.  Rows without a doc_id get a fingerprint and a null component and link with nothing.
Repeated rows are returned each.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import batched, column_or_empty, components, documents, stored, text_slices

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE_ROWS = 32_768
_SLICE_BYTES = 8 << 20
_CELLS = 1 << 21  # pairs compared at once
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of the shingles of ``size`` words of the text, A-Z in lower case."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters, ASCII white space
    if not words:
        return np.zeros(0, dtype=np.uint64)
    whole = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(whole, seed)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[:len(words) - size + 1].tolist()
    digest, view = xxhash.xxh64_intdigest, memoryview(whole)
    return np.array([digest(view[a:b], seed) for a, b in zip(begins, ends[size - 1:].tolist())], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Majority of each bit, as an unsigned number; none: zero."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for begin in range(0, n, 255):  # a lane of eight bits holds a count to 255
        block = hashes[begin:begin + 255]
        for bit in range(8):
            lanes = ((block >> np.uint64(bit)) & _LANES).sum(dtype=np.uint64)
            counts[bit::8] += np.frombuffer(lanes.astype("<u8").tobytes(), dtype=np.uint8)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, version (a hash of the text), fp (the fingerprint as a signed 64-bit number) of every row."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", _SLICE_BYTES):
            fps = [fingerprint(shingle_hashes(t, size, seed)) for t in column_or_empty(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("version"), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                                             ["doc_id", "version", "fp"])

    keyed = batched(docs).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("version"), F.col("text").cast("string"))
    return keyed.mapInArrow(mark, "doc_id long, version long, fp long")


def _tile() -> Column:
    low = F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    return low * 64 + F.bit_count(F.shiftrightunsigned("fp", 32))


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int64)


def _close(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints of ``a`` and ``b`` within ``radius`` bits, block by block."""
    qa, qb = _quarters(a), _quarters(b)
    kinds, kind_of = np.unique(qa, axis=0, return_inverse=True)
    order = np.argsort(kind_of, kind="stable")
    begins = np.searchsorted(kind_of[order], np.arange(len(kinds) + 1))
    for k, q in enumerate(kinds):
        near = np.flatnonzero(np.abs(qb - q).sum(axis=1) <= radius)
        if not len(near):
            continue
        rows = order[begins[k]:begins[k + 1]]
        step = max(1, _CELLS // len(near))
        for i in range(0, len(rows), step):
            x, y = np.nonzero(np.bitwise_count(a[rows[i:i + step], None] ^ b[None, near]) <= radius)
            if len(x):
                yield rows[i + x], near[y]


def _forest(count: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Edges that span what the pairs connect: (node, its root).

    Of a block's pairs, one for each set that still has any is united; then the pairs inside one
    set are dropped, until none is left.  A dense block takes a few rounds, not a step a pair.
    """
    root = np.arange(count)
    for x, y in pairs:
        while len(x):
            a, b = root[x], root[y]
            apart = a != b
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            _, one = np.unique(a, return_index=True)
            for i, j in zip(a[one].tolist(), b[one].tolist()):
                while root[i] != i:
                    i = root[i]
                while root[j] != j:
                    j = root[j]
                root[max(i, j)] = min(i, j)
            while not np.array_equal(root, root[root]):
                root = root[root]
    away = np.flatnonzero(root != np.arange(count))
    return list(zip(away.tolist(), root[away].tolist()))


def links(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b) edges between the distinct ``fp`` of ``nodes``: those that connect all within ``radius``."""
    spark = nodes.sparkSession
    tiled = nodes.select("fp", _tile().alias("tile"))
    counts = {r["tile"]: r["count"] for r in tiled.groupBy("tile").count().collect()}  # at most 33 x 33 rows
    chunks = {t: -(-n // tile_rows) for t, n in counts.items()}
    meets = [(t, chunks[t], o, chunks[o]) for t in chunks for o in chunks
             if abs(t // 64 - o // 64) + abs(t % 64 - o % 64) <= radius]
    table = spark.createDataFrame(meets or [], "tile int, own int, other int, others int")  # at most 41 rows a tile
    placed = tiled.join(F.broadcast(table), "tile").withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("own")).cast("int"))
    # A group is an ordered pair of (tile, chunk); its first half is side 0, its second side 1.
    placed = placed.withColumn("match", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    mine, theirs = F.struct("tile", "chunk"), F.struct(F.col("other").alias("tile"), F.col("match").alias("chunk"))
    placed = placed.select("fp", F.least(mine, theirs).alias("lo"), F.greatest(mine, theirs).alias("hi"), (mine > theirs).alias("second"))

    def compare(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        side = group.column("second").to_numpy()
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        a = np.ascontiguousarray(fps[~side])
        b = a if lo == hi else np.ascontiguousarray(fps[side])
        both = a if lo == hi else np.concatenate((a, b))
        edges = _forest(len(both), ((x, y if lo == hi else y + len(a)) for x, y in _close(a, b, radius))) if len(a) and len(b) else []
        own, root = (both[[e[k] for e in edges]].view(np.int64) if edges else np.zeros(0, np.int64) for k in (0, 1))
        return pa.table({"a": own, "b": root})

    return placed.groupBy("lo", "hi").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """doc_id, version, fp, component_id of every row."""
    rows = stored(fingerprints(docs, size), "fingerprints")
    nodes = stored(rows.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(nodes, radius, tile_rows), "a", "b", "simhash").select(F.col("node").alias("fp"), "root")
    named = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(names, "root").select("fp", "component_id")
    return (rows.join(by_fp, "fp", "left")
            .select("doc_id", "version", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def one_of_each(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document that names it, once; rows
    without a doc_id all stay."""
    found = near_duplicates(docs, size, radius).where("doc_id = component_id")
    stay = found.groupBy("doc_id").agg(F.min("version").alias("version")).select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
    known = docs.where("doc_id IS NOT NULL").withColumns({"_id": F.col("doc_id").cast("long"), "_version": F.xxhash64("text")})
    kept = known.join(stay, ["_id", "_version"], "left_semi").dropDuplicates(["_id", "_version"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
