"""Shared pieces of the corpus operators: written intermediate tables, slices of Arrow batches,
connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.session import drop_snapshot, new_scratch_path, tune

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of an Arrow batch that holds whole texts.
TEXT_ROWS = 4000

__all__ = ["batched", "documents", "embeddings", "stored", "drop_stored", "text_slices", "column_or_empty", "components"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; what is read back does not
    depend on any executor staying alive.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, f"llm-{name}")
    # The written table replaces what this step shuffled: its shuffle files go when the write ends,
    # not when the driver happens to collect its garbage.
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(*frames: DataFrame) -> None:
    """Delete the folders that ``stored`` frames read from, once nothing reads them any more."""
    for df in frames:
        drop_snapshot(df)


def batched(docs: DataFrame) -> DataFrame:
    """``docs``, with Arrow batches of as many rows as fit a worker's memory when they hold texts."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)
    return docs


def column_or_empty(values: pa.Array) -> list[str]:
    """The texts of an Arrow column, null as empty."""
    return [x or "" for x in values.to_pylist()]


def text_slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``most`` bytes of ``column``; one row at least,
    so a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin = held = 0
        for i, n in enumerate(sizes):
            if i > begin and held + n > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += int(n)
        if begin < batch.num_rows:
            yield batch.slice(begin)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def components(edges: DataFrame, u: str, v: str, name: str = "components") -> DataFrame:
    """(node, root) for every node that has an edge: root is the smallest node of its component.

    Alternating large-star and small-star steps; each round is written to the shared folder, so
    lineage stays short, and ends when a round changes nothing.  A star's centre may hold any share
    of the edges: its minimum is a pre-aggregated ``groupBy`` and the join back can be split by
    adaptive execution.  Null and self edges are ignored; an empty input gives an empty result.
    """
    own = (edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")
           .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    current = stored(own, name)
    before = _signature(current)
    while before[0]:
        # Large star: each neighbour above a node goes to the smallest of the node and its neighbours.
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, name)
        # Small star: a node and its smaller neighbours go to the smallest of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        small = stored(small, name)
        drop_stored(current, large)
        after, current = _signature(small), small
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

