"""Near-duplicate embeddings by a subspace pigeonhole join.

Vectors link if their labels are equal and their cosine is at least ``cosine``; for unit vectors that
is a squared distance of at most 2 - 2 cosine.  The unit vectors are rotated and split into blocks of
``BLOCK`` dimensions.  If all blocks of a pair were farther apart than their share of that budget, in
proportion to their dimensions, the sum would exceed it; so a linked pair is within the share in at
least one block.  Each block is range-joined on its own: a grid over its first ``GRID`` dimensions,
cells as wide as two radii, each vector at home in one cell and visiting the others its ball reaches;
in a cell the block distances of homes and visitors are compared.  The candidates of all blocks are
united and verified by the exact cosine in double precision.

Equal vectors of a label are one class first.  A cell with more than ``CELL_ROWS`` rows is cut: homes
and visitors into chunks by a hash, a group for each pair of chunks, so no task holds a whole cell.
Pairs stand between classes; links are counted by class sizes.

Rows: vectors that are null, zero or hold null or non-finite components, and those with a null label or
vec_id, link with nothing and are kept (a null vec_id has a null component).  Vectors of different
lengths do not link.  Repeated rows are returned each, and a vec_id counts once among the links of
another.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import components, embeddings, stored
from remitflow.llm.vectors import by_dims, rotation, usable
from remitflow.session import bounded_broadcast

COSINE = 0.98
BLOCK, GRID = 8, 3
CELL_ROWS, _GROUP_ROWS = 4096, 40_000
_MARGIN = 1e-5  # coordinates travel in single precision
_PLACED = "label long, dims int, block int, cell long, home boolean, cls long, coords binary"


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, exactly, so that squares neither overflow nor vanish."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def placed(classes: DataFrame, cosine: float) -> DataFrame:
    """A row for each block of each class and each cell that its ball in that block reaches."""
    names = ["label", "dims", "block", "cell", "home", "cls", "coords"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, ids = (batch.column(c).to_numpy() for c in ("label", "cls"))
            for rows, v in by_dims(batch.column("embedding")):
                d = v.shape[1]
                v = scaled(v)
                unit = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ rotation(d)
                for k, begin in enumerate(range(0, d, BLOCK)):
                    x = np.ascontiguousarray(unit[:, begin:begin + BLOCK].astype(np.float32))
                    radius = np.sqrt((2 - 2 * cosine) * x.shape[1] / d) + _MARGIN
                    g = min(GRID, x.shape[1])
                    first = x[:, :g].astype(np.float64)
                    own = np.floor(first / (2 * radius)).astype(np.int64)
                    # The ball's interval reaches the neighbour below or above, whichever side is nearer.
                    step = np.where(first / (2 * radius) - own < 0.5, -1, 1)
                    coords = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * x.shape[1]), len(x), [None, pa.py_buffer(x.tobytes())]).cast(pa.binary())
                    for to in product((0, 1), repeat=g):
                        at = own + step * np.array(to)
                        cell = np.zeros(len(x), dtype=np.int64)
                        for j in range(g):
                            cell = cell * (1 << 20) + at[:, j] + (1 << 19)
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(labels[rows]), pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, k, np.int32)), pa.array(cell),
                             pa.array(np.full(n, not any(to))), pa.array(ids[rows]), coords], names)

    return classes.select(F.xxhash64("label").alias("label"), "cls", "embedding").mapInArrow(place, _PLACED)


def _compare(cosine: float):
    def compare(group: pa.Table) -> pa.Table:
        columns = {c: group.column(c).to_numpy() for c in ("label", "dims", "block", "cell", "mine", "theirs")}
        home, ids = group.column("home").to_numpy(), group.column("cls").to_numpy()
        raw = group.column("coords").to_pylist()
        order = np.lexsort(tuple(columns.values()))
        new = np.any([c[order[1:]] != c[order[:-1]] for c in columns.values()], axis=0)
        found = []
        for rows in np.split(order, np.flatnonzero(new) + 1):
            h, v = rows[home[rows]], rows
            if not len(h) or len(v) < 2:
                continue
            x, y = (np.frombuffer(b"".join([raw[i] for i in r]), dtype=np.float32).reshape(len(r), -1).astype(np.float64) for r in (h, v))
            most = (np.sqrt((2 - 2 * cosine) * x.shape[1] / columns["dims"][rows[0]]) + _MARGIN)**2
            size = (y**2).sum(axis=1)
            for i in range(0, len(h), 1024):
                part = x[i:i + 1024]
                a, b = np.nonzero((part**2).sum(axis=1)[:, None] + size[None, :] - 2 * part @ y.T <= most)
                a, b = ids[h[i + a]], ids[v[b]]
                found.append((a[a < b], b[a < b]))
        a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        pairs = np.unique(np.stack((a, b)), axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    return compare


def candidates(classes: DataFrame, cosine: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b) distinct pairs of classes, a < b, within the budget's share in some block."""
    cell = ["label", "dims", "block", "cell"]
    rows = placed(classes, cosine)
    hot = rows.groupBy(*cell).count().where(F.col("count") > cell_rows).select(*cell, F.ceil(F.col("count") / cell_rows).cast("int").alias("chunks"))
    split = rows.join(bounded_broadcast(hot), cell, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("cls"), "chunks").cast("int")
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    # A row at home stands in its chunk of the homes against every chunk of visitors, and is a visitor too.
    homes = split.where("home").withColumn("mine", own).withColumn("theirs", F.explode(every))
    visits = split.withColumn("home", F.lit(False)).withColumn("theirs", own).withColumn("mine", F.explode(every))
    blocks = classes.agg(F.sum(F.ceil(F.size("embedding") / BLOCK))).first()[0] or 0
    groups = 1 + int(blocks) * 9 // _GROUP_ROWS
    keyed = homes.unionByName(visits).withColumn("bucket", F.pmod(F.xxhash64(*cell, "mine", "theirs"), F.lit(groups)))
    return keyed.groupBy("bucket").applyInArrow(_compare(cosine), "a long, b long").distinct()


def links(classes: DataFrame, cosine: float = COSINE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b) pairs of classes with that cosine or more."""
    own = classes.select("cls", "embedding", "label")
    joined = (candidates(classes, cosine, cell_rows)
              .join(own.toDF("a", "x", "of_a"), "a").join(own.toDF("b", "y", "of_b"), "b").where("of_a = of_b"))  # labels go by a hash before

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for (rows, x), (_, y) in zip(by_dims(batch.column("x")), by_dims(batch.column("y"))):
                x, y = scaled(x), scaled(y)
                dot = np.einsum("ij,ij->i", x, y)
                keep[rows] = dot / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)) >= cosine
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return joined.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), "label")
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable()
    # Equal vectors of a label are a class; its number stays once the table is written.
    classes = stored(rows.where(fine).groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.countDistinct("vec_id").alias("members"))
                     .withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    pairs = stored(links(classes, cosine, cell_rows), "vector-links")
    size = classes.select("cls", "members")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(size.toDF("b", "members"), "b").groupBy("a").agg(F.sum("members").alias("others"))
    root = components(pairs, "a", "b", "vectors")
    named = classes.join(root.toDF("cls", "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = (named.join(names, "root").join(degree.withColumnRenamed("a", "cls"), "cls", "left")
             .select("label", "embedding", "component_id", (F.coalesce("others", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.lit(True).alias("fine")))
    joined = rows.withColumn("fine", fine).join(known, ["label", "embedding", "fine"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(embeddings(spark, sf_dir))
