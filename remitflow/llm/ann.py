"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

Index.  Centroids are fitted by k-means on a bounded sample (``SAMPLE`` vectors by a hash of the id);
every vector goes to the list of its nearest centroid.  How many lists a query probes is set on the
sample as well: the fewest that find ``TARGET`` of the true neighbours of some sample vectors.  The true
sizes of all lists are known before the scan: a query whose lists hold too few vectors probes on until
there are ``k`` candidates beside itself, or no list is left.

Scan.  Queries go to their nearest lists.  In a list all vectors are rotated by a random orthogonal
matrix and read in blocks of columns.  After each block a pair's partial squared distance over d of
D dimensions is tested against the hypothesis that the whole is within the query's bound: times D/d
it must not exceed the bound times (1 + EPSILON / sqrt(d))^2, else the pair is abandoned.  The bound
is the k-th smallest exact distance among the first vectors of the list.  Survivors get their exact
distance on the original vectors, in double precision; the best of each list are merged by query.

Lists of more than ``LIST_ROWS`` vectors are cut into chunks by a hash, and so are the queries of a list beyond
``QUERY_ROWS``; every chunk of queries meets every chunk of vectors, so no task holds a hot list or all that ask
for it.  Queries of a chunk are scanned in blocks bounded by pairs and by components.  Every vector is indexed, and queries are compared in all dimensions only as far as the tests allow.

Rows: vectors that are null, zero or hold null or non-finite components, or have no vec_id, take no
part, as queries or candidates; repeated rows count once; only vectors of the same length are
compared.  A query has itself (its vec_id) not among its neighbours, and fewer neighbours if there
are fewer candidates.  Ties go to the smaller vec_id.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from remitflow.llm.common import embeddings, stored
from remitflow.llm.vectors import by_dims, rotation, usable

K, EPSILON, TARGET = 10, 2.1, 0.97
SAMPLE, MOST_LISTS, ROUNDS, TRIALS = 20_000, 1024, 8, 300
LIST_ROWS, QUERY_ROWS, _COLUMNS = 20_000, 20_000, 16
#: Pairs, and numbers, that a step of a scan holds at once.
_PAIRS, _CELLS = 2_000_000, 8_000_000


@dataclass
class Index:
    """Centroids, the number of lists to probe and (once the vectors are placed) the lists' sizes, for each number of
    dimensions."""

    centroids: dict[int, np.ndarray]
    probes: dict[int, int]
    sizes: dict[int, np.ndarray]

    def nearest(self, x: np.ndarray, lists: int) -> np.ndarray:
        """The ``lists`` nearest lists of each row, nearest first."""
        c = self.centroids[x.shape[1]]
        far = (c**2).sum(axis=1)[None, :] - 2 * x @ c.T
        return np.argsort(far, axis=1, kind="stable")[:, :lists]


def lists_probed(index: Index, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, lists): for each query its nearest lists, at least ``probes`` and as many as hold ``k`` others."""
    d = x.shape[1]
    order = index.nearest(x, len(index.centroids[d]))
    held = np.cumsum(index.sizes[d][order], axis=1)
    enough = (held < k + 1).sum(axis=1) + 1  # the query itself is among them
    count = np.minimum(np.maximum(enough, index.probes[d]), order.shape[1])
    return np.repeat(np.arange(len(x)), count), order[np.arange(order.shape[1])[None, :] < count[:, None]]


def _squared(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the pairs (a, b), a bounded number of components at once."""
    step = max(1, _CELLS // (4 * q.shape[1]))
    return np.concatenate([((q[a[i:i + step]] - x[b[i:i + step]])**2).sum(axis=1) for i in range(0, len(a), step)] or [np.zeros(0)])


def fit(sample: dict[int, np.ndarray], totals: dict[int, int], k: int = K) -> Index:
    """An index from a sample of the vectors of each number of dimensions, and their true numbers."""
    index = Index({}, {}, {})
    for d, total in totals.items():
        x = sample.get(d, np.zeros((0, d)))
        rng = np.random.default_rng(17)
        lists = max(1, min(MOST_LISTS, int(np.sqrt(total)), len(x)))
        c = x[rng.choice(len(x), lists, replace=False)].copy() if len(x) else np.zeros((1, d))
        index.centroids[d] = c
        for _ in range(ROUNDS if len(x) else 0):
            own = index.nearest(x, 1)[:, 0]
            count = np.bincount(own, minlength=lists)
            sums = np.zeros_like(c)
            np.add.at(sums, own, x)
            c[count > 0] = sums[count > 0] / count[count > 0, None]
        index.probes[d] = _probes(index, x, k) if len(x) else 1
    return index


def _probes(index: Index, x: np.ndarray, k: int) -> int:
    """The fewest lists that hold ``TARGET`` of the ``k`` nearest of some of ``x``."""
    q = x[:TRIALS]
    far = (x**2).sum(axis=1)[None, :] - 2 * q @ x.T
    far[np.arange(len(q)), np.arange(len(q))] = np.inf
    near = np.argsort(far, axis=1)[:, :min(k, len(x) - 1)]
    order = index.nearest(q, len(index.centroids[x.shape[1]]))
    rank = np.argsort(order, axis=1)
    own = index.nearest(x, 1)[:, 0]
    needed = np.sort(np.take_along_axis(rank, own[near], axis=1).ravel())
    return 1 + int(needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))))]) if len(needed) else 1


def scan(queries: np.ndarray, vectors: np.ndarray, same: np.ndarray, k: int, ids: np.ndarray, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, distance) of the nearest found, at most ``k`` a query; ``same`` marks pairs that do not count."""
    d = queries.shape[1]
    turn = rotation(d)
    q, x = queries @ turn, vectors @ turn
    first = min(len(x), 4 * k)
    start = np.sqrt(((q[:, None, :] - x[None, :first, :])**2).sum(axis=2))
    start[same[:, :first]] = np.inf
    bound = np.sort(start, axis=1)[:, k - 1] if first >= k else np.full(len(q), np.inf)
    # Rounding of the partial distances, which matters where vectors are equal.
    bound = (bound * (1 + 1e-9))**2 + 1e-11 * ((q**2).sum(axis=1) + (x**2).sum(axis=1).max(initial=0))
    a = b = partial = None
    for begin in range(0, d, _COLUMNS):
        block = slice(begin, begin + _COLUMNS)
        done = min(begin + _COLUMNS, d)
        if a is None:
            far = np.maximum((q[:, block]**2).sum(axis=1)[:, None] + (x[:, block]**2).sum(axis=1)[None, :] - 2 * q[:, block] @ x[:, block].T, 0)
        else:
            far = partial + _squared(q[:, block], x[:, block], a, b)
        slack = (1 + epsilon / np.sqrt(done))**2 if done < d else 1 + 1e-9
        if a is None:
            a, b = np.nonzero((far * (d / done) <= bound[:, None] * slack) & ~same)
            partial = far[a, b]
        else:
            stay = far * (d / done) <= bound[a] * slack
            a, b, partial = a[stay], b[stay], far[stay]
    score = np.sqrt(_squared(queries, vectors, a, b))
    order = np.lexsort((ids[b], score, a))
    a, b, score = a[order], b[order], score[order]
    head = np.searchsorted(a, np.arange(len(q)))
    keep = np.arange(len(a)) - head[a] < k
    return a[keep], b[keep], score[keep]


def _search(k: int):
    def search(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if queries.num_rows and vectors.num_rows:
            q_ids, ids = queries.column("vec_id").to_numpy(), vectors.column("vec_id").to_numpy()
            (_, q), (_, x) = by_dims(queries.column("embedding"))[0], by_dims(vectors.column("embedding"))[0]  # a list has one length
            by_id = np.argsort(ids, kind="stable")
            ids, x = ids[by_id], x[by_id]
            step = max(1, min(_PAIRS // len(x), _CELLS // (min(len(x), 4 * k) * x.shape[1])))
            for i in range(0, len(q), step):
                part = q_ids[i:i + step]
                a, b, score = scan(q[i:i + step], x, part[:, None] == ids[None, :], k, ids)
                out.append((part[a], ids[b], score))
        columns = [np.concatenate([o[j] for o in out]) if out else np.zeros(0) for j in range(3)]
        return pa.table({"query_id": pa.array(columns[0].astype(np.int64)), "vec_id": pa.array(columns[1].astype(np.int64)), "score": pa.array(columns[2])})

    return search


def _listed(rows: DataFrame, index: Index, k: int | None = None) -> DataFrame:
    """``rows`` with their nearest list, or (``k``) a row for each list that they probe for ``k`` neighbours."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in by_dims(batch.column("embedding")):
                d = x.shape[1]
                if k is None:
                    own, lists = np.arange(len(x)), shared.value.nearest(x, 1)[:, 0]
                else:
                    own, lists = lists_probed(shared.value, x, k)
                every = batch.select(["vec_id", "embedding"]).take(pa.array(at[own]))
                yield pa.RecordBatch.from_arrays([*every.columns, pa.array(np.full(len(lists), d, np.int32)), pa.array(lists.astype(np.int32))],
                                                 ["vec_id", "embedding", "dims", "list"])

    return rows.select("vec_id", "embedding").mapInArrow(place, "vec_id long, embedding array<double>, dims int, list int")


def nearest(vectors: DataFrame, query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row where ``query`` holds."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(F.col("vec_id").isNotNull() & usable()).distinct()
    totals = {r["d"]: r["count"] for r in rows.groupBy(F.size("embedding").alias("d")).count().collect()}
    total = sum(totals.values())
    share = F.abs(F.xxhash64("vec_id") % 1_000_000) / 1_000_000
    few = rows.where(share * total <= 1.2 * SAMPLE).orderBy(share, "vec_id").limit(SAMPLE).select("embedding").collect()
    sample: dict[int, list] = {}
    for r in few:
        sample.setdefault(len(r["embedding"]), []).append(r["embedding"])
    index = fit({d: np.array(v) for d, v in sample.items()}, totals, k)
    base = stored(_listed(rows, index), "vector-lists")
    key = ["dims", "list"]
    sizes = base.groupBy(*key).count().collect()  # at most MOST_LISTS rows for each number of dimensions
    for d, c in index.centroids.items():
        index.sizes[d] = np.zeros(len(c), dtype=np.int64)
    for r in sizes:
        index.sizes[r["dims"]][r["list"]] = r["count"]
    asking = stored(_listed(rows.where(query), index, k), "vector-queries")
    # Two more such tables: how many chunks each list's vectors, and its queries, are dealt into.
    dealt = [F.broadcast(x.groupBy(*key).count().select(*key, F.ceil(F.col("count") / most).cast("int").alias(n)))
             for x, most, n in ((base, LIST_ROWS, "chunks"), (asking, QUERY_ROWS, "askers"))]
    placed = base.join(dealt[0], key).join(dealt[1], key).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), "chunks").cast("int")) \
        .withColumn("asker", F.explode(F.sequence(F.lit(0), F.col("askers") - 1)))
    asked = asking.join(dealt[0], key).join(dealt[1], key).withColumn("asker", F.pmod(F.xxhash64("vec_id", F.lit(1)), "askers").cast("int")) \
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    group = [*key, "chunk", "asker"]
    found = (asked.select("vec_id", "embedding", *group).groupBy(*group).cogroup(placed.select("vec_id", "embedding", *group).groupBy(*group))
             .applyInArrow(_search(k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")  # k rows from each list probed
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(embeddings(spark, sf_dir), F.col("vec_id") % 100 == 0)
