"""Centroid clustering over integer vectors with an incremental matrix of exact products.

Component ``x`` (in double precision) becomes the integer ``floor(64 * x)``.  Every vector keeps its
exact dot product with each centroid.  A round needs only the argmin of ``|c|^2 - 2 v.c``, as ``|v|^2`` is
the same for all centroids of a vector; afterwards a product changes by ``v . (c' - c)``, which reads the
components in which the centroid moved and no others.  Products are written between rounds, so a lost
executor costs its own tasks only.  Sums per centroid are made in each task and then added up by Spark:
the driver sees centroids, never vectors.

Integers are exact at any size: a batch whose products might leave 64 bits is computed with Python
integers, keeps no products (they are computed anew in the next round), and sums travel in limbs of 48 bits.

Rows: vectors that are null, of another number of components, or hold null or non-finite ones are left
out.  Ties go to the centroid of the smaller number; a centroid without vectors stays where it is.
Repeated rows count as often as they occur; of vectors with equal ids the lesser by components is the
earlier start.  A null id is hashed as an empty one.  With fewer vectors than centroids there are as many
centroids as vectors.  An empty table gives no rows.  A distance or inertia beyond 64 bits is null.
Columns beside ``vec_id`` and ``embedding`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import drop_stored, embeddings, stored

COMPONENTS = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
SCALE = 64
_LIMB = 48
_SAFE = 1 << 62


def whole(column: str, components: int) -> Column:
    """A vector of exactly ``components`` components, all of them there and finite."""
    v = F.col(column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == components) & fine, F.lit(False))


def integers(rows: np.ndarray) -> np.ndarray:
    """``floor(64 * x)``: 64-bit integers where they fit, else Python integers."""
    if not rows.size or np.abs(rows).max() < 2.0 ** 55:
        return np.floor(rows * SCALE).astype(np.int64)
    exact = [[int(x) * SCALE if abs(x) >= 2.0 ** 53 else int(np.floor(x * SCALE)) for x in row] for row in rows.tolist()]
    return np.array(exact, dtype=object)


def _fits(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether sums of products of rows of ``a`` and ``b``, doubled, stay within 64 bits."""
    if not a.size or not b.size:
        return True
    most = [max(int(x.max()), -int(x.min())) for x in (a, b)]
    return 4 * a.shape[1] * max(most) ** 2 < _SAFE


def products(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    if _fits(vectors, centroids):
        return vectors.astype(np.int64) @ centroids.astype(np.int64).T
    return vectors.astype(object) @ centroids.astype(object).T


def updated(dots: np.ndarray, vectors: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The products with ``after``, from those with ``before``: only components that moved are read."""
    out = dots.copy()
    for k, step in enumerate(after - before):
        moved = np.flatnonzero(step)
        if moved.size:
            out[:, k] += vectors[:, moved] @ step[moved]
    return out


def nearest(dots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroid of least ``|c|^2 - 2 v.c``; ties to the smaller number."""
    norms = (centroids.astype(object) ** 2).sum(axis=1)
    if dots.dtype == object:
        return np.array([min(range(len(norms)), key=lambda k, row=row: norms[k] - 2 * row[k]) for row in dots], dtype=np.int64)
    return np.argmin(norms.astype(np.int64) - 2 * dots, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, rest, k = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        if part := rest & ((1 << _LIMB) - 1):
            yield k, sign * part
        rest >>= _LIMB
        k += 1


def _with_products(kept: DataFrame, before: np.ndarray | None, after: np.ndarray) -> DataFrame:
    """``kept`` (vec_id, embedding and, from the second round, dots) with the products with ``after``."""

    def refresh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            vectors = integers(_matrix(part.column("embedding")))
            dots = _fresh(part, vectors, before, after)
            kept_dots = pa.array([None] * len(vectors), pa.list_(pa.int64())) if dots.dtype == object else pa.FixedSizeListArray.from_arrays(
                pa.array(dots.ravel()), dots.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("embedding"), kept_dots], ["vec_id", "embedding", "dots"])

    kind = kept.schema["embedding"].dataType.simpleString()
    return kept.mapInArrow(refresh, f"vec_id long, embedding {kind}, dots array<long>")


def _fresh(part: pa.RecordBatch, vectors: np.ndarray, before: np.ndarray | None, after: np.ndarray) -> np.ndarray:
    if (before is None or vectors.dtype == object or part.column("dots").null_count or not _fits(vectors, after)
            or not _fits(vectors, before)):
        return products(vectors, after)
    dots = part.column("dots").flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    return updated(dots, vectors, before, after)


def _sums(state: DataFrame, centroids: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """(vectors, componentwise sums) of each centroid."""
    n, size = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, size + 1), dtype=object)  # the last column counts
        for part in batches:
            vectors = integers(_matrix(part.column("embedding")))
            dots = _fresh(part, vectors, centroids, centroids)
            at = nearest(dots, centroids)
            small = vectors.dtype != object and (not vectors.size or int(np.abs(vectors).max()) * len(vectors) < _SAFE)
            for k in np.unique(at).tolist():
                own = vectors[at == k]
                total[k, :size] += (own if small else own.astype(object)).sum(axis=0).astype(object)
                total[k, size] += len(own)
        found = [(k, d, limb, v) for k in range(n) for d in range(size + 1) for limb, v in _limbs(int(total[k, d]))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["k", "d", "limb", "v"])

    parts = state.mapInArrow(add, "k long, d long, limb long, v long").groupBy("k", "d", "limb").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    sums = np.zeros((n, size + 1), dtype=object)
    for r in parts.collect():  # at most centroids x (components + 1) x 23 limbs
        sums[r.k, r.d] += int(r.v) << (_LIMB * r.limb)
    return [int(x) for x in sums[:, size]], sums[:, :size].tolist()


def _moved(centroids: np.ndarray, counts: list[int], sums: list[list[int]]) -> np.ndarray:
    rows = [[s // n for s in own] if n else old for n, own, old in zip(counts, sums, centroids.tolist())]
    return _as_integers(rows)


def _as_integers(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < 1 << 61 for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if small else object)


def starts(kept: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:vec_id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("h"), "embedding").orderBy("h", "embedding").limit(count).collect()
    return _as_integers(integers(np.array([r.embedding for r in rows], dtype=np.float64)).tolist())


def centroid_clusters(vectors: DataFrame, components: int = COMPONENTS, centroids: int = CENTROIDS, rounds: int = ROUNDS,
                      seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that is kept."""
    spark = vectors.sparkSession
    kept = vectors.select(F.col("vec_id").cast("long"), "embedding").where(whole("embedding", components))
    after = starts(kept, centroids, seed)
    if not len(after):
        return kept.limit(0).select("vec_id", *[F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    state = stored(_with_products(kept, None, after), "products")
    for turn in range(rounds):
        before, after = after, _moved(after, *_sums(state, after))
        if (before == after).all():
            break  # nothing moved: neither will it in later rounds
        if turn + 1 < rounds:
            state, old = stored(_with_products(state, before, after), "products"), state
            drop_stored(old)
    else:
        before = before if rounds else None
    placed = stored(_assigned(state, before, after), "clusters")
    drop_stored(state)
    own = placed.groupBy("cluster").agg(F.sum(F.col("d").cast("decimal(38,0)")).alias("s"), F.count(F.when(F.col("d").isNull(), 1)).alias("beyond"))
    found = {r.cluster: None if r.beyond else int(r.s) for r in own.collect()}  # at most one row a centroid
    total = None if None in found.values() else sum(found.values())
    rows = [(k, _long(found.get(k)), _long(total), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for k, c in enumerate(after.tolist())]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(table), "cluster").select(  # one row a centroid
        "vec_id", "cluster", F.expr("try_cast(d AS BIGINT)").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")


def _long(x: int | None) -> int | None:
    return x if x is not None and x < 1 << 63 else None


def _assigned(state: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """vec_id, cluster, d: the last assignment, with the squared distance (null beyond 38 digits)."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms = (after.astype(object) ** 2).sum(axis=1)
        for part in batches:
            vectors = integers(_matrix(part.column("embedding")))
            dots = _fresh(part, vectors, before, after)
            at = nearest(dots, after)
            length = (vectors if _fits(vectors, vectors) else vectors.astype(object)) ** 2
            own = dots[np.arange(len(at)), at]
            d = [a + norms[k] - 2 * b for a, k, b in zip(length.sum(axis=1).tolist(), at.tolist(), own.tolist())]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(at, pa.int32()), pa.array([str(x) for x in d])], ["vec_id", "cluster", "d"])

    return state.mapInArrow(assign, "vec_id long, cluster int, d string").select("vec_id", "cluster", F.expr("try_cast(d AS DECIMAL(38,0))").alias("d"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(embeddings(spark, sf_dir))


def _round(n: int) -> str:
    """SQL of one round: assignment ``a<n>``, then centroids ``c<n + 1>``."""
    return f"""
a{n} AS MATERIALIZED (SELECT v.id, arg_min(c.k, {_DISTANCE} * 16 + c.k) AS k FROM v, c{n} c GROUP BY v.id),
m{n} AS (SELECT a.k, i.i, SUM(v.v[i.i]) AS s, COUNT(*) AS n FROM a{n} a JOIN v ON v.id = a.id, (SELECT UNNEST(range(1, 65)) AS i) i GROUP BY a.k, i.i),
f{n} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM m{n} GROUP BY k),
c{n + 1} AS MATERIALIZED (SELECT c.k, COALESCE(f.c, c.c) AS c FROM c{n} c LEFT JOIN f{n} f ON f.k = c.k),"""


_DISTANCE = "CAST(list_sum(list_transform(list_zip(v.v, c.c), lambda z: CAST(z[1] - z[2] AS HUGEINT) * (z[1] - z[2]))) AS HUGEINT)"

OP13_SQL = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE len(embedding) = 64),
v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(e, lambda x: CAST(floor(64 * x) AS HUGEINT)) AS v FROM e
  WHERE len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS k, v AS c
  FROM (SELECT * FROM v ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v LIMIT 16)),{"".join(_round(n) for n in range(ROUNDS))}
a AS MATERIALIZED (SELECT v.id, arg_min(c.k, {_DISTANCE} * 16 + c.k) AS k FROM v, c{ROUNDS} c GROUP BY v.id),
d AS MATERIALIZED (SELECT v.vec_id, c.k, c.c, {_DISTANCE} AS d FROM a JOIN v ON v.id = a.id JOIN c{ROUNDS} c ON c.k = a.k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(SUM(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(SUM(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM d
"""
