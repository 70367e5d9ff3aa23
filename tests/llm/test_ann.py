import numpy as np
from pyspark.sql import functions as F

from remitflow.llm import ann
from remitflow.llm.ann import nearest, scan
from remitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def plain(rows, is_query, k=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for i in np.flatnonzero(is_query(ids)):
        far = np.sqrt(((x - x[i])**2).sum(axis=1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(far[j])) for j in order]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    found = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    return found / sum(map(len, want.values()))


def test_query_recall_and_scores(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = result(QUERIES["op10_approximate_nearest_neighbours"](spark, SF)), plain(rows, lambda i: i % 100 == 0)
    assert recall(got, want) >= 0.9
    x = {r[0]: np.array(r[1], dtype=np.float64) for r in rows}
    for q, near in got.items():
        assert len(near) == 10
        np.testing.assert_allclose([s for _, s in near], [np.linalg.norm(x[q] - x[v]) for v, _ in near], rtol=1e-12)


def test_chunked_lists_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 40)
    monkeypatch.setattr(ann, "QUERY_ROWS", 2)
    monkeypatch.setattr(ann, "_CELLS", 500)
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(0, 3, 8).astype(float).tolist()) for i in range(600)]
    rows = [r for r in rows if any(r[1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(ann, "TARGET", 1.0)
    got, want = result(nearest(df, F.col("vec_id") % 50 == 0)), plain(rows, lambda i: i % 50 == 0)
    assert recall(got, want) > 0.95
    assert all([s for _, s in got[q]] == sorted(s for _, s in got[q]) for q in got)


def test_small_lists_beside_a_hot_one(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [1.0] * 16) for i in range(5000)]
    for g in range(30):  # far from all others, four to a group
        middle = rng.normal(size=16) * 100
        rows += [(5000 + 4 * g + j, (middle + rng.normal(size=16) * 0.01).tolist()) for j in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = result(nearest(df, (F.col("vec_id") % 100 == 0) | (F.col("vec_id") >= 5000)))
    assert len(got) == 50 + 120 and all(len(near) == 10 for near in got.values())
    want = plain(rows, lambda i: i >= 5000)
    assert recall({q: got[q] for q in want}, want) > 0.3 and all({v for v, _ in got[q][:3]} == {v for v, _ in want[q][:3]} for q in want)
    assert all([v for v, _ in got[q]] == [v for v in range(11) if v != q][:10] for q in got if q < 5000)


def test_fewer_candidates_than_asked_for(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "vec_id long, embedding array<double>")
    assert all(len(near) == 5 for near in result(nearest(df, F.lit(True))).values())


def test_scan_abandons_little_that_counts():
    rng = np.random.default_rng(5)
    x, q = rng.normal(size=(2000, 64)), rng.normal(size=(20, 64))
    a, b, s = scan(q, x, np.zeros((20, 2000), dtype=bool), 10, np.arange(2000))
    far = np.sqrt(((q[:, None] - x[None])**2).sum(axis=2))
    want = np.argsort(far, axis=1)[:, :10]
    assert np.mean([v in want[i] for i, v in zip(a, b)]) > 0.97 and len(a) == 200
    np.testing.assert_allclose(s, far[a, b])


def test_odd_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1, 1), (0, [1.0, 0.0], 1, 1), (3, [2.0, 0.0], 1, 1), (2, [2.0, 0.0], 1, 1), (4, None, 1, 1), (None, [1.0, 1.0], 1, 1),
                                (5, [0.0, 0.0], 1, 1), (6, [float("nan"), 1.0], 1, 1), (7, [1.0, None], 1, 1), (8, [1.0, 1.0, 1.0], 1, 1), (100, [9.0, 0.0], 1, 1),
                                (200, [float("inf"), 0.0], 1, 1)], "vec_id long, embedding array<float>, list int, score int")
    assert result(nearest(df, F.col("vec_id") % 100 == 0)) == {0: [(2, 1.0), (3, 1.0), (100, 8.0)], 100: [(2, 7.0), (3, 7.0), (0, 8.0)]}
    assert nearest(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0
