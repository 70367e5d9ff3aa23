import numpy as np

from remitflow.llm.embedding_dedup import near_duplicates
from remitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(rows, cosine=0.98):
    """rows: (vec_id, vector, label), usable and of one length."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    labels = np.array([r[2] for r in rows])
    n = np.linalg.norm(x, axis=1)
    linked = (x @ x.T / np.outer(n, n) >= cosine - 1e-12) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    least = ids.copy()
    while True:
        new = np.array([min([least[i], *least[linked[i]]]) for i in range(len(ids))])
        if (new == least).all():
            break
        least = new
    return {int(i): (int(d), int(c), bool(i == c)) for i, d, c in zip(ids, linked.sum(axis=1), least)}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def clustered(rng, n, dims, labels):
    centres = rng.normal(size=(12, dims))
    out = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=dims) * rng.choice([0.02, 0.1, 0.13, 0.16, 1.0])
        out.append((i * 3 + 1, (v * rng.uniform(0.1, 9)).astype(np.float32).tolist(), int(rng.integers(labels))))
    return out


def test_clusters_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    for dims in (3, 20, 64):
        rows = clustered(rng, 350, dims, 2)
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        want = plain(rows)
        assert result(near_duplicates(df)) == want
        assert sum(x[0] for x in want.values()) > 100
    assert result(near_duplicates(df, cell_rows=7)) == want  # chunked cells lose no link


def test_query_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert result(QUERIES["op9_embedding_near_dedup"](spark, SF)) == plain(rows)


def test_odd_rows(spark):
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    df = spark.createDataFrame([(9, a, 1, 5), (4, a, 1, 5), (4, a, 1, 5), (5, b, 1, 5), (6, a, 2, 5), (7, a, None, 5), (8, None, 1, 5), (None, a, 1, 5),
                                (10, [0.0, 0.0, 0.0], 1, 5), (11, [float("nan"), 1.0, 2.0], 1, 5), (12, [1.0, None, 3.0], 1, 5), (13, [1.0, 2.0], 1, 5),
                                (14, [float("inf"), 1.0, 1.0], 1, 5), (15, [], 1, 5)], "vec_id long, embedding array<float>, label int, cls int")
    rows = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect()))
    alone = [(i, 0, i, True) for i in (6, 7, 8, 10, 11, 12, 13, 14, 15)]
    assert rows == sorted([(0, 0, None, True), (4, 2, 4, True), (4, 2, 4, True), (5, 2, 4, False), (9, 2, 4, False), *alone])
    assert near_duplicates(df.where("false")).count() == 0


def test_labels_of_other_types_and_extreme_sizes(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(4, 768))
    rows = []
    for i in range(24):
        v = (base[i % 4] + rng.normal(size=768) * 0.02) * (1e200 if i % 3 == 0 else 1e-200 if i % 3 == 1 else 1.0)
        rows.append((i, v.tolist(), "even" if i % 2 == 0 else "odd"))
    df = spark.createDataFrame([*rows, (99, rows[0][1], None)], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df).collect()}
    assert got == {**{i: (5, i % 4) for i in range(24)}, 99: (0, 99)}
