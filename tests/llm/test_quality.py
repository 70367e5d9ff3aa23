import zlib

import numpy as np

from remitflow.llm.quality import L2, LEAST_HESSIAN, NAMES, document_statistics, fit, learn, score, statistics
from remitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def walk(forest, row):
    total, (trees, inner) = forest.base, forest.feature.shape
    for t in range(trees):
        k = 0
        while k < inner:
            k = 2 * k + 1 + (row[forest.feature[t, k]] > forest.threshold[t, k])
        total += forest.leaf[t, k - inner]
    return 1 / (1 + np.exp(-total))


def test_forest_learns_and_flat_walk_equals_the_plain_one():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(3000, 5))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 3] > 0)).astype(float)
    forest = fit(rows[:2000], labels[:2000], trees=30)
    got = forest.score(rows)
    np.testing.assert_allclose(got[:200], [walk(forest, r) for r in rows[:200]])
    assert ((got[2000:] > 0.5) == labels[2000:]).mean() > 0.95


def plain_tree(rows, labels, margin, depth, bins):
    """Leaf value of each row, by trying every cut of every feature on the rows of each node."""
    p = 1 / (1 + np.exp(-margin))
    g, h = p - labels, p * (1 - p)
    cuts = [sorted(set(np.quantile(rows[:, f], np.arange(1, bins) / bins).tolist())) for f in range(rows.shape[1])]

    def value(x):
        return -g[x].sum() / (h[x].sum() + L2)

    def grown(x, level):
        best = (1e-9, None)
        for f in range(rows.shape[1] if level < depth else 0):
            for c in cuts[f]:
                left, right = x[rows[x, f] <= c], x[rows[x, f] > c]
                if h[left].sum() >= LEAST_HESSIAN and h[right].sum() >= LEAST_HESSIAN:
                    gain = sum(g[y].sum()**2 / (h[y].sum() + L2) for y in (left, right)) - g[x].sum()**2 / (h[x].sum() + L2)
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
        if best[1] is None:
            return {int(i): value(x) for i in x}
        return {**grown(best[1][0], level + 1), **grown(best[1][1], level + 1)}

    leaves = grown(np.arange(len(rows)), 0)
    return np.array([leaves[i] for i in range(len(rows))])


def test_histogram_splits_against_every_cut():
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(300, 4)).round(1)  # with ties
    labels = (rows[:, 1] + 0.5 * rows[:, 2] + rng.normal(size=300) * 0.4 > 0).astype(float)
    for depth in (1, 2, 3):
        margin = np.full(300, np.log(labels.mean() / (1 - labels.mean())))
        for _ in range(3):
            margin = margin + 0.15 * plain_tree(rows, labels, margin, depth, 16)
        np.testing.assert_allclose(fit(rows, labels, trees=3, depth=depth, bins=16).score(rows), 1 / (1 + np.exp(-margin)), rtol=1e-9)


def test_statistics_against_plain_counts():
    for text in ("Hello, World! Hello\n\nWorld! 42 \t é – x", " \n", "a", "AAA bbb AAA.\nAAA bbb AAA.", "ß?" * 300):
        raw = text.encode()
        words, lines = raw.split(), raw.split(b"\n")
        n, m = len(raw), max(len(words), 1)

        def share(test):
            return sum(map(test, raw)) / n

        want = [np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), sum(map(len, words)) / m, max([0, *map(len, words)]), len(set(words)) / m,
                len(set(lines)) / len(lines), n / len(lines), max([0, *map(words.count, words)]) / m, share(lambda b: 65 <= b <= 90),
                share(lambda b: 97 <= b <= 122), share(lambda b: 48 <= b <= 57), share(lambda b: b == 32 or 9 <= b <= 13), share(lambda b: b > 127),
                sum(chr(w[-1]).isascii() and not chr(w[-1]).isalnum() for w in words) / m, sum(raw.count(c) for c in (b"!", b".", b"?")) / m,
                *(raw.count(x[6:].encode()) / n for x in NAMES if x.startswith("share_"))]
        np.testing.assert_allclose(statistics(text), want, rtol=1e-12)


def test_query_on_held_out_labels(spark):
    rows = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for d, r in rows.items())
    held = [(r.quality, rows[r.doc_id]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert np.mean([q == r.predicted for q, r in held]) > 0.9


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (2, "", 1.0), (None, "a b", 1.0), (3, "word " * 50000, 1.0), (4, "\n\n", 1.0)],
                               "doc_id long, text string, score double")
    stats = document_statistics(df)
    labels = spark.createDataFrame([(1, None), (2, 7), (None, 1)], "doc_id long, quality int")
    rows = score(stats, learn(stats, labels)).collect()
    assert len(rows) == 6 and {r.score for r in rows} == {0.5}
    assert len(statistics("a")) == len(NAMES) and statistics("") == [0.0] * len(NAMES)
    labels = spark.createDataFrame([(2, 1), (3, 0)] * 40, "doc_id long, quality int")
    got = {r.doc_id: r.score for r in score(stats, learn(stats, labels)).collect()}
    assert got[1] == got[2] > 0.5 > got[3]
    assert score(document_statistics(df.where("false")), learn(stats, labels)).count() == 0
