from pyspark.sql import functions as F

from remitflow.operators.sequences import hot_groups, sequence_within


def _data(spark):
    # one hot group holding most rows, several small ones
    rows = [("hot", i, i % 7) for i in range(500)] + [(f"g{k}", i, 0) for k in range(5) for i in range(k + 1)]
    return spark.createDataFrame(rows, "g string, k long, x long")


def test_window_and_sort_paths_agree(spark):
    df = _data(spark)
    plain = sequence_within(df, ["g"], ["k"], "seq", hot_rows=10_000)
    split = sequence_within(df, ["g"], ["k"], "seq", hot_rows=10)
    a = sorted(map(tuple, plain.select("g", "k", "seq").collect()))
    b = sorted(map(tuple, split.select("g", "k", "seq").collect()))
    assert a == b
    # dense 1..N per group, in key order
    for g, n in [("hot", 500), ("g4", 5)]:
        got = [r["seq"] for r in split.where(F.col("g") == g).orderBy("k").collect()]
        assert got == list(range(1, n + 1))


def test_hot_groups_bounded(spark):
    df = _data(spark)
    assert hot_groups(df, ["g"], 10) == [("hot",)]
    assert hot_groups(df, ["g"], 1000) == []


def test_sort_path_multi_column_group(spark):
    rows = [(1, 1, i) for i in range(300)] + [(1, 2, i) for i in range(3)] + [(2, 1, i) for i in range(40)]
    df = spark.createDataFrame(rows, "a long, b long, k long")
    out = sequence_within(df, ["a", "b"], [F.col("k").desc()], "seq", hot_rows=20)
    r = {(x.a, x.b, x.k): x.seq for x in out.collect()}
    assert r[(1, 1, 299)] == 1 and r[(1, 1, 0)] == 300
    assert r[(2, 1, 39)] == 1 and r[(1, 2, 0)] == 3


def test_invoice_list_chunks_keep_order(spark):
    from remitflow.operators.aggregate import invoice_list
    rows = [(1, f"INV{i}", i) for i in range(2500)] + [(2, "INVB", 1), (2, "INVA", 2)]
    paid = spark.createDataFrame(rows, "check_id long, invoice_num string, line_number long")
    out = {r.check_id: r.invoices for r in invoice_list(paid, ["line_number"], chunk=100, hot_rows=50).collect()}
    plain = {r.check_id: r.invoices for r in invoice_list(paid, ["line_number"]).collect()}
    assert plain == out
    assert out[2] == "DOCUMENTOS: INVB INVA "
    assert out[1] == "DOCUMENTOS: " + "".join(f"INV{i} " for i in range(2500))


def test_hot_file_single_pass_carries_across_partitions(spark):
    """A payment whose invoices span several range partitions keeps dense invoice ordinals."""
    from remitflow.operators.render import _numbered_by_sort
    body = spark.createDataFrame([("f", 1, c, c) for c in range(1, 4)],
                                 "file_id string, format_id long, check_id long, check_number long")
    det = spark.createDataFrame([("f", 1, 2, 2, i) for i in range(1, 200)] + [("f", 1, 3, 3, 1)],
                                "file_id string, format_id long, check_id long, check_number long, invoice_id long")
    b, d = _numbered_by_sort(body, det, ["invoice_id"], 5, [("f",)])
    assert sorted((r.check_id, r.seq1, r.seq3, r._pos) for r in b.collect()) == [(1, 1, 0, 1), (2, 2, 1, 2),
                                                                                 (3, 3, 201, 202)]
    dd = sorted((r.check_id, r.invoice_id, r.seq2, r.seq1, r.seq3) for r in d.collect())
    assert [x[2] for x in dd if x[0] == 2] == list(range(1, 200))
    assert [x[4] for x in dd if x[0] == 2] == list(range(1, 200))
    assert [x for x in dd if x[0] == 3] == [(3, 1, 1, 3, 201)]
