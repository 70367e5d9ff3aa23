import glob
import os

import pytest
from pyspark.sql import types as T

from conftest import SF
from remitflow.plans.context import Ctx
from remitflow.plans.jobs import main_job
from remitflow.sinks import delivery, files
from remitflow.sources import metadata, rejects


def _run(spark, out, monkeypatch):
    monkeypatch.setattr(files, "PART_LINES", 100)   # several parts a file
    ctx = Ctx(spark, SF)
    return main_job(ctx, out, ctx.params)


def test_manifest_names_ordered_parts(spark, tmp_out, monkeypatch):
    res = _run(spark, tmp_out, monkeypatch)
    rows = res.manifest.collect()
    by = {}
    for r in rows:
        by.setdefault(r.file_name, []).append(r)
    assert sorted(n.rsplit(".", 1)[1] for n in by) == ["csv", "tsv", "txt", "txt"] and any(len(p) > 3 for p in by.values())
    for name, parts in by.items():
        whole = b""
        for r in sorted(parts, key=lambda r: r.part_no):
            body = open(os.path.join(tmp_out, "files", r.path), "rb").read()
            assert (r.byte_offset, r.n_bytes, r.first_line, r.n_lines) == (len(whole), len(body), whole.count(b"\n") + 1, body.count(b"\n"))
            whole += body
        assert {(r.n_parts, r.file_bytes) for r in parts} == {(len(parts), len(whole))}
        got = [x.value for x in delivery.delivered_lines(res.manifest.where(f"file_name = '{name}'"), f"{tmp_out}/files").orderBy("line_no").collect()]
        assert "".join(v + "\n" for v in got) == whole.decode("latin-1")
    assert delivery.delivery_problems(res.manifest, f"{tmp_out}/files").count() == 0
    # A part left by a failed attempt is not read; a changed one and a missing one are told.
    one, two = rows[0], rows[1]
    lines = delivery.delivered_lines(res.manifest, f"{tmp_out}/files").count()
    open(os.path.join(tmp_out, "files", f"file_id={one.file_id}", "part-99999-stray.txt"), "w").write("x\n")
    assert delivery.delivered_lines(res.manifest, f"{tmp_out}/files").count() == lines
    with open(os.path.join(tmp_out, "files", one.path), "r+b") as f:
        f.write(b"?")
    os.remove(os.path.join(tmp_out, "files", two.path))
    for crc in glob.glob(os.path.join(tmp_out, "files", "*", ".*.crc")):
        os.remove(crc)
    found = {(r.key, r.detail) for r in delivery.delivery_problems(res.manifest, f"{tmp_out}/files").collect()}
    assert found == {(one.file_id, f"{one.path}: other content"), (two.file_id, f"{two.path}: missing")}
    with pytest.raises(Exception, match="differs from its manifest"):
        delivery.delivered_lines(res.manifest, f"{tmp_out}/files").collect()


def test_own_delimiter_is_no_control_character(spark):
    lines = spark.createDataFrame([("a", 3, "x\ty"), ("b", 2, "x\ty"), ("c", 1, "plain")], "file_id string, format_id long, value string")
    assert [r.key for r in files.control_characters(lines, metadata.formats(spark)).collect()] == ["b"]
    assert sorted(r.key for r in files.control_characters(lines).collect()) == ["a", "b"]


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("amount", T.DoubleType())])


def test_reject_report_reasons(spark, tmp_out):
    open(os.path.join(tmp_out, "a.csv"), "w").write('1,"x, y",1.5\n\n2,b\nx,c,oops\n,d,3\n5,e,6,7\n6,f,0.5\n7,,8\n8,"",9\n9,g,\n')
    open(os.path.join(tmp_out, "b.csv"), "w").write("")
    got = {(r.record_no, r.kind, r.column_name, r.reason) for r in rejects.reject_report(spark, tmp_out, SCHEMA, ["id", "name"], when="amount > 1").collect()}
    assert got == {(3, "BAD", None, "too few columns"), (4, "BAD", "id", "'x' is not a bigint"), (4, "BAD", "amount", "'oops' is not a double"),
                   (5, "BAD", "id", "required value missing"), (6, "BAD", None, "too many columns"), (7, "DISCARDED", None, "not amount > 1"),
                   (8, "BAD", "name", "required value missing"), (10, "DISCARDED", None, "not amount > 1")}


def test_record_numbers_across_splits(spark, tmp_out):
    path = os.path.join(tmp_out, "big.csv")
    with open(path, "w") as f:
        f.writelines(f"{i},n{i},{'oops' if i % 97 == 0 else i}\n" for i in range(1, 3001))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        got = sorted((r.record_no, r.raw_record.split(",")[0]) for r in rejects.reject_report(spark, tmp_out, SCHEMA, ["id"]).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, str(i)) for i in range(97, 3001, 97)]


def test_stamped_category_outlives_later_entries_and_compaction(spark, tmp_out):
    from datetime import datetime

    from remitflow.operators import status
    from remitflow.sinks.ledger import Ledger
    sel = spark.createDataFrame([(1,), (2,)], "check_id long")
    log = f"{tmp_out}/log"
    ledger = Ledger(spark, log)
    checks = spark.createDataFrame([(i, "base", "own") for i in (1, 2, 3)], "check_id long, attribute14 string, attribute_category string")
    status.append_log(status.mark(sel, "PRINTED", "a", datetime(2014, 1, 1), category="SENT"), log)
    status.append_log(status.mark(sel.where("check_id = 1"), "NEW", "b", datetime(2014, 1, 2)), log)
    want = [(1, "NEW", "SENT"), (2, "PRINTED", "SENT"), (3, "base", "own")]

    def now():
        return sorted(map(tuple, status.current_checks(checks, ledger.log()).select("check_id", "attribute14", "attribute_category").collect()))

    assert now() == want
    ledger.compact()
    assert now() == want
    status.append_log(status.mark(sel.where("check_id = 2"), "NEW", "c", datetime(2013, 1, 1), category="OLD"), log)
    assert now() == want
