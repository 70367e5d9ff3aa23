"""Invariants of a rendered run (survey §5 layer d)."""
from pyspark.sql import functions as F

from conftest import SF
from remitflow.plans.context import Ctx
from remitflow.plans.jobs import bank_file_job


def test_bank_file_invariants(spark):
    run = bank_file_job(Ctx(spark, SF), hot_rows=50)   # low threshold: exercise the distributed numbering
    lines = run.lines.cache()
    tot = {r.file_id: r.trx_lines for r in run.totals.collect()}
    det = {r.file_id: r.n for r in run.paid.groupBy("file_id").agg(F.count("*").alias("n")).collect()}
    per = {(r.file_id, r.part): r.n for r in lines.groupBy("file_id", "part").agg(F.count("*").alias("n")).collect()}
    # format 1 files: payments + invoices + trailer, no header
    for f in ("run-1-1", "run-1-4"):
        assert per[(f, "BODY")] == tot[f] and per[(f, "DETAIL")] == det[f] and per[(f, "TRAILER")] == 1
        assert (f, "HEADER") not in per
    # disabled format: no file at all (DQ-03)
    assert not [k for k in per if k[0] == "run-1-5"]
    # line numbers dense 1..N per file; fixed-width parts have one width each
    for f in {k[0] for k in per}:
        nos = sorted(r.line_no for r in lines.where(F.col("file_id") == f).select("line_no").collect())
        assert nos == list(range(1, len(nos) + 1))
    widths = {(r.part, r.w) for r in lines.where(F.col("format_id") == 1)
              .select("part", F.length("value").alias("w")).distinct().collect()}
    assert widths == {("BODY", 111), ("DETAIL", 44), ("TRAILER", 100)}
    # payment ordinals are dense and in check-number order
    body = lines.where((F.col("file_id") == "run-1-1") & (F.col("part") == "BODY")).orderBy("line_no").collect()
    assert [r.seq1 for r in body] == list(range(1, len(body) + 1))
    nums = [int(r.value[16:28]) for r in body]
    assert nums == sorted(nums)
    lines.unpersist()
    # snapshots live in the checkpoint folder until released
    import os
    from remitflow.plans.jobs import release
    folders = {f.rsplit("/", 1)[0].replace("file:", "") for f in run.selection.inputFiles()}
    assert all(os.path.isdir(d) for d in folders)
    release(run)
    assert not any(os.path.isdir(d) for d in folders)
