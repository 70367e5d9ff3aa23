import glob
import os

from pyspark.sql import functions as F

from conftest import SF
from remitflow.plans.context import Ctx
from remitflow.plans.jobs import main_job, unlock_job
from remitflow.sources import metadata


def _bytes(folder):
    return {os.path.basename(d): b"".join(open(f, "rb").read() for f in sorted(glob.glob(os.path.join(d, "part-*"))))
            for d in glob.glob(os.path.join(folder, "file_id=*"))}


def _ids(df):
    return {r.check_id for r in df.select("check_id").collect()}


def test_main_final_run_writes_then_logs(spark, tmp_out):
    ctx = Ctx(spark, SF)
    p = ctx.params.with_(process_type="FINAL", only_unsent="Y", run_id="m1")
    log_path = os.path.join(tmp_out, "status_log")
    res = main_job(ctx, tmp_out, p, status_log_path=log_path, release_snapshots=False)
    got = _bytes(os.path.join(tmp_out, "files"))
    assert sorted(got) == ["file_id=m1-1", "file_id=m1-2", "file_id=m1-3", "file_id=m1-4"]   # doc 5: disabled format
    crlf = got["file_id=m1-2"]
    assert crlf.startswith(b"H;DOC NATION_1;1996/01/01;0\r\n") and crlf.endswith(b"\r\n")
    out = {r.file_id: r for r in spark.read.parquet(os.path.join(tmp_out, "outcome")).collect()}
    assert out["m1-5"].retcode == "1" and "DQ-03" in out["m1-5"].errbuf
    assert out["m1-1"].retcode == "0"
    assert out["m1-1"].file_name == "OUNATION_0_DOCNATION_0_2014-APR-25_09AM-09-17" and out["m1-1"].file_extension == "txt"
    logged = _ids(spark.read.parquet(log_path))
    assert _ids(res.status_log) == logged
    assert logged == _ids(res.run.selection.where(F.col("file_id") != "m1-5"))
    reg = open(sorted(glob.glob(os.path.join(tmp_out, "register", "file_id=m1-1", "part-*")))[0]).read()
    assert reg.splitlines()[1] == "Payment Register"


def test_final_runs_share_no_payment_and_a_rerun_repeats_its_files(spark, tmp_out):
    ctx = Ctx(spark, SF)
    log = os.path.join(tmp_out, "log")
    first = ctx.params.with_(process_type="FINAL", only_unsent="Y", run_id="r1", end_date="1997/06/30 00:00:00")
    main_job(ctx, os.path.join(tmp_out, "a"), first, status_log_path=log)
    main_job(ctx, os.path.join(tmp_out, "b"), ctx.params.with_(process_type="FINAL", only_unsent="Y", run_id="r2"), status_log_path=log)
    rows = spark.read.parquet(log)
    one, two, logged = _ids(rows.where("run_id = 'r1'")), _ids(rows.where("run_id = 'r2'")), rows.count()
    assert one and two and not one & two
    before = _bytes(os.path.join(tmp_out, "a", "files"))
    main_job(ctx, os.path.join(tmp_out, "a"), first, status_log_path=log)   # as after a crash
    assert _bytes(os.path.join(tmp_out, "a", "files")) == before
    assert spark.read.parquet(log).count() == logged == len(one) + len(two)
    # An authorised user makes the payments selectable again; another user does not.
    p = first.with_(run_id="u1", user_id=1002, as_of="2014/04/26 00:00:00")
    assert {(r.retcode, r.rows_updated) for r in unlock_job(ctx, p, metadata.users(spark), log).collect()} == {("1", 0)}
    out = unlock_job(ctx, p.with_(user_id=1001, run_id="u2"), metadata.users(spark), log).collect()
    assert {r.retcode for r in out} == {"0"} and sum(r.rows_updated for r in out) >= len(one)
    third = first.with_(run_id="r3", as_of="2014/04/27 00:00:00")
    main_job(ctx, os.path.join(tmp_out, "c"), third, status_log_path=log)
    assert one <= _ids(spark.read.parquet(log).where("run_id = 'r3'"))


def test_unknown_terminator_blocks_the_file_and_its_log_rows(spark, tmp_out):
    ctx = Ctx(spark, SF)
    ctx.__dict__["formats"] = metadata.formats(spark).withColumn(
        "end_of_line", F.when(F.col("format_id") == 1, F.lit("CR")).otherwise(F.col("end_of_line")))
    p = ctx.params.with_(process_type="FINAL", only_unsent="Y", run_id="t1")
    res = main_job(ctx, tmp_out, p, status_log_path=os.path.join(tmp_out, "log"), release_snapshots=False)
    blocked = {r.file_id for r in res.run.requests.where("format_id = 1").collect()}
    out = {r.file_id: r for r in spark.read.parquet(os.path.join(tmp_out, "outcome")).collect()}
    used = {r.file_id for r in res.run.totals.collect()}
    assert blocked & used and all("DQ-03" in out[f].errbuf for f in blocked & used)
    assert not {f"file_id={f}" for f in blocked} & set(_bytes(os.path.join(tmp_out, "files")))
    assert not _ids(res.status_log) & _ids(res.run.selection.where("format_id = 1"))


def test_empty_selection_produces_no_files(spark, tmp_out):
    ctx = Ctx(spark, SF)
    p = ctx.params.with_(start_date="2030/01/01 00:00:00", end_date="2030/12/31 00:00:00", run_id="e1",
                         process_type="FINAL")
    res = main_job(ctx, tmp_out, p, status_log_path=os.path.join(tmp_out, "log"))
    assert not glob.glob(os.path.join(tmp_out, "files", "file_id=*"))
    out = spark.read.parquet(os.path.join(tmp_out, "outcome")).collect()
    assert out and all(r.retcode == "1" and "DQ-01" in r.errbuf for r in out)
    assert res.status_log.count() == 0
