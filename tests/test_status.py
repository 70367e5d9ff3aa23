from datetime import datetime

from pyspark.sql import functions as F

from conftest import SF
from remitflow.operators import selection as sel_ops
from remitflow.operators import status
from remitflow.plans.context import Ctx
from remitflow.sources import metadata

TS = datetime(2014, 4, 25, 9, 9, 17)


def test_final_run_then_next_run_skips_sent(spark):
    ctx = Ctx(spark, SF)
    p = ctx.params.with_(only_unsent="Y", process_type="FINAL", run_id="f1")
    _, sel = sel_ops.run_selection(spark, ctx.checks, ctx.sites, ctx.values, ctx.docs, p)
    ids = {r.check_id for r in sel.select("check_id").collect()}
    assert ids
    log = status.mark(sel, "PRINTED", "f1", TS, "FINAL")
    assert {r.check_id for r in log.collect()} == ids
    cur = status.current_checks(ctx.checks, log)
    _, again = sel_ops.run_selection(spark, cur, ctx.sites, ctx.values, ctx.docs, p.with_(run_id="f2"))
    assert not ids & {r.check_id for r in again.select("check_id").collect()}


def test_draft_run_logs_nothing(spark):
    ctx = Ctx(spark, SF)
    _, sel = sel_ops.run_selection(spark, ctx.checks, ctx.sites, ctx.values, ctx.docs, ctx.params)
    assert status.mark(sel, "PRINTED", "d1", TS, "DRAFT").count() == 0


def test_latest_status_wins(spark):
    log = spark.createDataFrame([(1, "PRINTED", "r1", datetime(2014, 1, 1)), (1, "NEW", "r2", datetime(2014, 2, 1)),
                                 (2, "PRINTED", "r1", datetime(2014, 1, 1))],
                                "check_id long, status string, run_id string, event_ts timestamp_ntz")
    got = {r.check_id: r.logged_status for r in status.latest_status(log).collect()}
    assert got == {1: "NEW", 2: "PRINTED"}


def test_unlock_needs_exactly_one_grant(spark):
    ctx = Ctx(spark, SF)
    _, sel = sel_ops.run_selection(spark, ctx.checks, ctx.sites, ctx.values, ctx.docs, ctx.params)
    users = metadata.users(spark)
    n = sel.count()
    assert status.unlock(sel, ctx.values, users, 1001, "NEW", "u", TS).count() == n   # one grant
    assert status.unlock(sel, ctx.values, users, 1004, "NEW", "u", TS).count() == 0   # two grants
    assert status.unlock(sel, ctx.values, users, 1002, "NEW", "u", TS).count() == 0   # expired grant
    assert status.unlock(sel, ctx.values, users, 1003, "NEW", "u", TS).count() == 0   # disabled grant
    out = status.grant_outcome(ctx.values, users, spark.createDataFrame([(1004,), (1005,)], "user_id long"), TS)
    got = {r.user_id: (r.retcode, r.errbuf) for r in out.collect()}
    assert got[1004] == ("1", "Contac Payables Setup Administator for Help")
    assert got[1005] == ("1", "User Does not have Access")
