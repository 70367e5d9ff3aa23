import os
from datetime import datetime

import pytest

from conftest import SF
from remitflow.operators import status
from remitflow.plans.context import Ctx
from remitflow.plans.jobs import main_job, unlock_job
from remitflow.sinks.ledger import ClaimConflict, Ledger
from remitflow.sources import metadata

T = datetime(2014, 4, 25)


def _ids(df):
    return sorted(r.check_id for r in df.select("check_id").collect())


def _rows(spark, ids):
    return spark.createDataFrame([(i, "f", "NEW") for i in ids], "check_id long, file_id string, status_before string")


def _confirm(spark, log, ids, run, when=T, code="PRINTED"):
    status.append_log(spark.createDataFrame([(i, code, when, run) for i in ids], "check_id long, status string, event_ts timestamp_ntz, run_id string"), log)


def test_two_runs_at_once_share_no_payment(spark, tmp_out):
    one, two = Ledger(spark, f"{tmp_out}/log"), Ledger(spark, f"{tmp_out}/log")
    a, b = one.state(), two.state()   # both read before either has claimed
    assert _ids(one.claim(_rows(spark, [1, 2, 3]), "a", T, a)) == [1, 2, 3]
    assert _ids(two.claim(_rows(spark, [3, 4]), "b", T, b)) == [4]
    assert _ids(two.claim(_rows(spark, [1, 2]), "c", T, b)) == []
    assert sorted((r.run_id, r.check_id) for r in one.open_claims().collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 4)]
    assert one.state().version == 2


def test_a_commit_is_created_once(spark, tmp_out):
    ledger = Ledger(spark, f"{tmp_out}/log")
    assert ledger._put(0, {"kind": "release", "run_id": "x", "last_snapshot": -1})
    assert not ledger._put(0, {"kind": "release", "run_id": "y", "last_snapshot": -1})
    assert ledger._read(0)["run_id"] == "x" and os.listdir(f"{tmp_out}/log_ledger/drafts") == []


def test_a_claim_gives_up_when_others_always_win(spark, tmp_out, monkeypatch):
    ledger = Ledger(spark, f"{tmp_out}/log")
    monkeypatch.setattr(ledger, "_put", lambda *_: False)
    with pytest.raises(ClaimConflict):
        ledger.claim(_rows(spark, [1]), "a", T, ledger.state(), tries=3)


def test_interleaved_main_runs(spark, tmp_out):
    ctx = Ctx(spark, SF)
    log = f"{tmp_out}/log"
    p = ctx.params.with_(process_type="FINAL", only_unsent="Y", run_id="slow")
    inner = {}
    plain = Ledger.claim

    def after_another(self, rows, run_id, as_of, state, **more):
        if run_id == "slow" and not inner:   # the other run starts and ends between this one's selection and claim
            inner["done"] = True
            main_job(ctx, f"{tmp_out}/b", p.with_(run_id="quick", start_date="1997/01/01 00:00:00"), status_log_path=log)
        return plain(self, rows, run_id, as_of, state, **more)

    Ledger.claim = after_another
    try:
        main_job(ctx, f"{tmp_out}/a", p, status_log_path=log)
    finally:
        Ledger.claim = plain
    rows = spark.read.parquet(log)
    slow, quick = set(_ids(rows.where("run_id = 'slow'"))), set(_ids(rows.where("run_id = 'quick'")))
    assert slow and quick and not slow & quick
    alone = main_job(ctx, f"{tmp_out}/c", p.with_(run_id="alone"), status_log_path=f"{tmp_out}/other").status_log
    assert slow | quick == set(_ids(alone))


def _bytes(folder):
    found = {}
    for top, _, names in sorted(os.walk(folder)):
        found[os.path.basename(top)] = b"".join(open(os.path.join(top, n), "rb").read() for n in sorted(names) if n.startswith("part-"))
    return {k: v for k, v in found.items() if k.startswith("file_id=")}


def test_a_crash_between_files_and_log(spark, tmp_out):
    ctx = Ctx(spark, SF)
    log = f"{tmp_out}/log"
    first = ctx.params.with_(process_type="FINAL", only_unsent="Y", run_id="r1", end_date="1997/06/30 00:00:00")
    main_job(ctx, f"{tmp_out}/a", first, status_log_path=log, confirm=False)
    files, register = _bytes(f"{tmp_out}/a/files"), _bytes(f"{tmp_out}/a/register")
    ledger = Ledger(spark, log)
    stuck = set(_ids(ledger.open_claims()))
    assert stuck
    second = main_job(ctx, f"{tmp_out}/b", first.with_(run_id="r2", end_date="1998/12/31 00:00:00"), status_log_path=log).status_log
    assert not stuck & set(_ids(second))
    again = main_job(ctx, f"{tmp_out}/a", first, status_log_path=log).status_log
    assert set(_ids(again)) == stuck and _bytes(f"{tmp_out}/a/files") == files and _bytes(f"{tmp_out}/a/register") == register
    assert ledger.open_claims().count() == 0 and not ledger.release("r1")
    # After a compaction the run can still be run again, with the same files.
    ledger.compact()
    main_job(ctx, f"{tmp_out}/a", first, status_log_path=log)
    assert _bytes(f"{tmp_out}/a/files") == files
    # A run that was given up frees its payments.
    p = first.with_(run_id="u", user_id=1001, as_of="2014/04/26 00:00:00")
    unlock_job(ctx, p, metadata.users(spark), log)
    main_job(ctx, f"{tmp_out}/c", first.with_(run_id="r4", as_of="2014/04/27 00:00:00"), status_log_path=log, confirm=False)
    assert set(_ids(ledger.open_claims())) >= stuck and ledger.release("r4") and ledger.open_claims().count() == 0
    assert stuck <= set(_ids(main_job(ctx, f"{tmp_out}/d", first.with_(run_id="r5", as_of="2014/04/28 00:00:00"), status_log_path=log).status_log))


def test_compaction_changes_no_status_and_prunes_folders(spark, tmp_out):
    log = f"{tmp_out}/log"
    ledger = Ledger(spark, log)
    assert ledger.log() is None and ledger.compact() == []
    for k in range(4):
        ledger.claim(_rows(spark, [k, k + 1, 9]), f"r {k}", datetime(2014, 1, 1 + k), ledger.state())
        _confirm(spark, log, [k, k + 1, 9], f"r {k}", datetime(2014, 1, 1 + k), "NEW" if k == 2 else "PRINTED")
    checks = spark.createDataFrame([(i, "base") for i in range(12)], "check_id long, attribute14 string")

    def now():
        return sorted(map(tuple, status.current_checks(checks, ledger.log()).collect()))

    before = now()
    assert ledger.compact() == ["r 0", "r 1", "r 2", "r 3"] and now() == before and ledger.compact() == []
    _confirm(spark, log, [1, 11], "s", datetime(2014, 2, 1), "NEW")
    assert dict(now()) == {**dict(before), 1: "NEW", 11: "NEW"}
    files = ledger.log().inputFiles()
    assert any("run_id=s" in f for f in files) and any("/snapshots/" in f for f in files)
    plan = ledger.log()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "r 0" in plan
    # An entry that is older than the snapshot's does not win; a second compaction merges states only.
    _confirm(spark, log, [9], "old", datetime(2013, 1, 1), "NEW")
    assert dict(now())[9] == "PRINTED"
    held = now()
    assert ledger.compact() == ["old", "s"] and now() == held
    assert {r.run_id for r in ledger.log().collect()} == {"r 0", "r 2", "r 3", "s"} or dict(now()) == dict(held)


def test_two_compactions_at_once(spark, tmp_out):
    log = f"{tmp_out}/log"
    _confirm(spark, log, [1, 2], "a")
    one, two = Ledger(spark, log), Ledger(spark, log)
    state = two.state()
    one.compact()
    two.state = iter([state, one.state(), one.state()]).__next__
    two.compact()
    assert Ledger(spark, log).state().version == 0 and _ids(Ledger(spark, log).log()) == [1, 2]
