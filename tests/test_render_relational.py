"""The relational renderer (no layout collect) gives the same bytes as the compiled one."""
from conftest import SF
from remitflow.operators import render
from remitflow.operators.render_relational import render_relational
from remitflow.plans.context import Ctx
from remitflow.plans.jobs import bank_file_job
from remitflow.sources.adapters import INVOICE_ORDER


def _rows(df):
    return sorted(tuple(r) for r in df.select("file_id", "part", "line_no", "seq1", "seq2", "seq3", "value").collect())


def _relational(ctx, run, p):
    with render.query_views(ctx.spark, selection=run.selection, paid=run.paid, invoices=ctx.invoices, requests=run.requests, totals=run.totals) as query:
        return render_relational(query, run.requests, run.selection, run.paid, run.totals, ctx.formats, ctx.fields,
                                 render.job_binds(p), list(INVOICE_ORDER), legacy=p.legacy)


def test_relational_equals_compiled(spark):
    ctx = Ctx(spark, SF)
    run = bank_file_job(ctx)
    a, b = _rows(run.lines), _rows(_relational(ctx, run, ctx.params))
    assert len(a) == len(b) and a == b


def test_relational_equals_compiled_legacy_switches(spark):
    ctx = Ctx(spark, SF)
    p = ctx.params.with_(legacy=frozenset({"Q2", "Q3", "Q6"}))
    run = bank_file_job(ctx, p, doc_ids=[2, 3])
    rows = _rows(run.lines)
    assert rows == _rows(_relational(ctx, run, p))
    assert any(r[1] == "TRAILER" and "T;" in r[-1] and not r[-1].startswith("T;") for r in rows)   # Q6


def test_relational_equals_compiled_with_binds_of_several_documents_and_keyless_order(spark):
    from remitflow.schema import FORMAT_FIELDS
    ctx = Ctx(spark, SF)
    extra = [(901, 1, "doc", "DINAMIC", None, 90, 1, 4, "NUMBER", "9999", None, "LEFT", "SELECT :PAY_DOCUMENT AS value", "BODY"),
             (902, 2, "last", "DINAMIC", None, 90, None, None, "STRING", None, None, None,
              "SELECT v AS value, o AS ord FROM VALUES ('late', 10), ('early', 9) AS t(v, o)", "BODY")]
    ctx.__dict__["fields"] = ctx.fields.unionByName(spark.createDataFrame(extra, FORMAT_FIELDS))
    run = bank_file_job(ctx)
    rows = _rows(run.lines)
    assert rows == _rows(_relational(ctx, run, ctx.params))
    assert {(r[0][-1], r[-1][-4:]) for r in rows if r[1] == "BODY" and r[0][-1] in "14"} == {("1", "   1"), ("4", "   4")}
    assert all(r[-1].endswith(";early") for r in rows if r[1] == "BODY" and r[0][-1] == "2")


def test_auto_falls_back_to_relational(spark, monkeypatch):
    from remitflow.operators import render as r
    ctx = Ctx(spark, SF)
    compiled = _rows(bank_file_job(ctx, doc_ids=[1, 2]).lines)
    monkeypatch.setattr(r, "FIELD_ROW_LIMIT", 3)
    monkeypatch.setattr(r.load_specs, "__defaults__", (3,))
    run = bank_file_job(ctx, doc_ids=[1, 2])
    assert type(run.layout).__name__ == "PartsIndex"
    assert _rows(run.lines) == compiled


def test_line_counter_is_bound_alike_in_both_forms_and_in_hot_files(spark):
    from remitflow.plans.queries import BOUND_FIELDS, _with_fields
    ctx = _with_fields(Ctx(spark, SF), BOUND_FIELDS, instead_of=3)
    run = bank_file_job(ctx, doc_ids=[1, 3])
    rows = _rows(run.lines)
    assert rows == _rows(bank_file_job(ctx, doc_ids=[1, 3], renderer="relational").lines)
    assert rows == _rows(bank_file_job(ctx, doc_ids=[1, 3], hot_rows=20).lines)
    body = [r for r in rows if r[0].endswith("-3") and r[1] == "BODY"]
    assert body and all(r[-1].endswith(f"\tL{r[5]}") for r in body)
    assert run.missing().count() == 0


def test_missing_values_are_reported_alike(spark, tmp_out):
    from remitflow.plans.jobs import main_job
    from remitflow.plans.queries import MISSING_FIELDS, _dynamic, _with_fields
    more = [_dynamic(923, 2, "HEADER", 90, "STRING", None, "SELECT file_id, CAST(NULL AS STRING) AS value FROM requests"),
            _dynamic(924, 2, "DETAIL", 90, "STRING", None, "SELECT invoice_id, invoice_num AS value FROM invoices WHERE invoice_id % 2 = 0"),
            _dynamic(925, 2, "TRAILER", 90, "STRING", None, "SELECT x FROM nowhere"), _dynamic(926, 2, "TRAILER", 91, "STRING", None, "SELECT 1 AS value"),
            _dynamic(927, 3, "BODY", 90, "STRING", None, "SELECT IF(:V_SEQUENCE3 % 2 = 0, 'even', NULL) AS value")]
    ctx = _with_fields(Ctx(spark, SF), MISSING_FIELDS + more)
    found = {r: sorted(map(str, bank_file_job(ctx, renderer=r).missing().collect())) for r in ("compiled", "relational")}
    assert found["compiled"] == found["relational"]
    assert all(any(f"definition_id={i})" in x for x in found["compiled"]) for i in (921, 922, 923, 924, 925, 927))
    outcome = {}
    for renderer in ("compiled", "relational"):
        main_job(ctx, f"{tmp_out}/{renderer}", renderer=renderer)
        outcome[renderer] = sorted((r.file_id, r.retcode, ";".join(sorted((r.errbuf or "").split("; ")))) for r in spark.read.parquet(f"{tmp_out}/{renderer}/outcome").collect())
    assert outcome["compiled"] == outcome["relational"]
    assert any("DQ-10" in e and "DQ-12" in e for _, _, e in outcome["relational"])
