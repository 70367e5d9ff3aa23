"""Composed jobs: bank-file generation (MAIN), payment register (REPORT), status reset (UNLOCK).

One call plans every requested file at once; the selection is computed once
and shared by the file, the register and the status log (the reference
re-evaluated it six times per final run, quirk Q24).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as agg
from ..operators import lookups, quality, render, status
from ..operators import selection as sel_ops
from ..operators.render_relational import PartsIndex, dynamic_specs, missing_relational, render_relational
from ..operators.sequences import hot_rows_of
from ..schema import RunParams
from ..session import bounded_broadcast, drop_snapshot, materialize
from ..sinks import delivery, files
from ..sinks.ledger import Ledger
from ..sources.adapters import INVOICE_ORDER
from .context import Ctx


@dataclass
class BankFileRun:
    requests: DataFrame
    selection: DataFrame
    paid: DataFrame
    totals: DataFrame
    layout: render.Layout | PartsIndex   # compiled or relational
    lines: DataFrame
    dyn: render.DynamicValues
    specs: list[render.FieldSpec]        # all fields, or (relational) those with a query
    formats: DataFrame
    fields: DataFrame
    numbered: DataFrame | None = None    # the lines with their counters, where a query asked for one
    contexts: dict[str, DataFrame] | None = None
    checked: DataFrame | None = None     # the lines with the fields they lack (compiled renderer)

    def missing(self) -> DataFrame:
        """DQ-10 / RND-19: every dynamic field without a value, whichever renderer made the lines."""
        if isinstance(self.layout, PartsIndex):
            return missing_relational(self.requests, self.selection, self.paid, self.formats, self.fields, self.layout, self.dyn, self.contexts)
        return render.missing_values(self.requests, self.selection, self.paid, self.layout, self.dyn, self.contexts)


def bank_file_job(ctx: Ctx, params: RunParams | None = None, doc_ids=None,
                  hot_rows: int | None = None, renderer: str = "auto", log: DataFrame | None = None,
                  claim: Callable[[DataFrame], DataFrame] | None = None, claimed: DataFrame | None = None) -> BankFileRun:
    """Select, snapshot and render every requested file.

    ``log``: the status log of earlier runs; a payment's latest entry overrides its own status.

    ``claim``: called with the selection before anything is made of it; returns the payments (check_id) that stay.
    ``claimed``: what an earlier attempt of the same run has claimed; these payments have the status they had then.

    ``renderer``: ``compiled`` (layout collected and compiled into expressions),
    ``relational`` (lines ⋈ layout rows, nothing collected) or ``auto`` —
    compiled unless the layout exceeds the compiled renderer's row bound.
    """
    params = params or ctx.params
    spark = ctx.spark
    hot_rows = hot_rows if hot_rows is not None else hot_rows_of(spark)
    checks = status.current_checks(ctx.checks, log)
    if claimed is not None:
        checks = status.as_claimed(checks, claimed)
    formats = quality.usable_formats(ctx.formats)
    requests, selection = sel_ops.run_selection(spark, checks, ctx.sites, ctx.values, ctx.docs, params, doc_ids)
    # One snapshot of the selection and of its paid invoices feeds the file, the
    # register and the status log (the reference re-read them six times, Q24).
    selection = materialize(selection, "selection")
    if claim is not None:
        allowed = claim(selection)
        whole, selection = selection, materialize(selection.join(allowed, "check_id", "left_semi"), "selection")
        drop_snapshot(whole)
    paid = materialize(lookups.paid_invoices(selection, ctx.invoice_payments, ctx.invoices, ("check_number",))
                       .join(bounded_broadcast(requests.select("file_id", "format_id")), "file_id"), "paid")
    totals = materialize(agg.selection_totals(selection), "totals")   # a row a file, read for sizes, headings, trailers and outcome
    hot_files = find_hot(totals, paid, hot_rows)
    binds = render.job_binds(params)
    views = dict(selection=selection, paid=paid, invoices=ctx.invoices, requests=requests, totals=totals)
    wanted = {("invoice_id",): paid.select("invoice_id").distinct()}
    layout = None
    if renderer in ("auto", "compiled"):
        try:
            layout = render.Layout.load(formats, ctx.fields)
        except render.LayoutTooLarge:
            if renderer == "compiled":
                raise
    if layout is None:
        layout = PartsIndex.load(formats, ctx.fields)
        specs = dynamic_specs(formats, ctx.fields)
    else:
        specs = layout.specs
    numbered = contexts = checked = None
    if render.uses_line_counters(specs):
        # RND-06: a line's counter is bound into queries, so the lines are numbered before any value is fetched.
        parts = render.line_contexts(requests, selection, paid, totals, layout, list(INVOICE_ORDER), hot_rows, hot_files)
        numbered = materialize(reduce(DataFrame.unionByName, [c.withColumn("part", F.lit(p)) for p, c in parts.items()]), "numbered")
        contexts = {p: numbered.where(F.col("part") == p).drop("part") for p in parts}
        views["lines"] = numbered
    with render.query_views(spark, **views) as query:
        dyn = render.dynamic_values(query, specs, binds, params.legacy, wanted)
        if isinstance(layout, PartsIndex):
            lines = render_relational(query, requests, selection, paid, totals, formats, ctx.fields, binds,
                                      list(INVOICE_ORDER), legacy=params.legacy, hot_rows=hot_rows, hot_files=hot_files,
                                      wanted=wanted, contexts=contexts, dyn=dyn)
        else:
            checked = render.render_lines(spark, requests, selection, paid, totals, layout, dyn, list(INVOICE_ORDER),
                                          legacy=params.legacy, hot_rows=hot_rows, hot_files=hot_files, contexts=contexts)
            lines = checked.drop("missing")
    return BankFileRun(requests, selection, paid, totals, layout, lines, dyn, specs, formats, ctx.fields, numbered, contexts, checked)


def release(run: BankFileRun) -> None:
    """Delete the run's selection, paid-invoice and line snapshots from the checkpoint folder."""
    for df in (run.selection, run.paid, run.numbered):
        if df is not None:
            drop_snapshot(df)


def find_hot(totals: DataFrame, paid: DataFrame, hot_rows: int | None = None):
    """Files too large for one task (payments + invoice lines > hot_rows), from one small aggregation.

    Bounded: at most (lines / hot_rows) keys.  Hot files are numbered in one distributed pass that
    also splits huge payments.
    """
    hot_rows = hot_rows if hot_rows is not None else hot_rows_of(totals.sparkSession)
    sizes = totals.select("file_id", F.col("trx_lines").alias("_n")).unionByName(
        paid.groupBy("file_id").agg(F.count(F.lit(1)).alias("_n")))
    return [(r["file_id"],) for r in sizes.groupBy("file_id").agg(F.sum("_n").alias("_n"))
            .where(F.col("_n") > hot_rows).select("file_id").collect()]


def hot_files_of(totals: DataFrame, hot_rows: int | None = None) -> list[tuple]:
    """Files with more payments than one task numbers (at most payments / hot_rows keys)."""
    hot_rows = hot_rows if hot_rows is not None else hot_rows_of(totals.sparkSession)
    return [(r["file_id"],) for r in totals.where(F.col("trx_lines") > hot_rows).select("file_id").collect()]


def register_job(ctx: Ctx, params: RunParams | None = None, doc_ids=None, selection: DataFrame | None = None,
                 requests: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """REPORT: register text for every file, from a given selection snapshot or a fresh one."""
    from ..operators import register
    from ..schema import TITLE_VALUE_SET
    params = params or ctx.params
    if selection is None:
        requests, selection = sel_ops.run_selection(ctx.spark, ctx.checks, ctx.sites, ctx.values, ctx.docs,
                                                    params, doc_ids)
        selection = materialize(selection, "register")  # read for the totals, the sizes and the lines
    bt = ctx.bank_tables()
    chain = lookups.bank_chain(ctx.docs, bt["uses"], bt["accounts"], bt["banks"], entities=bt["entities"])
    titles = agg.title_literals(lookups.value_set(ctx.values, TITLE_VALUE_SET), params.lang)
    heading = requests.select("file_id", "payment_document_id", "as_of") \
        .join(chain.select("payment_document_id", "bank_name", "bank_account_name", "payment_document_name",
                           F.initcap("legal_entity_name").alias("legal_entity")), "payment_document_id") \
        .select("*", *titles)
    totals = materialize(agg.selection_totals(selection), "register-totals")   # read for the sizes, the heading and the footer
    return register.register_text(selection, heading, totals, hot_rows, hot_files_of(totals, hot_rows))


@dataclass
class MainResult:
    """Outputs of a MAIN run.  With ``release_snapshots=True`` (default) the frames in ``run`` read
    deleted snapshots; use the written files, ``outcome`` and ``status_log`` instead."""
    run: BankFileRun
    file_folders: list
    register_path: str
    outcome: DataFrame
    status_log: DataFrame | None
    manifest: DataFrame | None   # of the files by their names; None when no file was made


def main_job(ctx: Ctx, out_path: str, params: RunParams | None = None, doc_ids=None,
             status_log_path: str | None = None, hot_rows: int | None = None,
             release_snapshots: bool = True, confirm: bool = True, renderer: str = "auto") -> MainResult:
    """MAIN: select → (FINAL) claim → render → write bank files → register text → run outcome → (FINAL) status log.

    The selection sees the written status log and the claims of other runs, so a payment that an earlier FINAL run has
    sent, or one at the same time is about to send, is not sent again.  A FINAL run claims its payments before it writes a
    file (``sinks.ledger``); run again under its id it takes exactly those and makes the same files.  The log is
    written only after the files and the register (Q38/Q39 fixed: nothing is marked sent unless
    it is in a written file; a request with an unusable format produces no file, no claim and no log rows).

    ``confirm=False`` leaves the log out, as a run does that stops after its files; the same run id confirms later.
    """
    params = params or ctx.params
    spark = ctx.spark
    as_of, final = _moment(params.as_of), params.process_type == "FINAL"
    ledger = Ledger(spark, status_log_path) if status_log_path else None
    state = ledger.state() if ledger else None
    earlier = ledger.log(params.run_id, state) if ledger else None
    claimed = ledger.own_claim(params.run_id, state) if ledger and final else None
    producing = _producing_formats(ctx)

    def claim(selection: DataFrame) -> DataFrame:
        """The payments of requests that produce a file are claimed; the others are shown, but never sent."""
        will = F.col("format_id").isin(producing)
        rows = selection.where(will).select("check_id", "file_id", F.col("send_code").alias("status_before"))
        mine = claimed if claimed is not None else ledger.claim(rows, params.run_id, as_of, state)
        return mine.select("check_id").unionByName(selection.where(~F.coalesce(will, F.lit(False))).select("check_id"))

    run = bank_file_job(ctx, params, doc_ids, hot_rows, renderer=renderer, log=earlier, claimed=claimed,
                        claim=claim if ledger and final else None)
    shown = ["file_id", "format_id", "line_no", "value"]
    # Rendered once: written, and checked.
    lines = materialize(run.lines.select(*shown) if run.checked is None else run.checked.select(*shown, "missing"), "lines")
    folder = files.write_bank_files(lines, ctx.formats, f"{out_path}/files", requests=run.requests)
    reg = register_job(ctx, params, selection=run.selection, requests=run.requests, hot_rows=hot_rows)
    reg_path = files.write_text(reg, f"{out_path}/register")
    dq = quality.request_checks(run.requests, run.totals, ctx.formats).unionByName(files.control_characters(lines, ctx.formats))
    missing = run.missing() if run.checked is None else lines.select("file_id", F.explode("missing").alias("definition_id"))
    dq = dq.unionByName(quality.missing_by_file(missing)).unionByName(
        quality.unconverted_fields(run.requests, run.specs, run.dyn.failed))
    names = file_names(ctx, run.requests).select("file_id", "file_name", "file_extension")
    manifest = delivery.commit_manifest(names, f"{out_path}/files", f"{out_path}/manifest") if lines.limit(1).count() else None
    outcome = files.run_outcome(run.requests, run.totals, dq).join(names, "file_id", "left")
    files.append_outcome(outcome, f"{out_path}/outcome")
    log = None
    if final:
        sent = run.selection.where(F.col("format_id").isin(producing))
        log = status.mark(sent, "PRINTED", params.run_id, as_of, params.process_type, params.mark_category)
        if status_log_path and confirm:
            status.append_log(log, status_log_path)
            log = spark.read.schema(status.LOG_SCHEMA).parquet(status_log_path).where(F.col("run_id") == params.run_id)
    drop_snapshot(lines)
    if release_snapshots:
        release(run)
    return MainResult(run, [folder], reg_path, outcome, log, manifest)


def _producing_formats(ctx: Ctx) -> list[int]:
    """Formats that render at least one part: a request of another one produces no file."""
    index = PartsIndex.load(quality.usable_formats(ctx.formats), ctx.fields)
    return sorted({f for part in ("HEADER", "BODY", "DETAIL", "TRAILER") for f in index.formats_with(part)})


def _moment(text: str) -> datetime:
    return datetime.strptime(text, "%Y/%m/%d %H:%M:%S")


def unlock_job(ctx: Ctx, params: RunParams, users: DataFrame, status_log_path: str, doc_ids=None) -> DataFrame:
    """UNLOCK: reset the payments that the request selects to ``params.set_status`` (NEW if not given).

    Allowed to a user with exactly one grant.  Sent and unsent payments are selected alike (Q10), as the
    status log has them.  Returns one row per request: retcode, errbuf, rows_updated.
    """
    spark = ctx.spark
    p = params.with_(only_unsent="N")
    checks = status.current_checks(ctx.checks, Ledger(spark, status_log_path).log(p.run_id))
    requests, selection = sel_ops.run_selection(spark, checks, ctx.sites, ctx.values, ctx.docs, p, doc_ids)
    selection = materialize(selection.select("file_id", "check_id"), "unlock")
    rows = status.unlock(selection, ctx.values, users, p.user_id, p.set_status or "NEW", p.run_id, _moment(p.as_of))
    status.append_log(rows, status_log_path)
    written = spark.read.schema(status.LOG_SCHEMA).parquet(status_log_path).where(F.col("run_id") == p.run_id)
    me = spark.createDataFrame([(p.user_id,)], "user_id long")
    grant = status.grant_outcome(ctx.values, users, me, _moment(p.as_of)).select("retcode", "errbuf")
    out = materialize(requests.select("run_id", "file_id").join(status.rows_updated(written, selection), "file_id", "left")
                      .crossJoin(F.broadcast(grant))  # one row
                      .select("run_id", "file_id", "retcode", "errbuf", F.coalesce("rows_updated", F.lit(0)).alias("rows_updated")), "unlock-outcome")
    drop_snapshot(selection)
    return out


def file_names(ctx: Ctx, requests: DataFrame) -> DataFrame:
    """SNK-04 / JN-06: per request, ``<unit>_<document>_<run time>`` sanitised to [A-Za-z0-9_-] and the
    format's extension."""
    from ..functions.masks import to_char_date
    bt = ctx.bank_tables()
    chain = lookups.bank_chain(ctx.docs, bt["uses"], bt["accounts"], bt["banks"], units=bt["units"])
    stamp = to_char_date(F.col("as_of"), "YYYY-MON-DD_HHAM-MI-SS")
    raw = F.concat_ws("_", F.col("name"), F.col("payment_document_name"), stamp)
    return requests.select("file_id", "payment_document_id", "format_id", "as_of") \
        .join(chain.select("payment_document_id", "name", "bank_party_id", "bank_account_id",
                           "payment_document_name"), "payment_document_id") \
        .join(bounded_broadcast(ctx.formats.select("format_id", "file_extension")), "format_id", "left") \
        .select("file_id", "bank_party_id", "bank_account_id",
                F.regexp_replace(raw, "[^A-Za-z0-9_-]", "").alias("file_name"), "file_extension")
