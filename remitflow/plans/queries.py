"""Registered queries: one per operator group of the inventory, each (spark, sf_dir) -> DataFrame.

Every query reads the payment tables (orders / lineitem / customer / part) so
its work grows with the data; configuration tables only ever join to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decimal import Decimal

from ..functions.masks import to_char_date
from ..functions.text import number_text
from ..operators import aggregate as agg
from ..operators import lookups
from ..operators import selection as sel_ops
from ..schema import TITLE_VALUE_SET
from ..session import bounded_broadcast, materialize
from ..sources import adapters
from ..sources.adapters import INVOICE_ORDER
from .context import Ctx
from .jobs import hot_files_of


def _selection(ctx: Ctx, params=None, doc_ids=None):
    return sel_ops.run_selection(ctx.spark, ctx.checks, ctx.sites, ctx.values, ctx.docs,
                                 params or ctx.params, doc_ids)


def check_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    _, sel = _selection(ctx)
    return sel_ops.register_rows(sel)





def selection_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01: payments and total per file."""
    ctx = Ctx(spark, sf_dir)
    _, sel = _selection(ctx)
    return agg.selection_totals(sel)


def legacy_batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02 / FLT-10/11: G1 totals per file and batch (EFT, unsent, batch predicate)."""
    ctx = Ctx(spark, sf_dir)
    req = sel_ops.build_requests(ctx.docs, ctx.params.with_(only_unsent="Y"))
    sel = sel_ops.select_legacy(ctx.checks, req, sel_ops.params_envelope(ctx.params))
    return agg.amount_totals(sel, ["file_id", "checkrun_id"])


def optional_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-04/06 with a lower number bound only and an upper amount bound only (Q33)."""
    ctx = Ctx(spark, sf_dir)
    p = ctx.params.with_(doc_ini=5000, doc_fin=None, base_amount=None, top_amount=Decimal("150000.00"))
    _, sel = _selection(ctx, p)
    return sel_ops.register_rows(sel)


def report_lines(spark: SparkSession, sf_dir: str, legacy: bool = False) -> DataFrame:
    """AGG-03/04: payment + invoice lines per file, with the file total."""
    ctx = Ctx(spark, sf_dir)
    _, sel = _selection(ctx)
    return agg.report_lines(sel, ctx.invoice_payments, legacy_product=legacy)


def report_lines_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-12 / Q14: the reference's predicate-less count, as a product of counts."""
    return report_lines(spark, sf_dir, legacy=True)


def paid_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-07: selected payments ⋈ invoice payments ⋈ invoices."""
    ctx = Ctx(spark, sf_dir)
    _, sel = _selection(ctx)
    p = lookups.paid_invoices(sel, ctx.invoice_payments, ctx.invoices)
    return p.select("file_id", "check_id", "invoice_id", "invoice_num", *INVOICE_ORDER[0:1], "supplier_ref",
                    "amount_paid")


def invoice_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-06 / JN-16: 'DOCUMENTOS: ' list of every invoice a selected payment pays, ordered."""
    ctx = Ctx(spark, sf_dir)
    _, sel = _selection(ctx)
    sel = materialize(sel.select("file_id", "check_id"), "invoice-list")
    ip = sel.join(ctx.invoice_payments, "check_id")
    named = lookups.invoice_number(ip, ctx.invoices)
    return sel.join(agg.invoice_list(named, list(INVOICE_ORDER), hot_keys=_hot_payments(ip)), "check_id")


def _hot_payments(invoice_payments: DataFrame) -> list[tuple]:
    """Payments with more invoices than one task lists, from the invoice payments alone."""
    from ..operators.sequences import hot_groups, hot_rows_of
    return hot_groups(invoice_payments, ["check_id"], hot_rows_of(invoice_payments.sparkSession))


def supplier_bank_lines(spark: SparkSession, sf_dir: str, account_use: int | None = None) -> DataFrame:
    """RND-20: the G1 six-field supplier bank file for every bank account use, or one of them (FLT-03/10/12, JN-08/09)."""
    ctx = Ctx(spark, sf_dir)
    c = ctx.checks.where(
        sel_ops.seconds_range(F.col("check_date"), "1996/01/01 00:00:00", "1996/12/31 23:59:59")
        & (F.col("payment_method_code") == "EFT") & F.col("void_date").isNull())
    if account_use is not None:
        c = c.where(F.col("ce_bank_acct_use_id") == account_use)
    c = materialize(c.select("check_id", "vendor_id", "ce_bank_acct_use_id", "amount", "check_date"), "supplier-payments")
    sup = lookups.supplier_bank(adapters.supplier_bank_accounts(spark, sf_dir), vendors=c)
    ip = c.select("check_id").join(ctx.invoice_payments, "check_id")
    lists = agg.invoice_list(lookups.invoice_number(ip, ctx.invoices), list(INVOICE_ORDER), hot_keys=_hot_payments(ip))
    j = c.join(sup, "vendor_id").join(lists, "check_id", "left")
    line = F.concat_ws(
        "", F.replace(F.col("bank_account_num"), F.lit("-"), F.lit("")), F.lit(";"),
        F.replace(F.col("bank_account_name"), F.lit(";"), F.lit(",")), F.lit(";;"),
        number_text(F.col("amount")), F.lit(";"), to_char_date(F.col("check_date"), "DDMMYYYY"), F.lit(";"),
        F.replace(F.coalesce(F.col("invoices"), F.lit("DOCUMENTOS: ")), F.lit(";"), F.lit(",")))
    return j.select("ce_bank_acct_use_id", "check_id", "bank_account_num", line.alias("line"))


def supplier_bank_lines_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-12: the supplier bank file of one bank account use."""
    return supplier_bank_lines(spark, sf_dir, account_use=2)


def value_set_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-03 / FLX-06 / FLT-14: selected payments per status meaning in every language."""
    ctx = Ctx(spark, sf_dir)
    _, sel = _selection(ctx)
    labels = bounded_broadcast(lookups.value_set(ctx.values, "XX_EFT_STATUS_CHECK"))
    counts = sel.groupBy("file_id", "send_code").agg(F.count(F.lit(1)).alias("n_checks"))
    return counts.join(labels, counts.send_code == labels.code).select(
        "file_id", "send_code", "language", "meaning", "n_checks")


def register_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-05 / AGG-10 / RPT-05: per file, localised titles, bank chain names and totals."""
    ctx = Ctx(spark, sf_dir)
    req, sel = _selection(ctx)
    bt = ctx.bank_tables()
    chain = lookups.bank_chain(ctx.docs, bt["uses"], bt["accounts"], bt["banks"], entities=bt["entities"])
    titles = agg.title_literals(lookups.value_set(ctx.values, TITLE_VALUE_SET), ctx.params.lang)
    tot = agg.selection_totals(sel)
    out = req.select("file_id", "payment_document_id").join(tot, "file_id") \
        .join(chain.select("payment_document_id", "bank_name", "bank_account_name", "payment_document_name",
                           F.initcap("legal_entity_name").alias("legal_entity")), "payment_document_id")
    return out.select("*", *titles).drop("payment_document_id")


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-06 / SNK-04: sanitised file name (unit, document, run time) and extension per non-empty file."""
    from .jobs import file_names as names_of
    ctx = Ctx(spark, sf_dir)
    req, sel = _selection(ctx)
    return names_of(ctx, req).join(agg.selection_totals(sel).select("file_id"), "file_id")


def assigned_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-18 / DQ-03: per non-empty file, the document's format and whether it can be rendered."""
    ctx = Ctx(spark, sf_dir)
    req, sel = _selection(ctx)
    f = ctx.formats.select("format_id", "format_name", "enable_flag")
    out = req.select("file_id", "payment_document_id", "format_id") \
        .join(agg.selection_totals(sel), "file_id").join(bounded_broadcast(f), "format_id", "left")
    status = (F.when(F.col("format_id").isNull(), F.lit("NO FORMAT"))
              .when(F.col("format_name").isNull(), F.lit("UNKNOWN FORMAT"))
              .when(F.col("enable_flag") != "Y", F.lit("DISABLED"))
              .otherwise(F.lit("OK")))
    return out.select("file_id", "payment_document_id", "format_id", "format_name", "trx_lines",
                      status.alias("format_status"))


def format_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-09 / RND-18: which parts each non-empty file will contain."""
    ctx = Ctx(spark, sf_dir)
    req, sel = _selection(ctx)
    parts = agg.format_parts(ctx.fields, ctx.formats)
    return req.select("file_id", "format_id").join(agg.selection_totals(sel).select("file_id"), "file_id") \
        .join(bounded_broadcast(parts), "format_id")


def latest_batch_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-19 / AGG-05 / FLT-20: name of the latest payment of each automatic batch."""
    ctx = Ctx(spark, sf_dir)
    return lookups.latest_batch_name(ctx.checks)


def _bank_run(spark: SparkSession, sf_dir: str):
    from .jobs import bank_file_job
    return bank_file_job(Ctx(spark, sf_dir))


def _body_det(run):
    from ..operators.render import sequence_lines
    from .jobs import find_hot
    return sequence_lines(run.selection, run.paid, run.layout, list(INVOICE_ORDER), None, find_hot(run.totals, run.paid))


def seq_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-01 / WIN-03: payment ordinal and running line counter per file."""
    body, _ = _body_det(_bank_run(spark, sf_dir))
    return body.select("file_id", "check_id", "seq1", "seq3")


def seq_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-02 / WIN-03: invoice ordinal within its payment, payment ordinal, line counter."""
    _, det = _body_det(_bank_run(spark, sf_dir))
    return det.select("file_id", "check_id", "invoice_id", "seq1", "seq2", "seq3")


def _numbered_lines(spark, sf_dir):
    return _bank_run(spark, sf_dir).lines


def bank_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAIN flagship: (file_id, part, line_no, value) of every file of the run."""
    return _numbered_lines(spark, sf_dir).select("file_id", "part", "line_no", "value")


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-04 / SET-01: every line's place in its file (header, payment, its invoices…, trailer)."""
    return _numbered_lines(spark, sf_dir).select("file_id", "part", "seq1", "seq2", "line_no")


def fixed_width_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-01..19: fixed-width files (constants, sequences, dynamic fields, masks, padding, totals)."""
    return _numbered_lines(spark, sf_dir).where(F.col("format_id") == 1).select("file_id", "part", "line_no", "value")


def delimited_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-12/13/14/17: delimited files with header and trailer, delimiter stripping, last-char drop."""
    return _numbered_lines(spark, sf_dir).where(F.col("format_id").isin(2, 3)) \
        .select("file_id", "part", "line_no", "value")


def written_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-01/02/03: the bytes of the written bank files, read back one row per line (a CRLF line ends in CR)."""
    from ..session import new_scratch_path
    from ..sinks.files import write_bank_files
    ctx = Ctx(spark, sf_dir)
    run = _bank_run(spark, sf_dir)
    path = write_bank_files(run.lines, ctx.formats, new_scratch_path(spark, "bank-files"), requests=run.requests)
    raw = spark.read.schema("value string, file_id string").option("lineSep", "\n").text(path)
    return raw.select("file_id", F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("value"))


def _with_fields(ctx: Ctx, rows: list[tuple], instead_of: int | None = None) -> Ctx:
    """``ctx`` with more layout fields, instead of those of a format where one is named."""
    from ..schema import FORMAT_FIELDS
    own = ctx.fields if instead_of is None else ctx.fields.where(F.col("format_id") != instead_of)
    ctx.__dict__["fields"] = own.unionByName(ctx.spark.createDataFrame(rows, FORMAT_FIELDS))
    return ctx


def _dynamic(fid: int, fmt: int, part: str, seq: int, kind: str, mask: str | None, sql: str) -> tuple:
    return (fid, fmt, f"f{fid}", "DINAMIC", None, seq, None, None, kind, mask, None, None, sql, part)


BOUND_FIELDS = [
    _dynamic(911, 3, "BODY", 1, "NUMBER", "999", "SELECT :PAY_DOCUMENT AS value"),
    _dynamic(912, 3, "BODY", 2, "NUMBER", "999999999", "SELECT :V_TRX_LINES AS value"),
    _dynamic(913, 3, "BODY", 3, "NUMBER", "9999999990.00", "SELECT s.amount FROM selection s WHERE s.check_id = :CHECK_ID"),
    _dynamic(914, 3, "BODY", 4, "NUMBER", "999999999", "SELECT check_id, check_number AS value FROM selection WHERE check_number >= :P_DOC_INI"),
    _dynamic(915, 3, "BODY", 5, "STRING", None,
             "SELECT check_id, 'batch' AS value FROM selection /*SQLS_ALT*/ SELECT check_id, 'range' AS value FROM selection"),
    _dynamic(916, 3, "DETAIL", 1, "STRING", None, "SELECT invoice_num AS value FROM invoices WHERE invoice_id = :INVOICEID"),
    _dynamic(918, 3, "BODY", 6, "STRING", None, "SELECT concat('L', CAST(:V_SEQUENCE3 AS STRING)) AS value"),
    _dynamic(919, 3, "DETAIL", 2, "NUMBER", "999999999",
             "SELECT p.line_number + 10 * :V_SEQUENCE3 AS value, p.line_number AS ord FROM paid p WHERE p.check_id = :IDCHECK AND p.invoice_id = :INVOICEID"),
    _dynamic(917, 3, "TRAILER", 1, "NUMBER", "9999999999990.00", "SELECT :V_SUM_TRANS AS value"),
]


def bound_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-06/07/08: a layout that binds the document, totals, payment, invoice and the line's counter, an unset parameter, and an
    alternative."""
    from .jobs import bank_file_job
    ctx = _with_fields(Ctx(spark, sf_dir), BOUND_FIELDS, instead_of=3)
    return bank_file_job(ctx, doc_ids=[1, 3]).lines.where("format_id = 3").select("file_id", "part", "value")


VARIANT_FIELDS = [
    _dynamic(931, 3, "BODY", 1, "STRING", None, "SELECT check_id, invoice_num AS value, line_number AS ord FROM paid"),
    _dynamic(932, 3, "BODY", 2, "DATE", "Month DD, RRRR", "SELECT check_id, check_date AS value FROM selection"),
    _dynamic(933, 3, "BODY", 3, "DATE", "Q/DDD", "SELECT check_id, check_date AS value FROM selection"),
    _dynamic(934, 3, "BODY", 4, "NUMBER", "S999,999.00", "SELECT check_id, amount AS value FROM selection"),
    _dynamic(935, 3, "BODY", 5, "NUMBER", "$999,999.00MI", "SELECT check_id, amount AS value FROM selection"),
    _dynamic(936, 3, "BODY", 6, "NUMBER", "999999999999", "SELECT check_id, concat('10-', CAST(check_number AS STRING)) AS value FROM selection"),
]
NO_BODY_FIELDS = [
    (941, 2, "f941", "CONSTANT", "H", 1, None, None, "STRING", None, None, None, None, "HEADER"),
    _dynamic(942, 2, "DETAIL", 1, "STRING", None, "SELECT invoice_id, invoice_num AS value FROM invoices"),
    (943, 2, "f943", "TRX_LINES", None, 1, None, None, "NUMBER", "999999999", None, None, None, "TRAILER"),
]


def layout_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-05 / FLT-21 / LIM-01 / FN-06/07/10 / RND-16: several rows per key with ``ord``, name, quarter and sign masks, the
    legacy numeric fetch, and a layout with DETAIL but no BODY, which prints no invoice."""
    from .jobs import bank_file_job
    ctx = _with_fields(_with_fields(Ctx(spark, sf_dir), VARIANT_FIELDS, instead_of=3), NO_BODY_FIELDS, instead_of=2)
    lines = bank_file_job(ctx, ctx.params.with_(legacy=frozenset({"Q26"})), doc_ids=[2, 3]).lines
    return lines.select("file_id", "part", "line_no", "value")


MIGRATED = {1: "7", 3: "6"}   # document -> id its legacy layout gets


def migrated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DML-03..06 / PRJ-03/04 / SRC-05/15/16 / JN-15 / FN-21/29/30/31: every legacy layout migrated (ids filled in,
    orphans and one format deleted by name), two of them rendering selected payments."""
    from ..operators import formats as fm
    from ..sources import metadata
    from .jobs import bank_file_job
    ctx = Ctx(spark, sf_dir)
    legacy = fm.only_format(metadata.legacy_formats(spark), "id_master", None)
    detail = fm.backfill_ids(metadata.legacy_format_fields(spark), "id_file_format", ["id_master", "secuence"])
    top = ctx.formats.agg(F.max("format_id")).first()[0]
    formats, fields = fm.migrate_formats(legacy, detail, int(top), 10_000, faithful=False)
    formats, fields = fm.without_named(ctx.formats.unionByName(formats), ctx.fields.unionByName(fields), " OLD unused ")
    fmt = F.col("attribute11")
    for doc, layout in MIGRATED.items():
        fmt = F.when(F.col("payment_document_id") == doc, F.lit(layout)).otherwise(fmt)
    ctx.__dict__.update(formats=formats, fields=fields, docs=ctx.docs.withColumn("attribute11", fmt))
    return bank_file_job(ctx, doc_ids=list(MIGRATED)).lines.select("file_id", "part", "line_no", "value")


MISSING_SQL = "SELECT check_id, vendor_name AS value FROM selection WHERE amount > 100000"
NOT_A_NUMBER_SQL = "SELECT check_id, vendor_name AS value FROM selection"
MISSING_FIELDS = [_dynamic(921, 1, "BODY", 90, "STRING", None, MISSING_SQL), _dynamic(922, 1, "BODY", 91, "NUMBER", "999", NOT_A_NUMBER_SQL)]


def dq_dynamic_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-10 / RND-19: payments for which a layout's query has no row, or a value of the wrong type."""
    from ..operators import quality
    from .jobs import bank_file_job
    ctx = _with_fields(Ctx(spark, sf_dir), MISSING_FIELDS)
    run = bank_file_job(ctx)
    return quality.dynamic_values_missing(run.missing(), run.specs)


def dq_dynamic_values_relational(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-10 / RND-19: the same report by the relational renderer, for layouts of any size."""
    from ..operators import quality
    from .jobs import bank_file_job
    ctx = _with_fields(Ctx(spark, sf_dir), MISSING_FIELDS)
    run = bank_file_job(ctx, renderer="relational")
    return quality.dynamic_values_missing(run.missing(), run.specs)


# ---------------------------------------------------------------------------
# Register text, status log, unlock
# ---------------------------------------------------------------------------

def register_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-01..04 / FN-08 / FN-28: the payment register, line by line, per file."""
    from .jobs import register_job
    return register_job(Ctx(spark, sf_dir))


def register_text_es(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-05 / FLT-14 / Q21: the same register in Spanish (titles and status meanings by one lang argument)."""
    from .jobs import register_job
    ctx = Ctx(spark, sf_dir)
    return register_job(ctx, ctx.params.with_(lang="ESA"))


FINAL_1 = dict(run_id="final-1", only_unsent="Y", process_type="FINAL", start_date="1996/01/01 00:00:00",
               end_date="1997/12/31 00:00:00")


def _final_run(ctx: Ctx):
    from ..operators import status
    p = ctx.params.with_(**FINAL_1)
    _, sel = _selection(ctx, p)
    return status.mark(sel, "PRINTED", p.run_id, _as_of(p), p.process_type)


def _as_of(p):
    from datetime import datetime
    return datetime.strptime(p.as_of, "%Y/%m/%d %H:%M:%S")


def mark_printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DML-01 / DML-07: a FINAL run's status-log rows (PRINTED and the stamped context for every payment in its files)."""
    from ..operators import status
    ctx = Ctx(spark, sf_dir)
    p = ctx.params.with_(**FINAL_1, mark_category="SENT")
    _, sel = _selection(ctx, p)
    return status.mark(sel, "PRINTED", p.run_id, _as_of(p), p.process_type, p.mark_category)


def current_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-06: every payment's status after the FINAL run (latest log entry, else its own column)."""
    from ..operators import status
    ctx = Ctx(spark, sf_dir)
    cur = status.current_checks(ctx.checks, _final_run(ctx))
    return cur.select("check_id", F.col("attribute14").alias("status_code"))


def unsent_after_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-02: the next run over a wider window only takes payments the FINAL run did not send."""
    from ..operators import status
    ctx = Ctx(spark, sf_dir)
    log = materialize(_final_run(ctx), "status-log")   # as a run finds it: written, not planned anew
    p = ctx.params.with_(run_id="final-2", only_unsent="Y", process_type="FINAL")
    cur = status.current_checks(ctx.checks, log)
    _, sel = sel_ops.run_selection(ctx.spark, cur, ctx.sites, ctx.values, ctx.docs, p)
    return sel_ops.register_rows(sel)


def rows_updated_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-11 / DML-07: payments whose status a run changes, per file: all of a FINAL run's, none of a DRAFT run's."""
    from ..operators import status
    ctx = Ctx(spark, sf_dir)
    out = []
    for kind in ("FINAL", "DRAFT"):
        p = ctx.params.with_(**{**FINAL_1, "process_type": kind})
        _, sel = _selection(ctx, p)
        n = status.rows_updated(status.mark(sel, "PRINTED", p.run_id, _as_of(p), kind), sel)
        out.append(agg.selection_totals(sel).join(n, "file_id", "left").select(
            F.lit(kind).alias("process_type"), "file_id", F.coalesce("rows_updated", F.lit(0)).cast("bigint").alias("rows_updated")))
    return out[0].unionByName(out[1])


def status_by_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLX-05 / Q35: the unsent payments when the status column is found through the segment metadata."""
    from ..operators import flexfield
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    checks = flexfield.with_resolved_column(ctx.checks, metadata.flex_segments(spark), "Send Mark", "status_column")
    _, sel = sel_ops.run_selection(spark, checks, ctx.sites, ctx.values, ctx.docs, ctx.params.with_(only_unsent="Y"), status_col="status_column")
    return sel.select("file_id", "check_id", "send_code")


def flex_sql_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLX-04: a segment whose default is a query, for payments of its context."""
    from ..operators import flexfield
    ctx = Ctx(spark, sf_dir)
    segments = spark.createDataFrame(
        [("COURIER", "ATTRIBUTE5", "Delivery Window", 1, None, "S", "SELECT w FROM VALUES ('LATE'), ('EARLY') AS t(w) ORDER BY w")],
        "context_code string, application_column_name string, end_user_column_name string, column_seq_num int, value_set_name string, "
        "default_type string, default_value string")
    return flexfield.project_context(ctx.checks, segments, ["check_id"])


def dq_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-02/06/07: requests without a mandatory parameter, amounts outside their domain, required values missing; of all
    requests and payments, whatever their method."""
    from ..operators import quality
    ctx = Ctx(spark, sf_dir)
    requests = sel_ops.build_requests(ctx.docs, ctx.params.with_(end_date=None))
    return (quality.required_parameters(requests).unionByName(quality.amount_domain(ctx.checks, width=7))
            .unionByName(quality.required_columns(ctx.checks, ["attribute2", "attribute14"])))


def second_final_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAIN / ST-02: two FINAL runs through the whole job with one written status log; what the second one sent."""
    from ..session import new_scratch_path
    from .jobs import main_job
    ctx = Ctx(spark, sf_dir)
    out, log = new_scratch_path(spark, "main-runs"), new_scratch_path(spark, "status-log")
    main_job(ctx, f"{out}/1", ctx.params.with_(**FINAL_1), status_log_path=log)
    second = ctx.params.with_(run_id="final-2", only_unsent="Y", process_type="FINAL")
    return main_job(ctx, f"{out}/2", second, status_log_path=log).status_log.select("check_id", "status", "run_id")


def crashed_final_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAIN / ST-02: a FINAL run stops between its files and its log, another one with a wider window follows, then the
    first is run again under its id: what each of them has sent."""
    from ..session import new_scratch_path
    from .jobs import main_job
    ctx = Ctx(spark, sf_dir)
    out, log = new_scratch_path(spark, "main-runs"), new_scratch_path(spark, "status-log")
    first = ctx.params.with_(**FINAL_1)
    second = ctx.params.with_(run_id="final-2", only_unsent="Y", process_type="FINAL")
    main_job(ctx, f"{out}/1", first, status_log_path=log, confirm=False)
    two = main_job(ctx, f"{out}/2", second, status_log_path=log).status_log
    one = main_job(ctx, f"{out}/1", first, status_log_path=log).status_log
    return one.unionByName(two).select("check_id", "status", "run_id")


def compacted_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-06: every payment's status after a FINAL run, a compaction of the log and a second FINAL run."""
    from ..operators import status
    from ..session import new_scratch_path
    from ..sinks.ledger import Ledger
    from .jobs import main_job
    ctx = Ctx(spark, sf_dir)
    out, log = new_scratch_path(spark, "main-runs"), new_scratch_path(spark, "status-log")
    main_job(ctx, f"{out}/1", ctx.params.with_(**FINAL_1), status_log_path=log)
    Ledger(spark, log).compact()
    main_job(ctx, f"{out}/2", ctx.params.with_(run_id="final-2", only_unsent="Y", process_type="FINAL"), status_log_path=log)
    return status.current_checks(ctx.checks, Ledger(spark, log).log()).select("check_id", F.col("attribute14").alias("status_code"))


USER_IDS = [1001, 1002, 1003, 1004, 1005]


def unlock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DML-02 / JN-10: an authorised user resets every selected payment (sent or not, Q10) to NEW."""
    from ..operators import status
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    p = ctx.params.with_(run_id="unlock-1", only_unsent="N")
    _, sel = _selection(ctx, p)
    return status.unlock(sel, ctx.values, metadata.users(spark), 1001, "NEW", p.run_id, _as_of(p))


def unlock_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-08 / AGG-11: per requesting user, grant count, return code, message and rows reset."""
    from ..operators import status
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    p = ctx.params.with_(only_unsent="N")
    _, sel = _selection(ctx, p)
    users = spark.createDataFrame([(u,) for u in USER_IDS], "user_id long")
    o = status.grant_outcome(ctx.values, metadata.users(spark), users, _as_of(p))
    n = sel.agg(F.count(F.lit(1))).scalar()
    return o.select("user_id", "n_grants", "retcode", "errbuf",
                    F.when(F.col("retcode") == "0", n).otherwise(F.lit(0)).cast("bigint").alias("rows_updated"))


# ---------------------------------------------------------------------------
# Flexfield, data quality, landing files
# ---------------------------------------------------------------------------

def flex_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLX-01 / FLX-03 / FLX-05: attribute columns → named columns of each payment's context, defaults applied."""
    from ..operators import flexfield
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    return flexfield.project_context(ctx.checks, metadata.flex_segments(spark), ["check_id", "attribute_category"])


def flex_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLX-02: (payment, context, segment, value) for every non-NULL segment value."""
    from ..operators import flexfield
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    return flexfield.unpivot(ctx.checks, metadata.flex_segments(spark))


def dq_segment_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-05/06/07: every payment's segment values against the rules of the metadata."""
    from ..operators import flexfield
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    return flexfield.segment_rules(ctx.checks, metadata.flex_segments(spark), metadata.flex_rules(spark), metadata.flex_domains(spark))


def dq_flex_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-05 / Q36: segment values (after defaults) outside their value set."""
    from ..operators import flexfield
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    return flexfield.domain_violations(ctx.checks, metadata.flex_segments(spark), metadata.flex_domains(spark))


def dq_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-01 / DQ-03: requests that produce no file (empty selection, unusable format)."""
    from ..operators import quality
    ctx = Ctx(spark, sf_dir)
    req, sel = _selection(ctx)
    return quality.request_checks(req, agg.selection_totals(sel), ctx.formats)


def ingest_file_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13/14 / SNK-09/10 / DQ-09: land events as CSV files (one folder per event type, values of
    'error' events unparsable), load them with quarantine and report each file's batch status."""
    import uuid
    from pyspark.sql import types as T
    from ..session import scratch_path
    from ..sources import ingest
    from ..sources.tables import table
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    landing = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    ev.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id",
              F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
              .alias("value"), "event_type") \
        .write.partitionBy("event_type").option("header", "false").csv(landing)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    land = ingest.load_landing(spark, landing, schema, ["event_id", "value"])
    st = land.file_status.withColumn("event_type", F.regexp_extract("file_path", "event_type=([^/]+)/", 1))
    return st.groupBy("event_type", "status").agg(
        F.sum("n_good").cast("bigint").alias("n_good"), F.sum("n_bad").cast("bigint").alias("n_bad"))


def _landed_events(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Events as landing files: a folder for each type and thousand of ids, lines in the order of ids; values of 'error' events
    do not parse, every 50th line lacks its value, every 60th has a column too many."""
    from ..sources.tables import table
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    value = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.format_string("%.2f", "value"))
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.when(F.col("user_id") % 40 == 0, F.lit("")).otherwise(F.col("user_id").cast("string")),
                       F.when(F.col("event_id") % 50 != 0, value), F.when(F.col("event_id") % 60 == 7, F.lit("more")))
    folder = F.floor(F.col("event_id") / 1000).alias("thousand")
    ev.select("event_type", folder, "event_id", line.alias("value")).repartition("event_type", "thousand") \
        .sortWithinPartitions("event_type", "thousand", "event_id").select("event_type", "thousand", "value") \
        .write.partitionBy("event_type", "thousand").text(path)


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-09 / SRC-13: bad and discarded records of landed files, with their number in the file and the reason."""
    from pyspark.sql import types as T
    from ..session import new_scratch_path
    from ..sources import rejects
    landing = new_scratch_path(spark, "landing")
    _landed_events(spark, sf_dir, landing)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    found = rejects.reject_report(spark, landing, schema, ["event_id", "user_id"], when="value >= 2")
    return found.select(F.regexp_extract("file_path", "event_type=([^/]+)/", 1).alias("event_type"),
                        F.regexp_extract("file_path", "thousand=([0-9]+)/", 1).cast("bigint").alias("thousand"),
                        "record_no", "kind", "column_name", "reason", "raw_record")


def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-01: two waves of landed events through the stream, the second batch tried again as after a failure; the rows taken
    (files of 'error' events hold values that do not parse: nothing of them is)."""
    from pyspark.sql import types as T
    from ..session import new_scratch_path
    from ..sources.tables import table
    from ..streaming.landing import forget_last_commit, start_landing_stream
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    at = {k: new_scratch_path(spark, f"stream-{k}") for k in ("landing", "good", "rejected", "status", "checkpoint")}
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])

    def run() -> None:
        start_landing_stream(spark, at["landing"], schema, ["event_id", "value"], at["good"], at["rejected"], at["status"], at["checkpoint"]).awaitTermination()

    for wave in (0, 1):
        own = ev.where(F.col("event_id") % 2 == wave)
        own.where("event_type <> 'error'").select("event_id", "user_id", "value").write.mode("append").csv(at["landing"])
        own.where("event_type = 'error'").select("event_id", "user_id", F.lit("n/a").alias("value")).write.mode("append").csv(at["landing"])
        run()
    forget_last_commit(spark, at["checkpoint"])
    run()
    return spark.read.parquet(at["good"]).select("event_id", "user_id", "value")


def delivered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-01 / SNK-04: the lines of the bank files by their names, read part by part from the committed manifest."""
    from ..session import new_scratch_path
    from ..sinks import delivery
    from ..sinks.files import write_bank_files
    from .jobs import file_names
    ctx = Ctx(spark, sf_dir)
    run = _bank_run(spark, sf_dir)
    out = new_scratch_path(spark, "delivery")
    write_bank_files(run.lines, ctx.formats, f"{out}/files", requests=run.requests)
    manifest = delivery.commit_manifest(file_names(ctx, run.requests), f"{out}/files", f"{out}/manifest")
    return delivery.delivered_lines(manifest, f"{out}/files")


def main_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-06: the register text that MAIN has written, read back one row per line."""
    from ..session import new_scratch_path
    from .jobs import main_job
    ctx = Ctx(spark, sf_dir)
    path = main_job(ctx, new_scratch_path(spark, "main-runs"), ctx.params).register_path
    return spark.read.schema("value string, file_id string").option("lineSep", "\n").text(path).select("file_id", "value")


def main_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-08: the outcome that MAIN has written: return code, message, totals and file name of every request."""
    from ..session import new_scratch_path
    from .jobs import main_job
    ctx = Ctx(spark, sf_dir)
    out = new_scratch_path(spark, "main-runs")
    main_job(ctx, out, ctx.params)
    return spark.read.parquet(f"{out}/outcome").select("file_id", "retcode", "errbuf", "trx_lines", "sum_trans", "file_name", "file_extension")


def legacy_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-06 / SNK-07 / JN-11 / FLT-05/08/10: the G1 register (EFT, unsent, with check-state labels)."""
    from ..operators import register
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    req = sel_ops.build_requests(ctx.docs, ctx.params.with_(only_unsent="Y"))
    sel = materialize(sel_ops.select_legacy(ctx.checks, req, sel_ops.params_envelope(ctx.params), status="NEW"), "legacy-register")
    totals = agg.amount_totals(sel, ["file_id"])
    states = metadata.lookup_codes(spark).where(F.col("lookup_type") == "CHECK STATE").select(
        F.col("lookup_code").alias("status_lookup_code"), F.col("displayed_field").alias("check_status"))
    lines = sel.join(ctx.sites, "vendor_site_id").join(bounded_broadcast(states), "status_lookup_code")
    bt = ctx.bank_tables()
    chain = lookups.bank_chain(ctx.docs, bt["uses"], bt["accounts"], bt["banks"])
    heading = req.select("file_id", "payment_document_id").join(
        chain.select("payment_document_id", "bank_name", "bank_account_name", "payment_document_name"),
        "payment_document_id")
    return register.legacy_register_text(lines, heading, totals, hot_files=hot_files_of(totals))


def legacy_register_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-06 / FLT-11 / JN-19: the G1 register per (document, automatic batch) — one file per batch,
    requests derived from the payments, all planned in one job."""
    from ..operators import register
    from ..operators.selection import _ts, day_range
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    p = ctx.params.with_(only_unsent="Y")
    # The payments of the period once: batches, selection and totals come from this snapshot.
    c = materialize(ctx.checks.where(day_range(F.col("check_date"), _ts(p.start_date), _ts(p.end_date))), "batch-payments")
    batches = c.where(F.col("payment_type_flag") == "A").select("payment_document_id", "checkrun_id").distinct()
    base = sel_ops.build_requests(ctx.docs, p)
    req = base.join(batches, "payment_document_id").select(
        F.concat_ws("-", F.col("file_id"), F.col("checkrun_id").cast("string")).alias("file_id"),
        *[x for x in base.columns if x not in ("file_id", "req_checkrun_id")],
        F.col("checkrun_id").alias("req_checkrun_id"))
    sel = materialize(sel_ops.select_legacy(c, req, sel_ops.params_envelope(p), status="NEW"), "batch-register")
    totals = agg.amount_totals(sel, ["file_id"])
    states = metadata.lookup_codes(spark).where(F.col("lookup_type") == "CHECK STATE").select(
        F.col("lookup_code").alias("status_lookup_code"), F.col("displayed_field").alias("check_status"))
    lines = sel.join(ctx.sites, "vendor_site_id").join(bounded_broadcast(states), "status_lookup_code")
    bt = ctx.bank_tables()
    chain = lookups.bank_chain(ctx.docs, bt["uses"], bt["accounts"], bt["banks"])
    names = lookups.latest_batch_name(ctx.checks).select(F.col("checkrun_id").alias("req_checkrun_id"), "checkrun_name")
    heading = req.select("file_id", "payment_document_id", "req_checkrun_id").join(
        chain.select("payment_document_id", "bank_name", "bank_account_name", "payment_document_name"),
        "payment_document_id").join(names, "req_checkrun_id", "left")
    return register.legacy_register_text(lines, heading, totals, hot_files=hot_files_of(totals), batch_mode=True)


def dependent_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-20/21/22 / FLT-17 / SRT-03: unit → account → active document → latest automatic batch."""
    from ..sources import metadata
    ctx = Ctx(spark, sf_dir)
    bt = ctx.bank_tables()
    accts = lookups.accounts_of_unit(bt["uses"], bt["accounts"])
    docs = lookups.active_documents(ctx.docs, metadata.payment_formats(spark))
    batches = lookups.latest_batch_of_document(ctx.checks, ctx.params.start_date, ctx.params.end_date)
    return accts.join(docs.select(F.col("internal_bank_account_id").alias("bank_account_id"),
                                  "payment_document_id", "payment_document_name"), "bank_account_id") \
        .join(batches, "payment_document_id")


def check_amount_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-17: every invoice payment with its payment's amount (0 when the payment is unknown),
    and its invoice number ('-1' when the invoice is unknown, JN-16)."""
    ctx = Ctx(spark, sf_dir)
    ip = ctx.invoice_payments.select("check_id", "invoice_id", "line_number", "supplier_ref")
    return lookups.invoice_number(lookups.check_amount(ip, ctx.checks), ctx.invoices)


QUERIES = {
    "check_register": check_register,
    "selection_totals": selection_totals,
    "legacy_batch_totals": legacy_batch_totals,
    "optional_range": optional_range,
    "report_lines": report_lines,
    "report_lines_legacy": report_lines_legacy,
    "paid_invoices": paid_invoices,
    "invoice_list": invoice_list,
    "supplier_bank_lines": supplier_bank_lines,
    "supplier_bank_lines_account": supplier_bank_lines_account,
    "value_set_labels": value_set_labels,
    "register_heading": register_heading,
    "file_names": file_names,
    "assigned_format": assigned_format,
    "format_parts": format_parts,
    "latest_batch_name": latest_batch_name,
    "seq_body": seq_body,
    "seq_detail": seq_detail,
    "line_numbers": line_numbers,
    "bank_file_lines": bank_file_lines,
    "fixed_width_lines": fixed_width_lines,
    "delimited_lines": delimited_lines,
    "written_lines": written_lines,
    "bound_fields": bound_fields,
    "layout_variants": layout_variants,
    "migrated_lines": migrated_lines,
    "dq_dynamic_values": dq_dynamic_values,
    "dq_dynamic_values_relational": dq_dynamic_values_relational,
    "register_text": register_text,
    "register_text_es": register_text_es,
    "mark_printed": mark_printed,
    "current_status": current_status,
    "unsent_after_final": unsent_after_final,
    "second_final_run": second_final_run,
    "crashed_final_run": crashed_final_run,
    "compacted_status": compacted_status,
    "rows_updated_by_file": rows_updated_by_file,
    "status_by_metadata": status_by_metadata,
    "flex_sql_default": flex_sql_default,
    "dq_payments": dq_payments,
    "unlock": unlock,
    "unlock_outcome": unlock_outcome,
    "flex_project": flex_project,
    "flex_unpivot": flex_unpivot,
    "dq_flex_domain": dq_flex_domain,
    "dq_segment_rules": dq_segment_rules,
    "dq_requests": dq_requests,
    "ingest_file_status": ingest_file_status,
    "ingest_rejects": ingest_rejects,
    "landing_stream": landing_stream,
    "delivered_files": delivered_files,
    "main_register": main_register,
    "main_outcome": main_outcome,
    "legacy_register": legacy_register,
    "legacy_register_batch": legacy_register_batch,
    "dependent_lists": dependent_lists,
    "check_amount_lookup": check_amount_lookup,
}
