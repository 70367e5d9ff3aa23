"""Requests and the payment selection (the reference's ``c_checks`` cursor).

One *request* is one output file: a payment document plus the run parameters.
Many requests are evaluated in one plan; ``file_id`` is carried through every
later aggregate and window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ntz
from ..schema import MONEY, STATUS_NEW, STATUS_VALUE_SET, RunParams
from ..session import bounded_broadcast
from .lookups import assigned_format, value_set

CANONICAL_TS = "yyyy/MM/dd HH:mm:ss"


def _ts(text: str | None) -> Column:
    return F.to_timestamp_ntz(F.lit(text), F.lit(CANONICAL_TS)) if text else F.lit(None).cast("timestamp_ntz")


def build_requests(docs: DataFrame, params: RunParams, doc_ids: list[int] | None = None) -> DataFrame:
    """One request per payment document (optionally restricted to ``doc_ids``)."""
    d = docs if doc_ids is None else docs.where(F.col("payment_document_id").isin(doc_ids))
    fmt = assigned_format(d)
    d = d.join(fmt, "payment_document_id", "left")
    return d.select(
        F.concat_ws("-", F.lit(params.run_id), F.col("payment_document_id").cast("string")).alias("file_id"),
        F.lit(params.run_id).alias("run_id"),
        "payment_document_id",
        F.col("internal_bank_account_id").alias("bank_account_id"),
        "payment_document_name",
        "format_id",
        _ts(params.start_date).alias("start_ts"),
        _ts(params.end_date).alias("end_ts"),
        F.lit(params.doc_ini).cast("bigint").alias("doc_ini"),
        F.lit(params.doc_fin).cast("bigint").alias("doc_fin"),
        F.lit(params.base_amount).cast(MONEY).alias("base_amount"),
        F.lit(params.top_amount).cast(MONEY).alias("top_amount"),
        F.lit(params.status_check).cast("string").alias("status_check"),
        F.lit(params.lang).alias("lang"),
        F.lit(params.process_type).alias("process_type"),
        _ts(params.as_of).alias("as_of"),
        F.lit(params.checkrun_id).cast("bigint").alias("req_checkrun_id"),
    )


@dataclass(frozen=True)
class Envelope:
    """Union of all requests' bounds, pushed into the scan as plain literals."""

    doc_ids: tuple
    start: object
    end: object


def params_envelope(params: RunParams, doc_ids=None) -> Envelope:
    """Envelope of requests built from one parameter set: known on the driver, no job needed."""
    from datetime import datetime

    def day(t):
        d = datetime.strptime(t, "%Y/%m/%d %H:%M:%S") if t else None
        return d.replace(hour=0, minute=0, second=0) if d else None
    return Envelope(tuple(sorted(doc_ids)) if doc_ids else (), day(params.start_date), day(params.end_date))


def day_range(col: Column, start: Column, end: Column) -> Column:
    """FLT-02: ``TRUNC(d) BETWEEN TRUNC(a) AND TRUNC(b)`` as a half-open, pushable range."""
    return (col >= F.date_trunc("DAY", start)) & (col < F.date_trunc("DAY", end) + F.expr("INTERVAL 1 DAY"))


def optional_range(col: Column, lo: Column, hi: Column) -> Column:
    """FLT-04/05: ``x >= NVL(lo, x) AND x <= NVL(hi, x)``; NULL x never passes (Q33)."""
    return (col >= F.coalesce(lo, col)) & (col <= F.coalesce(hi, col))


def optional_between(col: Column, lo: Column, hi: Column) -> Column:
    """FLT-06: ``x BETWEEN NVL(lo, x) AND NVL(hi, x)``."""
    return col.between(F.coalesce(lo, col), F.coalesce(hi, col))


def status_admitted(code: Column, status_check: Column) -> Column:
    """FLT-07: ``NVL(status,'NEW') IN ('NEW', :status)``."""
    c = F.coalesce(code, F.lit(STATUS_NEW))
    return (c == F.lit(STATUS_NEW)) | (c == status_check)


def filter_checks(checks: DataFrame, requests: DataFrame, env: Envelope | None = None,
                  status_col: str = "attribute14") -> DataFrame:
    """Checks ⋈ requests with every per-request predicate (FLT-01/02/04/06/07/09)."""
    c = checks
    if env is not None:
        # Literal envelope: reaches the Parquet scan as PushedFilters.
        if env.doc_ids:
            c = c.where(F.col("payment_document_id").isin(list(env.doc_ids)))
        if env.start is not None:
            c = c.where(F.col("check_date") >= ntz(env.start))
        if env.end is not None:
            c = c.where(F.col("check_date") < ntz(env.end) + F.expr("INTERVAL 1 DAY"))
    c = c.where(F.col("void_date").isNull())
    req = bounded_broadcast(requests)
    j = c.join(req, "payment_document_id")
    return j.where(
        day_range(F.col("check_date"), F.col("start_ts"), F.col("end_ts"))
        & optional_range(F.col("check_number"), F.col("doc_ini"), F.col("doc_fin"))
        & optional_between(F.col("amount"), F.col("base_amount"), F.col("top_amount"))
        & status_admitted(F.col(status_col), F.col("status_check"))
    ).withColumn("send_code", F.coalesce(F.col(status_col), F.lit(STATUS_NEW)))


def select_checks(checks: DataFrame, sites: DataFrame, values: DataFrame, requests: DataFrame,
                  env: Envelope | None = None, status_col: str = "attribute14") -> DataFrame:
    """The payment selection: filters, supplier-site join (JN-01), status label join (JN-02).

    Both joins are inner, so payments without a site or with an unknown status
    code drop (quirk Q8).  Sites are joined with a shuffle join: the site table
    grows with the supplier base; a vendor holding a third of all payments is a
    skewed key that AQE's skew-join splits.
    """
    f = filter_checks(checks, requests, env, status_col)
    labels = bounded_broadcast(value_set(values, STATUS_VALUE_SET).select(
        F.col("code").alias("_code"), F.col("language").alias("_lang"), F.col("meaning").alias("send_status")))
    out = f.join(sites, "vendor_site_id").join(
        labels, (F.col("send_code") == F.col("_code")) & (F.col("lang") == F.col("_lang")))
    return out.select(*SELECTION_COLUMNS)


# Columns the selection carries downstream (file, register, status log).
SELECTION_COLUMNS = (
    "file_id", "run_id", "format_id", "payment_document_id", "check_id", "doc_sequence_value", "check_number",
    "amount", "check_date", "vendor_id", "vendor_site_id", "vendor_name", "vendor_site_code", "send_code",
    "send_status", "attribute_category", "checkrun_id", "payment_method_code", "lang",
)


REGISTER_COLUMNS = ("file_id", "check_id", "doc_sequence_value", "check_number", "amount", "check_date",
                    "vendor_name", "send_status", "vendor_site_code")


def register_rows(selection: DataFrame) -> DataFrame:
    """RPT-07 / PRJ-01: the register as typed rows."""
    return selection.select(*REGISTER_COLUMNS)


def run_selection(spark: SparkSession, checks: DataFrame, sites: DataFrame, values: DataFrame,
                  docs: DataFrame, params: RunParams, doc_ids=None, status_col: str = "attribute14"):
    """Build requests for ``params`` and return (requests, selection)."""
    req = build_requests(docs, params, doc_ids)
    return req, select_checks(checks, sites, values, req, params_envelope(params, doc_ids), status_col)


def select_legacy(checks: DataFrame, requests: DataFrame, env: Envelope | None = None,
                  status: str = STATUS_NEW) -> DataFrame:
    """G1 selection (FLT-05/08/10/11): EFT only, status defaulting to NEW must equal NEW, and either
    the batch (``req_checkrun_id``) or the document-sequence range; no site join."""
    c = checks.where(F.col("void_date").isNull() & (F.col("payment_method_code") == "EFT")
                     & (F.coalesce(F.col("attribute14"), F.lit(STATUS_NEW)) == status))
    if env is not None and env.doc_ids:
        c = c.where(F.col("payment_document_id").isin(list(env.doc_ids)))
    j = c.join(bounded_broadcast(requests), "payment_document_id")
    by_batch = F.col("checkrun_id") == F.col("req_checkrun_id")
    by_range = optional_range(F.col("doc_sequence_value"), F.col("doc_ini"), F.col("doc_fin"))
    return j.where(
        day_range(F.col("check_date"), F.col("start_ts"), F.col("end_ts"))
        & (F.col("amount") >= F.coalesce(F.col("base_amount"), F.col("amount")))
        & (F.col("amount") <= F.coalesce(F.col("top_amount"), F.col("amount")))
        & F.when(F.col("req_checkrun_id").isNotNull(), by_batch).otherwise(by_range)
    )


def seconds_range(col: Column, start: str, end: str) -> Column:
    """FLT-03: second-granular closed range from canonical text dates."""
    return col.between(_ts(start), _ts(end))
