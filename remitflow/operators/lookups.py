"""Dimension lookups: value sets, bank chain, supplier bank chain, paid invoices, formats.

Small dimensions are broadcast only behind ``bounded_broadcast``'s row check;
payment-sized inputs (invoice payments, supplier accounts) are joined with
shuffle joins on their keys so AQE can split skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_broadcast


def value_set(values: DataFrame, set_name: str, lang: str | None = None, enabled_only: bool = False) -> DataFrame:
    """JN-03: (code, language, meaning) rows of one value set; optional language filter."""
    out = values.where(F.col("flex_value_set_name") == set_name)
    if lang is not None:
        out = out.where(F.col("language") == lang)
    if enabled_only:
        out = out.where(F.col("enabled_flag") == "Y")
    return out.select(F.col("flex_value").alias("code"), "language", F.col("flex_value_meaning").alias("meaning"),
                      "enabled_flag", "start_date_active", "end_date_active")


def bank_chain(docs: DataFrame, uses: DataFrame, accounts: DataFrame, banks: DataFrame,
               units: DataFrame | None = None, entities: DataFrame | None = None) -> DataFrame:
    """JN-05/06: payment document → account use → account → bank (→ operating unit, legal entity)."""
    out = (
        docs.join(bounded_broadcast(uses), docs.internal_bank_account_id == uses.bank_account_id)
        .drop(uses.bank_account_id)
        .join(bounded_broadcast(accounts), F.col("internal_bank_account_id") == accounts.bank_account_id)
        .join(bounded_broadcast(banks), F.col("bank_id") == banks.bank_party_id)
    )
    if units is not None:
        out = out.join(bounded_broadcast(units), F.col("org_id") == units.organization_id)
    if entities is not None:
        out = out.join(bounded_broadcast(entities), F.col("org_id") == entities.operating_unit_id)
    return out


def assigned_format(docs: DataFrame) -> DataFrame:
    """JN-18: payment document → format id from ``attribute11``; none or several rows → NULL."""
    keyed = docs.select("payment_document_id", F.expr("try_cast(attribute11 AS BIGINT)").alias("format_id"))
    return keyed.groupBy("payment_document_id").agg(
        F.when(F.count(F.lit(1)) == 1, F.first("format_id")).alias("format_id"))


def paid_invoices(selection: DataFrame, invoice_payments: DataFrame, invoices: DataFrame,
                  carry: tuple = ()) -> DataFrame:
    """JN-07: selected check ⋈ invoice payment ⋈ invoice (inner: payments without an invoice row drop)."""
    sel = selection.select("file_id", "check_id", *carry)
    return sel.join(invoice_payments, "check_id").join(invoices, "invoice_id")


def supplier_bank(chain: dict[str, DataFrame], dedupe_site: bool = True, vendors: DataFrame | None = None) -> DataFrame:
    """JN-08: external account ⋈ owner ⋈ party site ⋈ party ⋈ supplier, DISTINCT.

    The reference keeps the party-site name in the DISTINCT, so a vendor with k
    sites × m accounts repeats (quirk Q19); ``dedupe_site=False`` keeps that.  ``vendors``
    (``vendor_id``) restricts the chain before its joins.
    """
    suppliers = chain["suppliers"]
    if vendors is not None:
        suppliers = suppliers.join(vendors.select("vendor_id").distinct(), "vendor_id", "left_semi")
    # From the restricted side on: every later join meets the wanted suppliers' rows only.
    out = (
        suppliers.join(chain["parties"], "party_id")
        .join(chain["party_sites"], "party_id")
        .join(chain["account_owners"], F.col("party_id") == F.col("account_owner_party_id"))
        .join(chain["ext_bank_accounts"], "ext_bank_account_id")
    )
    cols = ["bank_account_name", "bank_account_num", "party_name", "vendor_id"]
    if not dedupe_site:
        cols.insert(2, "party_site_name")
    return out.select(*cols).distinct()


def invoice_number(keys: DataFrame, invoices: DataFrame, key: str = "invoice_id") -> DataFrame:
    """JN-16: scalar lookup of the invoice number, ``'-1'`` when absent."""
    return keys.join(invoices, keys[key] == invoices.invoice_id, "left").select(
        keys["*"], F.coalesce(invoices.invoice_num, F.lit("-1")).alias("invoice_num"))


def check_amount(keys: DataFrame, checks: DataFrame) -> DataFrame:
    """JN-17: scalar lookup of a check's amount, 0 when absent."""
    c = checks.select(F.col("check_id").alias("_cid"), F.col("amount").alias("_amt"))
    return keys.join(c, keys.check_id == c._cid, "left").select(
        keys["*"], F.coalesce(F.col("_amt"), F.lit(0).cast("decimal(18,2)")).alias("check_amount"))


def latest_batch_name(checks: DataFrame, auto_only: bool = True) -> DataFrame:
    """JN-19 / AGG-05: name carried by the latest check of each batch (``MAX(ROWID)`` → max check_id)."""
    c = checks.where(F.col("checkrun_id").isNotNull())
    if auto_only:
        c = c.where(F.col("payment_type_flag") == "A")
    return c.groupBy("checkrun_id").agg(
        F.max_by("checkrun_name", "check_id").alias("checkrun_name"),
        F.max("check_id").alias("latest_check_id"))


def granted_users(values: DataFrame, users: DataFrame, set_name: str, as_of) -> DataFrame:
    """JN-10 / FLT-15 / FLT-16: users listed (enabled, effective on ``as_of``) in the grant value set."""
    day = F.to_date(F.lit(as_of.strftime("%Y-%m-%d"))) if hasattr(as_of, "strftime") else F.to_date(F.lit(as_of))
    g = values.where((F.col("flex_value_set_name") == set_name) & (F.col("language") == "US")
                     & (F.col("enabled_flag") == "Y"))
    g = g.where(day.between(F.coalesce(F.to_date("start_date_active"), day),
                            F.coalesce(F.to_date("end_date_active"), day)))
    return g.join(bounded_broadcast(users), F.upper(F.trim(g.flex_value_meaning)) == users.user_name) \
        .select("user_id", "user_name", F.col("flex_value").alias("grant_code"))


def accounts_of_unit(uses: DataFrame, accounts: DataFrame) -> DataFrame:
    """JN-20 / SRT-03: bank accounts of each operating unit, positioned by account name."""
    from .sequences import sequence_within
    a = uses.join(accounts, "bank_account_id").select("org_id", "bank_account_id", "bank_account_name",
                                                       "bank_account_num")
    return sequence_within(a, ["org_id"], ["bank_account_name", "bank_account_id"], "account_pos")


def active_documents(docs: DataFrame, payment_formats: DataFrame) -> DataFrame:
    """JN-21 / FLT-17: documents with a known payment format and no inactive date."""
    return docs.join(bounded_broadcast(payment_formats.select("format_code")), "format_code") \
        .where(F.col("inactive_date").isNull())


def latest_batch_of_document(checks: DataFrame, start: str, end: str) -> DataFrame:
    """JN-22 batch list: per document, the batch of its latest automatic payment in the date range
    (the reference used the start date for both bounds, quirk Q29, fixed)."""
    from .selection import _ts, day_range
    c = checks.where((F.col("payment_type_flag") == "A") & day_range(F.col("check_date"), _ts(start), _ts(end)))
    return c.groupBy("payment_document_id").agg(
        F.max_by("checkrun_id", "check_id").alias("checkrun_id"),
        F.max_by("checkrun_name", "check_id").alias("checkrun_name"))
