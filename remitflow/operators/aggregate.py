"""Aggregations over the selection: totals, report-line counts, invoice lists, part flags, titles.

All are ``groupBy`` with partial (map-side) aggregation, so a hot file or
payment is pre-aggregated in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import INVOICE_LIST_PREFIX, PARTS, TITLE_CODES, TOTAL_MONEY


def selection_totals(selection: DataFrame, key: str | list = "file_id") -> DataFrame:
    """AGG-01: per file, number of payments and their total."""
    keys = [key] if isinstance(key, str) else key
    return selection.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trx_lines"),
        F.sum("amount").cast(TOTAL_MONEY).alias("sum_trans"),
    )


def amount_totals(selection: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-02: ``SUM(amount), COUNT(amount)`` (SUM of nothing is NULL, COUNT 0)."""
    return selection.groupBy(*keys).agg(
        F.sum("amount").cast(TOTAL_MONEY).alias("sum_trans"),
        F.count("amount").alias("trx_lines"),
    )


def report_lines(selection: DataFrame, invoice_payments: DataFrame, legacy_product: bool = False) -> DataFrame:
    """AGG-03/04: invoice-payment lines + payment lines per file, with payments and their total.

    Default counts the invoice payments of the selected checks (equi-join).
    ``legacy_product=True`` reproduces the reference's missing join predicate
    (quirk Q14): payments × all invoice payments, computed as a product of two
    counts, never as a cross join.
    """
    if legacy_product:
        pay = selection_totals(selection)
        n_ip = invoice_payments.where(F.col("invoice_id").isNotNull()).agg(F.count(F.lit(1))).scalar()
        return pay.select("file_id", "trx_lines", "sum_trans",
                          (F.col("trx_lines") * n_ip + F.col("trx_lines")).cast("bigint").alias("report_lines"))
    # One join by payment and two aggregations that need no further shuffle by payment; one scan of each side.
    per_check = (selection.select("file_id", "check_id", "amount")
                 .join(invoice_payments.where(F.col("invoice_id").isNotNull()).select("check_id", "invoice_id"), "check_id", "left")
                 .groupBy("check_id", "file_id").agg(F.first("amount").alias("amount"), F.count("invoice_id").alias("_n")))
    return per_check.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("trx_lines"), F.sum("amount").cast(TOTAL_MONEY).alias("sum_trans"),
        (F.sum("_n") + F.count(F.lit(1))).cast("bigint").alias("report_lines"))


INVOICE_CHUNK = 1000


def _ordered_concat(df: DataFrame, keys: list[str], order: list[str], text: str, out: str) -> DataFrame:
    s = F.struct(*[F.col(c) for c in order], F.col(text).alias("_t"))
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(s)).alias("_l")).select(
        *keys, F.concat_ws("", F.transform("_l", lambda x: x["_t"])).alias(out))


def invoice_list(paid: DataFrame, order: list[str], chunk: int = INVOICE_CHUNK, hot_keys=None,
                 hot_rows: int | None = None) -> DataFrame:
    """AGG-06: ``'DOCUMENTOS: ' || n1 || ' ' || n2 || ' ' …`` per check, ordered, untruncated.

    Payments with at most ``hot_rows`` invoices are concatenated by one ordered aggregation
    (bounded by the threshold).  Larger ones go two-phase so no task gathers a whole payment:
    invoices are numbered (skew-safe), concatenated in ordered chunks of ``chunk`` in
    parallel, and only the chunk strings are joined per payment.
    """
    from .sequences import hot_groups, hot_rows_of, sequence_within

    base = paid.select("check_id", F.concat(F.col("invoice_num"), F.lit(" ")).alias("_num"), *order)
    if hot_keys is None:
        hot_rows = hot_rows if hot_rows is not None else hot_rows_of(paid.sparkSession)
        hot_keys = hot_groups(base, ["check_id"], hot_rows)
    parts = []
    if hot_keys:
        hot = F.broadcast(paid.sparkSession.createDataFrame(hot_keys, base.select("check_id").schema))
        cold_rows, hot_rows_df = base.join(hot, "check_id", "left_anti"), base.join(hot, "check_id", "left_semi")
        numbered = sequence_within(hot_rows_df, ["check_id"], list(order), "_k", hot_keys=hot_keys)
        chunks = _ordered_concat(numbered.withColumn("_c", F.floor((F.col("_k") - 1) / chunk)),
                                 ["check_id", "_c"], ["_k"], "_num", "_s")
        parts.append(_ordered_concat(chunks, ["check_id"], ["_c"], "_s", "_all"))
    else:
        cold_rows = base
    parts.append(_ordered_concat(cold_rows, ["check_id"], list(order), "_num", "_all"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select("check_id", F.concat(F.lit(INVOICE_LIST_PREFIX), F.col("_all")).alias("invoices"))


def format_parts(fields: DataFrame, formats: DataFrame) -> DataFrame:
    """AGG-09: which parts each enabled format defines."""
    f = fields.join(formats.where(F.col("enable_flag") == "Y"), "format_id")
    return f.groupBy("format_id").agg(*[
        F.max(F.when(F.col("part_of_file") == p, F.lit(True)).otherwise(F.lit(False))).alias(f"has_{p.lower()}")
        for p in PARTS
    ])


def title_columns(titles: DataFrame) -> DataFrame:
    """AGG-10: pivot (language, code, meaning) rows into one row of named titles per language."""
    return titles.groupBy("language").agg(*[
        F.max(F.when(F.col("code") == c, F.col("meaning"))).alias(f"tl_{c.lower()}") for c in TITLE_CODES
    ])


def title_literals(titles: DataFrame, lang: str) -> list:
    """RPT-05: the 12 titles of one language as literal columns (one bounded row, no join)."""
    row = title_columns(titles.where(F.col("language") == lang)).limit(2).collect()
    if len(row) != 1:
        raise ValueError(f"register titles for language {lang!r}: {len(row)} rows")
    return [F.lit(v).alias(k) for k, v in row[0].asDict().items() if k != "language"]
