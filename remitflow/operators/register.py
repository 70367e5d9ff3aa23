"""Payment register text (RPT-01..06): heading block, column titles, one line per payment, rule, totals.

The register is built per file from the same selection snapshot as the bank
file.  Line numbers come from the skew-safe sequence, so a huge file is not
funnelled through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.masks import money, to_char_date
from ..functions.text import cat
from ..schema import RULE_WIDTH
from .sequences import sequence_within

DISPLAY_DATE = "DD-MON-YYYY"
DISPLAY_DT = "DD-MON-YYYY HH24:MI:SS"
HEADING_LINES = 9  # blank, title, 4 heading lines, date line, blank, column titles


def heading_lines(heading: DataFrame) -> DataFrame:
    """RPT-01/02: per file, lines 1..9 from (file_id, as_of, tl_*, bank/account/document/legal entity)."""
    def lab(code):
        return F.rpad(F.col(f"tl_{code}"), 18, " ")
    col_titles = cat(
        F.lit("  "), F.lpad(F.col("tl_check_number"), 15, " "), F.lit("  "), F.rpad(F.col("tl_check_date"), 14, " "),
        F.lit("  "), F.rpad(F.col("tl_supplier_name"), 50, " "), F.lit("  "),
        F.rpad(F.col("tl_supplier_site"), 15, " "), F.lit("  "), F.lpad(F.col("tl_check_amount"), 15, " "),
        F.lit("  "), F.rpad(F.col("tl_send_status"), 15, " "))
    lines = F.array(
        F.lit(""),
        F.col("tl_report_name"),
        cat(lab("legal_entity"), F.lit(": "), F.col("legal_entity")),
        cat(lab("bank"), F.lit(": "), F.col("bank_name")),
        cat(lab("bank_account"), F.lit(": "), F.col("bank_account_name")),
        cat(lab("payment_document"), F.lit(": "), F.col("payment_document_name")),
        cat(lab("date_time"), F.lit(": "), to_char_date(F.col("as_of"), DISPLAY_DT)),
        F.lit(""),
        col_titles,
    )
    return heading.select("file_id", F.posexplode(lines).alias("_i", "value")).select(
        "file_id", (F.col("_i") + 1).cast("bigint").alias("line_no"), "value")


def detail_line(sel: DataFrame) -> DataFrame:
    """RPT-03: one register line per payment."""
    return sel.select(
        "*",
        cat(F.lit("  "), F.lpad(F.coalesce(F.col("check_number"), F.lit(0)).cast("string"), 15, " "),
            F.lit("  "), F.rpad(to_char_date(F.col("check_date"), DISPLAY_DATE), 14, " "),
            F.lit("  "), F.rpad(F.coalesce(F.col("vendor_name"), F.lit(" ")), 50, " "),
            F.lit("  "), F.rpad(F.coalesce(F.col("vendor_site_code"), F.lit(" ")), 15, " "),
            F.lit("  "), F.lpad(money(F.col("amount")), 15, " "),
            F.lit("  "), F.rpad(F.coalesce(F.col("send_status"), F.lit(" ")), 15, " ")).alias("value"))


def register_text(selection: DataFrame, heading: DataFrame, totals: DataFrame,
                  hot_rows: int | None = None, hot_files=None) -> DataFrame:
    """RPT-01..04: (file_id, line_no, value) for every register line of every file with payments."""
    head = heading_lines(heading.join(totals.select("file_id"), "file_id"))
    shown = selection.select("file_id", "check_id", "check_number", "check_date", "vendor_name", "vendor_site_code", "amount", "send_status")
    det = sequence_within(shown, ["file_id"], ["check_number", "check_id"], "_n", hot_rows, hot_files)
    det = detail_line(det).select("file_id", (F.col("_n") + HEADING_LINES).alias("line_no"), "value")
    tail = totals.select(
        "file_id",
        F.array(
            F.lit("-" * RULE_WIDTH),
            cat(F.lit("  COUNT "), F.lpad(F.col("trx_lines").cast("string"), 9, " "), F.lit(" " * 87),
                F.lpad(money(F.col("sum_trans")), 15, " ")),
        ).alias("_t"), "trx_lines")
    tail = tail.select("file_id", "trx_lines", F.posexplode("_t").alias("_i", "value")).select(
        "file_id", (F.col("trx_lines") + HEADING_LINES + 1 + F.col("_i")).cast("bigint").alias("line_no"), "value")
    return head.unionByName(det).unionByName(tail)


LEGACY_RULE = "-" * 35


def legacy_register_text(selection: DataFrame, heading: DataFrame, totals: DataFrame,
                         hot_rows: int | None = None, hot_files=None, batch_mode: bool = False) -> DataFrame:
    """RPT-06 / SNK-07: the G1 register layout (document sequence, check state, raw send status).

    In batch mode the heading carries the batch name (``checkrun_name`` column of ``heading``).
    """
    batch = [cat(F.lit("CHECKRUN NAME     : "), F.col("checkrun_name"))] if batch_mode else []
    head = heading.join(totals.select("file_id"), "file_id").select(
        "file_id", F.posexplode(F.array(
            F.lit("Registro de Pagos "),
            cat(F.lit("BANK              : "), F.col("bank_name")),
            cat(F.lit("BANK ACCOUNT NAME : "), F.col("bank_account_name")),
            cat(F.lit("PAYMENT DOCUMENT  : "), F.col("payment_document_name")),
            *batch,
            F.lit("  "),
            cat(F.lit("  "), F.rpad(F.lit("DOC SEQUENCE"), 12, " "), F.lit("  "), F.rpad(F.lit("CHECK DATE"), 15, " "),
                F.lit("  "), F.rpad(F.lit("SUPPLIER NAME"), 50, " "), F.lit("  "), F.rpad(F.lit("VENDOR SITE"), 15, " "),
                F.lit("  "), F.lpad(F.lit("AMOUNT"), 15, " "), F.lit("  "), F.rpad(F.lit("CHECK STATUS"), 15, " "),
                F.lit("  "), F.rpad(F.lit("SEND STATUS"), 15, " "))
        )).alias("_i", "value")).select("file_id", (F.col("_i") + 1).cast("bigint").alias("line_no"), "value")
    n_head = 7 if batch_mode else 6
    det = sequence_within(selection, ["file_id"], ["doc_sequence_value", "check_id"], "_n", hot_rows, hot_files)
    det = det.select(
        "file_id", (F.col("_n") + n_head).alias("line_no"),
        cat(F.lit("  "), F.lpad(F.coalesce(F.col("doc_sequence_value"), F.lit(0)).cast("string"), 12, " "),
            F.lit("  "), F.rpad(to_char_date(F.col("check_date"), "DD/MM/YYYY"), 15, " "),
            F.lit("  "), F.rpad(F.coalesce(F.col("vendor_name"), F.lit(" ")), 50, " "),
            F.lit("  "), F.rpad(F.coalesce(F.col("vendor_site_code"), F.lit(" ")), 15, " "),
            F.lit("  "), F.lpad(money(F.col("amount")), 15, " "),
            F.lit("  "), F.rpad(F.coalesce(F.col("check_status"), F.lit(" ")), 15, " "),
            F.lit("  "), F.rpad(F.coalesce(F.col("attribute14"), F.lit(" ")), 15, " ")).alias("value"))
    tail = totals.select("file_id", "trx_lines", F.posexplode(F.array(
        F.lit(LEGACY_RULE),
        cat(F.lit("REPORT TOTAL     :"), F.lpad(money(F.col("sum_trans")), 15, " ")),
        cat(F.lit("REPORT COUNT     :"), F.lpad(F.col("trx_lines").cast("string"), 15, " ")),
    )).alias("_i", "value")).select(
        "file_id", (F.col("trx_lines") + n_head + 1 + F.col("_i")).cast("bigint").alias("line_no"), "value")
    return head.unionByName(det).unionByName(tail)
