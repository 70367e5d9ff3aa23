"""Configuration tables: value sets, users, bank-file layouts, flexfield segments.

These are the small setup tables of the payables application (the reference
keeps them in value sets and two layout tables).  They never grow with payment
volume; every job joins them to the payment data, never runs on them alone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import FORMAT_FIELDS, FORMATS, LEGACY_FORMAT_FIELDS, LEGACY_FORMATS, GRANT_VALUE_SET, STATUS_VALUE_SET, TITLE_VALUE_SET

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): status meanings per language and
# register titles per language.  Languages: US = English, ESA = Spanish.
# ---------------------------------------------------------------------------
STATUS_MEANINGS = [
    ("NEW", "US", "Unsend"),
    ("PRINTED", "US", "Sent"),
    ("NEW", "ESA", "No Enviado"),
    ("PRINTED", "ESA", "Enviado"),
]
TITLE_MEANINGS = [
    ("BANK", "Bank", "Banco"),
    ("BANK_ACCOUNT", "Bank Account", "Cuenta Bancaria"),
    ("CHECK_AMOUNT", "Amount", "Monto"),
    ("CHECK_DATE", "Check Date", "Fecha de Pago"),
    ("CHECK_NUMBER", "Check Number", "Numero de Pago"),
    ("DATE_TIME", "Date Time", "Fecha Hora"),
    ("LEGAL_ENTITY", "Legal Entity", "Entidad Legal"),
    ("PAYMENT_DOCUMENT", "Payment Document", "Documento de Pago"),
    ("REPORT_NAME", "Payment Register", "Registro de Pagos"),
    ("SEND_STATUS", "Status", "Estado"),
    ("SUPPLIER_NAME", "Supplier Name", "Proveedor"),
    ("SUPPLIER_SITE", "Supplier Site", "Sucursal"),
]
# Contexts of the payment descriptive flexfield: bank payments book to a branch, couriered cheques travel in parcels.
# (context, column, end-user name, order, value set, default type, default value, required)
FLEX_SEGMENTS = [
    ("STANDARD", "ATTRIBUTE2", "Ledger Branch", 1, "BRANCHES", None, None, "Y"),
    ("STANDARD", "ATTRIBUTE8", "Value Days", 2, "DAY_COUNT", None, None, "N"),
    ("STANDARD", "ATTRIBUTE14", "Send Mark", 3, STATUS_VALUE_SET, None, None, "N"),
    ("COURIER", "ATTRIBUTE14", "Waybill", 1, "SHORT_CODES", None, None, "Y"),
    ("COURIER", "ATTRIBUTE8", "Parcel Grams", 2, "GRAMS", None, None, "N"),
    ("COURIER", "ATTRIBUTE3", "Doorstep", 3, None, None, None, "N"),
    ("COURIER", "ATTRIBUTE5", "Delivery Window", 4, "WINDOWS", "C", "ANYTIME", "N"),
]
# What a value set allows: (name, kind, least, greatest, decimals, characters).
FLEX_RULES = [
    ("BRANCHES", "LIST", None, None, None, 2),
    ("DAY_COUNT", "NUMBER", "0", "30", 0, 2),
    (STATUS_VALUE_SET, "LIST", None, None, None, None),
    ("SHORT_CODES", "TEXT", None, None, None, 5),
    ("GRAMS", "NUMBER", "50", "950.5", 1, 6),
    ("WINDOWS", "LIST", None, None, None, None),
]
# Code lists of the sets of kind LIST.
FLEX_DOMAINS = {
    "BRANCHES": [f"B{i}" for i in range(8)],
    STATUS_VALUE_SET: ["NEW", "PRINTED"],
    "WINDOWS": ["EARLY", "LATE", "NIGHT"],
}

VALUE_SET_ROWS = T.StructType([
    T.StructField("flex_value_set_name", T.StringType()),
    T.StructField("flex_value", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("flex_value_meaning", T.StringType()),
    T.StructField("enabled_flag", T.StringType()),
    T.StructField("start_date_active", T.TimestampNTZType()),
    T.StructField("end_date_active", T.TimestampNTZType()),
])


def value_set_rows() -> list[tuple]:
    rows = [(STATUS_VALUE_SET, c, lang, m, "Y", None, None) for c, lang, m in STATUS_MEANINGS]
    for code, us, es in TITLE_MEANINGS:
        rows.append((TITLE_VALUE_SET, code, "US", us, "Y", None, None))
        rows.append((TITLE_VALUE_SET, code, "ESA", es, "Y", None, None))
    # Users allowed to reset statuses: one open-ended, one expired, one disabled,
    # one listed twice under different spellings (an ambiguous grant).
    grants = [
        (" ap_supervisor ", "Y", None, None),
        ("treasury_lead", "Y", datetime(2010, 1, 1), datetime(2012, 12, 31)),
        ("intern", "N", None, None),
        ("Controller", "Y", datetime(2013, 1, 1), None),
        ("CONTROLLER ", "Y", None, None),
    ]
    for i, (name, enabled, s, e) in enumerate(grants):
        rows.append((GRANT_VALUE_SET, f"G{i + 1}", "US", name, enabled, s, e))
    return rows


def value_sets(spark: SparkSession) -> DataFrame:
    """Flattened (set ⋈ values ⋈ translations) rows."""
    return spark.createDataFrame(value_set_rows(), VALUE_SET_ROWS)


USERS = [(1001, "AP_SUPERVISOR"), (1002, "TREASURY_LEAD"), (1003, "INTERN"), (1004, "CONTROLLER"),
         (1005, "AUDITOR")]


# Payment-state lookup codes (lookup type CHECK STATE) shown by the legacy register.
LOOKUP_CODES = [("CHECK STATE", "NEGOTIABLE", "Negotiable"), ("CHECK STATE", "VOIDED", "Voided"),
                ("CHECK STATE", "CLEARED", "Cleared"), ("CHECK STATE", "STOP INITIATED", "Stop Initiated")]


def lookup_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LOOKUP_CODES, "lookup_type string, lookup_code string, displayed_field string")


# Payment formats of the payments module that documents point to.
PAYMENT_FORMATS = [("EFT_FMT", "Electronic funds transfer"), ("CHECK_FMT", "Printed check")]


def payment_formats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAYMENT_FORMATS, "format_code string, format_name string")


def users(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(USERS, "user_id long, user_name string")


# ---------------------------------------------------------------------------
# Bank-file layouts.  Keyed queries are SQL over the job's views
# (``selection``, ``paid``, ``invoices``, ``requests``) returning key columns
# plus ``value``; job parameters are named markers such as ``:P_START_DATE``.
# ---------------------------------------------------------------------------
_FORMATS = [
    (1, "PAY FIXED", "FIXED_WIDTH", None, "txt", "LF", "Y"),
    (2, "PAY CSV", "DELIMITED", 59, "csv", "CRLF", "Y"),
    (3, "PAY TAB", "DELIMITED", 9, "tsv", "LF", "Y"),
    (4, "OLD FIXED", "FIXED_WIDTH", None, "txt", "LF", "N"),
    (5, "CONTROL ONLY", "FIXED_WIDTH", None, "ctl", "LF", "Y"),
]

Q_CHECK_NUMBER = "SELECT check_id, check_number AS value FROM selection"
Q_AMOUNT = "SELECT check_id, amount AS value FROM selection"
Q_CHECK_DATE = "SELECT check_id, check_date AS value FROM selection"
Q_VENDOR = "SELECT check_id, vendor_name AS value FROM selection"
Q_SITE = "SELECT check_id, vendor_site_code AS value FROM selection"
Q_INVOICE_NUM = "SELECT invoice_id, invoice_num AS value FROM invoices"
Q_DOC_NAME = "SELECT file_id, payment_document_name AS value FROM requests"
Q_RUN_START = "SELECT CAST(:P_START_DATE AS TIMESTAMP_NTZ) AS value"

# (format, part, seq, type, const, start, end, dtype, mask, pad, dir, sql)
_FIELDS = [
    # PAY FIXED: payment line, invoice line, trailer; no header.
    (1, "BODY", 1, "CONSTANT", "PAYRECORD0000001", 1, 16, "STRING", None, None, None, None),
    (1, "BODY", 2, "DINAMIC", None, 17, 28, "NUMBER", "000000000000", 48, "LEFT", Q_CHECK_NUMBER),
    (1, "BODY", 3, "SEQUENCE1", None, 29, 36, "NUMBER", "99999999", 48, "LEFT", None),
    (1, "BODY", 4, "DINAMIC", None, 37, 52, "NUMBER", "999999999990.00", None, "LEFT", Q_AMOUNT),
    (1, "BODY", 5, "DINAMIC", None, 53, 60, "DATE", "DDMMYYYY", None, None, Q_CHECK_DATE),
    (1, "BODY", 6, "CONSTANT", "USD", 61, 63, "STRING", None, None, None, None),
    (1, "BODY", 7, "DINAMIC", None, 64, 103, "STRING", None, None, "RIGTH", Q_VENDOR),
    (1, "BODY", 8, "SEQUENCE3", None, 104, 109, "NUMBER", "999999", 48, "LEFT", None),
    (1, "BODY", 9, "CONSTANT", "01", 110, 111, "STRING", None, None, None, None),
    (1, "DETAIL", 1, "CONSTANT", "VOI", 1, 6, "STRING", None, None, None, None),
    (1, "DETAIL", 2, "SEQUENCE1", None, 7, 14, "NUMBER", "99999999", 48, "RIGHT", None),
    (1, "DETAIL", 3, "SEQUENCE2", None, 15, 18, "NUMBER", "9999", 48, "RIGHT", None),
    (1, "DETAIL", 4, "DINAMIC", None, 19, 38, "STRING", None, None, None, Q_INVOICE_NUM),
    (1, "DETAIL", 5, "SEQUENCE3", None, 39, 44, "NUMBER", "999999", 48, "LEFT", None),
    (1, "TRAILER", 1, "CONSTANT", "TRL", 1, 3, "STRING", None, None, None, None),
    (1, "TRAILER", 2, "TRX_LINES", None, 4, 12, "NUMBER", "000000000", None, None, None),
    (1, "TRAILER", 3, "SUM_TRANS", None, 13, 29, "NUMBER", "00000000000000.00", None, "LEFT", None),
    (1, "TRAILER", 4, "SEQUENCE1", None, 30, 37, "NUMBER", "99999999", 48, "LEFT", None),
    (1, "TRAILER", 5, "CONSTANT", None, 38, 100, "STRING", None, None, None, None),
    # PAY CSV: ';'-delimited with header and trailer.
    (2, "HEADER", 1, "CONSTANT", "H", None, None, "STRING", None, None, None, None),
    (2, "HEADER", 2, "DINAMIC", None, None, None, "STRING", None, None, None, Q_DOC_NAME),
    (2, "HEADER", 3, "DINAMIC", None, None, None, "DATE", "YYYY/MM/DD", None, None, Q_RUN_START),
    (2, "HEADER", 4, "SEQUENCE1", None, None, None, "NUMBER", "9999", None, None, None),
    (2, "BODY", 1, "CONSTANT", "P", None, None, "STRING", None, None, None, None),
    (2, "BODY", 2, "DINAMIC", None, None, None, "NUMBER", "999999999999", None, None, Q_CHECK_NUMBER),
    (2, "BODY", 3, "DINAMIC", None, None, None, "NUMBER", "999,999,990.00", None, None, Q_AMOUNT),
    (2, "BODY", 4, "DINAMIC", None, None, None, "DATE", "DD/MM/YYYY", None, None, Q_CHECK_DATE),
    (2, "BODY", 5, "DINAMIC", None, None, None, "STRING", None, None, None, Q_VENDOR),
    (2, "BODY", 6, "CONSTANT", "X", 1, 5, "STRING", None, None, "RIGHT", None),
    (2, "BODY", 7, "SEQUENCE1", None, 1, 6, "NUMBER", "999999", 48, "LEFT", None),
    (2, "BODY", 8, "SEQUENCE2", None, None, None, "NUMBER", "9999", None, None, None),
    (2, "DETAIL", 1, "CONSTANT", "D", None, None, "STRING", None, None, None, None),
    (2, "DETAIL", 2, "SEQUENCE2", None, None, None, "NUMBER", "9999", None, None, None),
    (2, "DETAIL", 3, "DINAMIC", None, None, None, "STRING", None, None, None, Q_INVOICE_NUM),
    (2, "TRAILER", 1, "CONSTANT", "T", None, None, "STRING", None, None, None, None),
    (2, "TRAILER", 2, "TRX_LINES", None, None, None, "NUMBER", "999999999", None, None, None),
    (2, "TRAILER", 3, "SUM_TRANS", None, None, None, "NUMBER", "9999999999990.00", None, None, None),
    # PAY TAB: body only.
    (3, "BODY", 1, "SEQUENCE1", None, None, None, "NUMBER", "99999999", None, None, None),
    (3, "BODY", 2, "DINAMIC", None, None, None, "STRING", None, None, None, Q_SITE),
    (3, "BODY", 3, "CONSTANT", "EFT", 1, 8, "STRING", None, 45, "RIGTH", None),
    (3, "BODY", 4, "DINAMIC", None, None, None, "NUMBER", "9999999990.00", None, None, Q_AMOUNT),
    # OLD FIXED (disabled).
    (4, "BODY", 1, "CONSTANT", "OLD", 1, 3, "STRING", None, None, None, None),
    # CONTROL ONLY: header and trailer, no body.
    (5, "HEADER", 1, "CONSTANT", "CTL", 1, 3, "STRING", None, None, None, None),
    (5, "TRAILER", 1, "TRX_LINES", None, 1, 6, "NUMBER", "000000", None, None, None),
]


def formats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_FORMATS, FORMATS)


def format_field_rows() -> list[tuple]:
    out = []
    for i, (fmt, part, seq, typ, const, s, e, dtype, mask, pad, direction, sql) in enumerate(_FIELDS):
        out.append((1000 + i, fmt, f"F{fmt}_{part}_{seq}", typ, const, seq, s, e, dtype, mask, pad,
                    direction, sql, part))
    return out


def format_fields(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(format_field_rows(), FORMAT_FIELDS)


FLEX_SEGMENT_SCHEMA = T.StructType([
    T.StructField("context_code", T.StringType()),
    T.StructField("application_column_name", T.StringType()),
    T.StructField("end_user_column_name", T.StringType()),
    T.StructField("column_seq_num", T.IntegerType()),
    T.StructField("value_set_name", T.StringType()),
    T.StructField("default_type", T.StringType()),
    T.StructField("default_value", T.StringType()),
    T.StructField("required_flag", T.StringType()),
])


def flex_segments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FLEX_SEGMENTS, FLEX_SEGMENT_SCHEMA)


def flex_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FLEX_RULES, "value_set_name string, kind string, minimum_value string, maximum_value string, "
                                             "number_precision int, maximum_size int")


def flex_domains(spark: SparkSession) -> DataFrame:
    rows = [(vs, code) for vs, codes in FLEX_DOMAINS.items() for code in codes]
    return spark.createDataFrame(rows, "value_set_name string, flex_value string")


# ---------------------------------------------------------------------------
# Legacy layouts (SRC-05/15), invented: master rows and their fields.  The last field's master is gone.
# ---------------------------------------------------------------------------
_LEGACY_FORMATS = [
    (1, "T", 200, "Old tab", "DELIMITED", 0, "Y"),
    (2, None, None, "Old positions", "POSITIONS", 2, "Y"),
    (3, ";", 80, "Old unused", "DELIMITED", None, "N"),
]
_LEGACY_FIELDS = [
    (10, 1, "K", "CONSTANT", "R", 1, None, None, "STRING", None, None, None, "N", None, "TRX"),
    (11, 1, "V", "DINAMIC", None, 2, None, None, "STRING", None, None, None, None, "SELECT check_id, vendor_name AS value FROM selection", "TRX"),
    (12, 1, "P", "CONSTANT", "x", 3, 1, 4, "STRING", None, "E", "LEFT", "Y", None, "TRX"),
    (20, 2, "K", "CONSTANT", "P\\TQ\\E", 1, 1, 6, "STRING", None, None, "RIGHT", "Y", None, "TRX"),
    (21, 2, "N", "DINAMIC", None, 2, 7, 16, "NUMBER", "99999999", None, "LEFT", "Y",
     "SELECT s.check_number FROM selection s WHERE s.check_id = :IDCHECK", "TRX"),
    (22, 2, "S", "SEQUENCE1", None, 3, 17, 23, "NUMBER", "9999999", None, "LEFT", "Y", None, "TRX"),
    (23, 2, "T", "TRX_LINES", None, 1, 1, 8, "NUMBER", "99999999", None, "LEFT", "N", None, "FOOTER"),
    (None, 3, "U", "CONSTANT", "unused", 1, None, None, "STRING", None, None, None, "N", None, "TRX"),
    (90, 9, "O", "CONSTANT", "orphan", 1, None, None, "STRING", None, None, None, "N", None, "TRX"),
]


def legacy_formats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_LEGACY_FORMATS, LEGACY_FORMATS)


def legacy_format_fields(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_LEGACY_FIELDS, LEGACY_FORMAT_FIELDS)
