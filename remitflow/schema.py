"""Entity schemas, enumerations and the job-request parameter object."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Send-status codes and the value set that translates them.
STATUS_NEW = "NEW"
STATUS_PRINTED = "PRINTED"
STATUS_VALUE_SET = "XX_EFT_STATUS_CHECK"
# Register titles value set and its codes.
TITLE_VALUE_SET = "XX_AP_PAY_REG_TITLE_REPORT"
TITLE_CODES = (
    "BANK", "BANK_ACCOUNT", "CHECK_AMOUNT", "CHECK_DATE", "CHECK_NUMBER", "DATE_TIME",
    "LEGAL_ENTITY", "PAYMENT_DOCUMENT", "REPORT_NAME", "SEND_STATUS", "SUPPLIER_NAME",
    "SUPPLIER_SITE",
)
# Users allowed to reset statuses are listed in this value set.
GRANT_VALUE_SET = "XXSVAPSETUPSTATUSCHECK"
# Parts of a file, in output order, and the legacy part names they replace.
PARTS = ("HEADER", "BODY", "DETAIL", "TRAILER")
LEGACY_PART_NAMES = {"TRX": "BODY", "FOOTER": "TRAILER"}
# Field value types.
T_CONSTANT, T_DYNAMIC = "CONSTANT", "DINAMIC"
T_SEQ1, T_SEQ2, T_SEQ3 = "SEQUENCE1", "SEQUENCE2", "SEQUENCE3"
T_TRX_LINES, T_SUM_TRANS = "TRX_LINES", "SUM_TRANS"
# File types and padding directions ("RIGTH" is the spelling the layout tables use).
DELIMITED, FIXED_WIDTH = "DELIMITED", "FIXED_WIDTH"
PAD_NONE, PAD_LEFT, PAD_RIGHT, PAD_RIGHT_ALT = "NONE", "LEFT", "RIGTH", "RIGHT"
# Process types.
DRAFT, FINAL = "DRAFT", "FINAL"
# Request defaults: base / top amount, unsent only.
DEFAULT_BASE_AMOUNT = Decimal("0.00")
DEFAULT_TOP_AMOUNT = Decimal("99999999.99")
# Register money mask and widths.
MONEY_MASK = "999,999,999.99"
RULE_WIDTH = 135
INVOICE_LIST_PREFIX = "DOCUMENTOS: "

MONEY = T.DecimalType(18, 2)
TOTAL_MONEY = T.DecimalType(38, 2)

CHECKS = T.StructType([
    T.StructField("check_id", T.LongType(), False),
    T.StructField("doc_sequence_value", T.LongType()),
    T.StructField("check_number", T.LongType()),
    T.StructField("amount", MONEY),
    T.StructField("check_date", T.TimestampNTZType()),
    T.StructField("vendor_id", T.LongType()),
    T.StructField("vendor_site_id", T.LongType()),
    T.StructField("payment_document_id", T.LongType()),
    T.StructField("ce_bank_acct_use_id", T.LongType()),
    T.StructField("payment_method_code", T.StringType()),
    T.StructField("payment_type_flag", T.StringType()),
    T.StructField("checkrun_id", T.LongType()),
    T.StructField("checkrun_name", T.StringType()),
    T.StructField("status_lookup_code", T.StringType()),
    T.StructField("attribute_category", T.StringType()),
    T.StructField("attribute14", T.StringType()),
    T.StructField("void_date", T.TimestampNTZType()),
])

FORMATS = T.StructType([
    T.StructField("format_id", T.LongType(), False),
    T.StructField("format_name", T.StringType(), False),
    T.StructField("format_type", T.StringType()),
    T.StructField("ascii_delimiter", T.IntegerType()),
    T.StructField("file_extension", T.StringType()),
    T.StructField("end_of_line", T.StringType()),
    T.StructField("enable_flag", T.StringType()),
])

FORMAT_FIELDS = T.StructType([
    T.StructField("definition_id", T.LongType()),
    T.StructField("format_id", T.LongType(), False),
    T.StructField("field_name", T.StringType()),
    T.StructField("type_value", T.StringType()),
    T.StructField("constant_value", T.StringType()),
    T.StructField("secuence", T.IntegerType()),
    T.StructField("start_position", T.IntegerType()),
    T.StructField("end_position", T.IntegerType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("format_model", T.StringType()),
    T.StructField("padding_character", T.IntegerType()),
    T.StructField("direction_padding", T.StringType()),
    T.StructField("sql_statement", T.StringType()),
    T.StructField("part_of_file", T.StringType()),
])

LEGACY_FORMATS = T.StructType([
    T.StructField("id_master", T.LongType(), False),
    T.StructField("delimiter", T.StringType()),
    T.StructField("max_value_length", T.IntegerType()),
    T.StructField("format_name", T.StringType(), False),
    T.StructField("type_text_file", T.StringType()),
    T.StructField("ce_bank_account_use_id", T.LongType()),
    T.StructField("enable", T.StringType()),
])

LEGACY_FORMAT_FIELDS = T.StructType([
    T.StructField("id_file_format", T.LongType()),
    T.StructField("id_master", T.LongType()),
    T.StructField("field_name", T.StringType()),
    T.StructField("type_value", T.StringType()),
    T.StructField("constant_value", T.StringType()),
    T.StructField("secuence", T.IntegerType()),
    T.StructField("start_position", T.IntegerType()),
    T.StructField("end_position", T.IntegerType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("padding_character", T.StringType()),
    T.StructField("direction_padding", T.StringType()),
    T.StructField("needs_padding", T.StringType()),
    T.StructField("sql_statement", T.StringType()),
    T.StructField("part_of_file", T.StringType()),
])

STATUS_LOG = T.StructType([
    T.StructField("check_id", T.LongType(), False),
    T.StructField("status", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("event_seq", T.LongType()),
])


@dataclass(frozen=True)
class RunParams:
    """Parameters of one run (the reference's concurrent-program parameters).

    Dates use the canonical text form ``YYYY/MM/DD HH24:MI:SS``.  ``None`` in an
    optional bound means "unbounded" with the reference's NVL semantics (rows
    whose column is NULL are still dropped).
    """

    start_date: str
    end_date: str
    run_id: str = "run-1"
    doc_ini: int | None = None
    doc_fin: int | None = None
    base_amount: Decimal | None = DEFAULT_BASE_AMOUNT
    top_amount: Decimal | None = DEFAULT_TOP_AMOUNT
    process_type: str = DRAFT
    only_unsent: str | None = "Y"
    lang: str = "US"
    as_of: str = "2014/04/25 09:09:17"
    set_status: str | None = None
    mark_category: str | None = None   # attribute context stamped with the status
    user_id: int | None = None
    checkrun_id: int | None = None
    legacy: frozenset = field(default_factory=frozenset)

    def with_(self, **kw) -> "RunParams":
        return replace(self, **kw)

    @property
    def status_check(self) -> str | None:
        """Second status admitted next to NEW (Y → NEW, N → PRINTED, else none)."""
        return {"Y": STATUS_NEW, "N": STATUS_PRINTED}.get(self.only_unsent or "")
