"""Text helpers with the reference's string semantics, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cat(*cols: Column) -> Column:
    """``a || b || …`` where NULL acts as the empty string (Spark's ``concat`` would return NULL)."""
    return F.concat_ws("", *cols)


def number_text(col: Column) -> Column:
    """``TO_CHAR(n)`` without a mask: no trailing fractional zeros, no trailing point."""
    s = col.cast("string")
    stripped = F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(F.instr(s, ".") > 0, stripped).otherwise(s)


def latin1(col: Column) -> Column:
    """Replace characters outside ISO-8859-1 by an inverted question mark before encoding."""
    return F.regexp_replace(col, "[^\\x{00}-\\x{FF}]", "¿")


# Escape codes in legacy constants and single-letter codes for
# delimiter / padding characters.
ESCAPES = (("\\T", "\t"), ("\\E", " "), ("\\N", ""))
LETTER_CODES = {"T": "\t", "E": " "}


def decode_escapes(col: Column, codes=ESCAPES) -> Column:
    out = col
    for code, repl in codes:
        out = F.replace(out, F.lit(code), F.lit(repl))
    return out


def letter_code(col: Column) -> Column:
    out = col
    for letter, ch in LETTER_CODES.items():
        out = F.when(col == letter, F.lit(ch)).otherwise(out)
    return out


def yes_no(col: Column) -> Column:
    """Boolean → 'Y' / 'N' (NULL → 'N')."""
    return F.when(col, F.lit("Y")).otherwise(F.lit("N"))


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime, independent of any time zone setting.

    (A Python datetime passed to ``F.lit`` becomes a session-time-zone timestamp.)
    """
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.to_timestamp_ntz(F.lit(value.strftime("%Y-%m-%d %H:%M:%S")), F.lit("yyyy-MM-dd HH:mm:ss"))
