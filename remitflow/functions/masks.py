"""Compile Oracle-style format masks into built-in Spark Column expressions.

Masks are data (one per layout field), but distinct masks are few, so each is
compiled once on the driver into ``date_format`` / ``format_number`` calls that
stay inside whole-stage codegen.  Spark's own ``to_char`` is not used: it
drops the sign column, prints ``0.50`` for a ``9.99`` mask and fills overflow
differently.  A mask with an element that is not known here gives NULL, which the
run reports as a missing value; the mask itself is never printed.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Oracle date-mask elements with a DateTimeFormatter pattern of their own, longest first.
_PATTERNS = {"YYYY": "yyyy", "RRRR": "yyyy", "HH24": "HH", "HH12": "hh", "DDD": "DDD", "YY": "yy", "RR": "yy", "MM": "MM",
             "DD": "dd", "HH": "hh", "MI": "mm", "SS": "ss"}
# Names: printed in the case of the mask, months and days padded to the longest English name.
_NAMES = {"MONTH": ("MMMM", 9), "MON": ("MMM", 0), "DAY": ("EEEE", 9), "DY": ("EEE", 0), "AM": ("a", 0), "PM": ("a", 0)}
_OTHERS: dict[str, Callable[[Column], Column]] = {
    "Q": lambda c: F.quarter(c).cast("string"),
    "WW": lambda c: F.lpad(F.ceil(F.dayofyear(c) / 7).cast("string"), 2, "0"),
    "IW": lambda c: F.lpad(F.weekofyear(c).cast("string"), 2, "0"),
    "D": lambda c: F.dayofweek(c).cast("string"),
}
_ELEMENT = re.compile("|".join(['"[^"]*"', *sorted([*_PATTERNS, *_NAMES, *_OTHERS], key=lambda t: (-len(t), t)), "[^A-Za-z0-9\"]+"]), re.I)


def date_elements(mask: str) -> list[str] | None:
    """The elements of a date mask; None if it has one that is not known."""
    found = _ELEMENT.findall(mask)
    return found if "".join(found) == mask else None


def _in_case_of(token: str, text: Column) -> Column:
    if token[:2].isupper():
        return F.upper(text)
    return F.initcap(text) if token[0].isupper() else F.lower(text)


def to_char_date(col: Column, mask: str | None) -> Column:
    """``TO_CHAR(date, mask)``; a NULL mask, or one with an unknown element, gives NULL."""
    elements = date_elements(mask) if mask is not None else None
    if elements is None:
        return F.lit(None).cast("string")
    parts: list[Column] = []
    pattern = ""

    def flush() -> None:
        nonlocal pattern
        if pattern:
            parts.append(F.date_format(col, pattern))
        pattern = ""

    for token in elements:
        name = token.upper()
        if name in _PATTERNS:
            pattern += _PATTERNS[name]
        elif name in _NAMES:
            flush()
            java, width = _NAMES[name]
            text = _in_case_of(token, F.date_format(col, java))
            parts.append(F.rpad(text, width, " ") if width else text)
        elif name in _OTHERS:
            flush()
            parts.append(_OTHERS[name](col))
        else:
            flush()
            parts.append(F.lit(token.strip('"')))
    flush()
    return F.when(col.isNotNull(), F.concat(*parts) if parts else F.lit(""))


_NUMBER_MASK = re.compile(r"(?P<fm>FM)?(?P<lead>S)?(?P<core>\$?[09,]*\$?(?:\.[09]*)?)(?P<trail>S|MI|PR)?", re.I)


def _parse_number_mask(mask: str):
    """Its parts, or None for a mask with an element that is not known."""
    m = _NUMBER_MASK.fullmatch(mask.strip().replace("G", ",").replace("D", "."))
    if not m or not re.search(r"[09]", m["core"]) or m["core"].count("$") > 1 or (m["lead"] and m["trail"]):
        return None
    core = m["core"].replace("$", "")
    int_part, _, dec_part = core.partition(".")
    first_zero = int_part.find("0")
    java_int = []
    for idx, ch in enumerate(int_part):
        if ch == ",":
            java_int.append(",")
        elif first_zero != -1 and idx >= first_zero:
            java_int.append("0")
        else:
            java_int.append("#")
    int_digits = sum(ch in "09" for ch in int_part)
    dec_digits = sum(ch in "09" for ch in dec_part)
    java = "".join(java_int) or "#"
    if java.startswith(","):
        java = java.lstrip(",") or "#"
    if "." in core:
        java += "." + "0" * dec_digits
    sign = "S+" if m["lead"] else (m["trail"] or "").upper()
    return bool(m["fm"]), java, int_digits, dec_digits, len(m["core"]), "$" in m["core"], sign


def to_char_number(col: Column, mask: str | None) -> Column:
    """``TO_CHAR(number, mask)`` for masks of ``9 0 , . G D $``, with ``FM`` before and ``S``, ``MI`` or ``PR`` around.

    Width is the mask's plus its sign's (a blank column for a positive number without a sign element);
    the value is rounded half away from zero; overflow prints ``#`` across the width.
    """
    parsed = _parse_number_mask(mask) if mask is not None else None
    if parsed is None:
        return F.lit(None).cast("string")
    fm, java, int_digits, dec_digits, core, dollar, sign = parsed
    x = F.round(col.cast("decimal(38,10)"), dec_digits)
    body = F.call_function("format_number", F.abs(x), F.lit(java))
    if dollar:
        body = F.concat(F.lit("$"), body)
    blank = "" if fm else " "

    def by_sign(negative: str, positive: str) -> Column:
        return F.when(x < 0, F.lit(negative)).otherwise(F.lit(positive))

    def fill(text: Column, width: int) -> Column:
        return text if fm else F.lpad(text, width, " ")

    width = core + (2 if sign == "PR" else 1)
    if sign == "S+":
        text = fill(F.concat(by_sign("-", "+"), body), width)
    elif sign == "S":
        text = F.concat(fill(body, core), by_sign("-", "+"))
    elif sign == "MI":
        text = F.concat(fill(body, core), by_sign("-", blank))
    elif sign == "PR":
        text = fill(F.concat(by_sign("<", blank), body, by_sign(">", blank)), width)
    else:
        text = fill(F.concat(by_sign("-", blank), body), width)
    overflow = F.abs(x) >= F.lit(10 ** int_digits)
    return F.when(col.isNull(), F.lit(None).cast("string")).when(
        overflow, F.lit("#" * width)).otherwise(text)


def money(col: Column) -> Column:
    """Register money column: ``TO_CHAR(x, '999,999,999.99')`` (15 characters)."""
    return to_char_number(col, "999,999,999.99")
