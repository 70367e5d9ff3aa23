"""Render payments into bank-file lines from layout metadata (RND-*, SET-01, AGG-12).

Layout rows are small configuration; after a row-count check they are
collected and compiled into one ``concat_ws`` expression per (format, part), so
rendering is a projection inside whole-stage codegen — no per-field join, no UDF.

Dynamic fields are *keyed queries*: SQL over the job's views returning key
columns (``check_id`` / ``invoice_id`` / ``file_id``) and ``value``.  All
dynamic fields of one key are evaluated together (one scan per query text, one
aggregation, one join), instead of one query per field per row.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.masks import to_char_date, to_char_number
from ..functions.text import number_text
from ..schema import (DELIMITED, FIXED_WIDTH, T_CONSTANT, T_DYNAMIC, T_SEQ1, T_SEQ2, T_SEQ3, T_SUM_TRANS,
                      T_TRX_LINES, RunParams)
from ..session import bounded_broadcast

FIELD_ROW_LIMIT = 50_000


@dataclass(frozen=True)
class FieldSpec:
    definition_id: int
    format_id: int
    format_type: str
    delimiter: str | None
    part: str
    secuence: int
    type_value: str
    constant_value: str | None
    length: int | None
    data_type: str | None
    format_model: str | None
    pad_char: str
    direction: str | None
    needs_padding: str | None
    sql: str | None


def field_projection(formats: DataFrame, fields: DataFrame) -> DataFrame:
    """PRJ-02 / PRJ-05 / RND-11 / FLT-13: enabled formats' fields with derived layout attributes."""
    f = fields.join(formats.where(F.col("enable_flag") == "Y"), "format_id")
    d = F.col("direction_padding")
    ft = F.col("format_type")
    direction = (F.when(ft == DELIMITED, d)
                 .when(ft == FIXED_WIDTH, F.when(F.coalesce(d, F.lit("NONE")) == "NONE", F.lit("RIGTH")).otherwise(d)))
    needs = (F.when(ft == FIXED_WIDTH, F.lit("Y"))
             .when(ft == DELIMITED, F.when(d == "NONE", F.lit("N")).when(d == "RIGTH", F.lit("Y"))
                   .when(d == "LEFT", F.lit("Y")).when(d == "RIGHT", F.lit("R"))))
    return f.select(
        "definition_id", "format_id", "format_type",
        F.when(F.col("ascii_delimiter").isNotNull(), F.chr("ascii_delimiter")).alias("delimiter"),
        F.col("part_of_file").alias("part"), "secuence", "type_value", "constant_value",
        (F.col("end_position") - F.col("start_position") + 1).alias("length"),
        "data_type", "format_model",
        F.chr(F.coalesce(F.col("padding_character"), F.lit(32))).alias("pad_char"),
        direction.alias("direction"), needs.alias("needs_padding"), F.col("sql_statement").alias("sql"),
    )


class LayoutTooLarge(ValueError):
    """More layout rows than the compiled renderer collects; use the relational renderer."""


def load_specs(formats: DataFrame, fields: DataFrame, limit: int = FIELD_ROW_LIMIT) -> list[FieldSpec]:
    proj = field_projection(formats, fields)
    rows = proj.limit(limit + 1).collect()
    if len(rows) > limit:
        raise LayoutTooLarge(f"more than {limit} layout fields")
    return sorted((FieldSpec(**r.asDict()) for r in rows), key=lambda s: (s.format_id, s.part, s.secuence))


# ---------------------------------------------------------------------------
# Field value → text
# ---------------------------------------------------------------------------

def legacy_number(value: Column) -> Column:
    """FN-10 / Q26: the legacy numeric fetch — strip '-' and blanks, then ``TO_NUMBER`` (NULL if not a number)."""
    text = F.replace(F.replace(value.cast("string"), F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))
    return text.try_cast("decimal(38,10)")


def typed_text(value: Column, data_type: str | None, mask: str | None, legacy: frozenset = frozenset()) -> Column:
    """RND-09: apply the field's type mask to a fetched value."""
    # A value that does not convert is NULL (Q23: a failed fetch becomes a missing value,
    # reported by quality.dynamic_values_missing), never an aborted job.
    if data_type == "DATE":
        return to_char_date(value.try_cast("timestamp_ntz"), mask)
    if data_type == "NUMBER":
        number = legacy_number(value) if "Q26" in legacy else value.try_cast("decimal(38,10)")
        return F.trim(to_char_number(number, mask))
    return value.cast("string")


def _counter(spec: FieldSpec, col: Column) -> Column:
    if spec.data_type == "NUMBER":
        return F.trim(to_char_number(col, spec.format_model))
    if spec.data_type == "DATE":
        return F.lit(None).cast("string")
    return number_text(col)


def field_text(spec: FieldSpec, legacy: frozenset = frozenset()) -> Column:
    """RND-01..12: one field of a line, as text, given the line's context columns."""
    t = spec.type_value
    if t == T_CONSTANT:
        s = F.lit(spec.constant_value).cast("string")
        if "Q3" in legacy and spec.data_type in ("NUMBER", "DATE"):
            s = F.lit(None).cast("string")
    elif t == T_DYNAMIC:
        s = F.col(f"dyn_{spec.definition_id}")
    elif t == T_SEQ1:
        s = _counter(spec, F.col("seq1"))
    elif t == T_SEQ2:
        s = _counter(spec, F.col("seq2"))
    elif t == T_SEQ3:
        s = _counter(spec, F.col("seq3"))
    elif t == T_TRX_LINES:
        s = _counter(spec, F.col("trx_lines"))
    elif t == T_SUM_TRANS:
        s = _counter(spec, F.col("sum_trans"))
    else:
        s = F.lit(None).cast("string")
    needs = spec.needs_padding
    if needs == "R":  # DELIMITED with the spelling RIGHT (quirk Q2)
        needs = None if "Q2" in legacy else "Y"
    if needs == "Y":
        s = F.coalesce(s, F.lit(" "))
        if spec.length is None:
            s = F.lit(None).cast("string")
        elif spec.direction == "LEFT":
            s = F.lpad(s, max(spec.length, 0), spec.pad_char)
        else:
            s = F.rpad(s, max(spec.length, 0), spec.pad_char)
    if spec.format_type == DELIMITED and spec.delimiter is not None:
        s = F.concat(F.coalesce(F.replace(s, F.lit(spec.delimiter), F.lit("")), F.lit("")), F.lit(spec.delimiter))
    return s


def line_expr(specs: list[FieldSpec], legacy: frozenset = frozenset()) -> Column:
    """AGG-12 / RND-13: fields in SECUENCE order; delimited lines drop their last character."""
    line = F.concat_ws("", *[field_text(s, legacy) for s in sorted(specs, key=lambda s: (s.secuence, s.definition_id))])
    if specs and specs[0].format_type == DELIMITED:
        line = F.substring(line, F.lit(1), F.length(line) - 1)
    return line


# ---------------------------------------------------------------------------
# Dynamic fields
# ---------------------------------------------------------------------------

_MARKER = re.compile(r"(?<![:\w]):([A-Za-z_][A-Za-z0-9_]*)")
_COMPARED = re.compile(r"([\w.]+)\s*(<=|>=|<>|!=|=|<|>)\s*:(\w+)\b")
_BETWEEN = re.compile(r"([\w.]+)\s+BETWEEN\s+(:\w+|[^\s()]+)\s+AND\s+(:\w+|[^\s()]+)", re.I)

# Views the keyed queries of a layout are written against.
VIEWS = ("selection", "paid", "invoices", "requests", "totals", "lines")
# RND-06: markers whose value is of the file, payment or invoice the field stands in, not of the job.
FILE_MARKERS = {"PAY_DOCUMENT": "payment_document_id", "V_TRX_LINES": "trx_lines", "V_SUM_TRANS": "sum_trans"}
CHECK_MARKERS = {"IDCHECK": "check_id", "CHECK_ID": "check_id", "IDCHECKRUN": "checkrun_id"}
INVOICE_MARKERS = {"INVOICEID": "invoice_id"}
# … or of the line itself: its running counter.
LINE_MARKERS = {"V_SEQUENCE3": "seq3"}


def job_binds(params: RunParams) -> dict:
    """RND-06: named job parameters available to keyed queries (end date bound to the end, Q5 fixed)."""
    fmt = "%Y/%m/%d %H:%M:%S"

    def ts(text):
        # a TIMESTAMP_NTZ SQL literal: a Python datetime would be shifted by the session time zone
        return F.expr(f"TIMESTAMP_NTZ '{datetime.strptime(text, fmt):%Y-%m-%d %H:%M:%S}'") if text else None
    return {
        "P_START_DATE": ts(params.start_date),
        "P_END_DATE": ts(params.end_date),
        "BASE_AMOUNT": params.base_amount,
        "TOP_AMOUNT": params.top_amount,
        "P_DOC_INI": params.doc_ini,
        "P_DOC_FIN": params.doc_fin,
        "CHECKRUN_ID": params.checkrun_id,
    }


ALT_MARK = "/*SQLS_ALT*/"


def choose_alternative(sql: str, batch_mode: bool) -> str:
    """RND-08: ``<batch query> /*SQLS_ALT*/ <range query>`` → the text for the run's mode."""
    if ALT_MARK not in sql:
        return sql
    first, second = sql.split(ALT_MARK, 1)
    return (first if batch_mode else second).strip()


def without_unset(sql: str, binds: dict) -> str:
    """RND-07: a predicate on a parameter that is not set compares its column with itself."""
    def unset(marker: str) -> bool:
        return marker in binds and binds[marker] is None

    def compared(m: re.Match) -> str:
        return f"{m[1]} {m[2] if '=' in m[2] and m[2] != '!=' else '='} {m[1]}" if unset(m[3]) else m[0]

    def between(m: re.Match) -> str:
        lo, hi = (m[1] if x.startswith(":") and unset(x[1:]) else x for x in (m[2], m[3]))
        return f"{m[1]} BETWEEN {lo} AND {hi}"
    return _COMPARED.sub(compared, _BETWEEN.sub(between, sql))


@contextmanager
def query_views(spark: SparkSession, **frames: DataFrame):
    """The frames as temporary views of this run only: yields a function from a query text to its
    DataFrame.  The names the queries use are bound inside each query, so runs in one session do
    not replace each other's views, nor the user's."""
    prefix = f"run_{uuid.uuid4().hex}_"
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)

    def query(sql: str, args: dict | None = None) -> DataFrame:
        names = ", ".join(f"{n} AS (SELECT * FROM {prefix}{n})" for n in frames)
        whole = f"WITH {names} SELECT * FROM (\n{sql}\n)"
        return spark.sql(whole, args=args) if args else spark.sql(whole)
    try:
        yield query
    finally:  # plans are resolved by now
        for name in frames:
            spark.catalog.dropTempView(prefix + name)


def uses_line_counters(specs: list[FieldSpec]) -> bool:
    """Whether a field's query asks for a counter of the line it stands in: lines are then numbered first."""
    return any(set(LINE_MARKERS) & set(_MARKER.findall(s.sql)) for s in specs if s.type_value == T_DYNAMIC and s.sql)


def run_keyed_query(query: Callable[..., DataFrame], sql: str, binds: dict, places: set[tuple[int, str]] | None = None) -> DataFrame:
    """A keyed query with its markers bound.

    Markers of the file, payment, invoice or line make the query lateral to the rows it is asked for,
    whose keys then are the result's: one join for all rows, for any number of documents.  ``places``: the
    (format, part) in which the query's fields stand; lines of others are not asked for.
    """
    sql = without_unset(choose_alternative(sql, binds.get("CHECKRUN_ID") is not None), binds)
    names = set(_MARKER.findall(sql))
    local = FILE_MARKERS | CHECK_MARKERS | INVOICE_MARKERS | LINE_MARKERS
    missing = names - set(binds) - set(local)
    if missing:
        raise ValueError(f"unbound parameters {sorted(missing)}")
    args = {k: binds[k] for k in names & set(binds)}
    if not names & set(local):
        return query(sql, args)
    bound = _MARKER.sub(lambda m: f"outer_row.{local[m[1]]}" if m[1] in local else m[0], sql)
    base = "SELECT r.file_id, r.payment_document_id, t.trx_lines, t.sum_trans{} FROM requests r JOIN totals t ON t.file_id = r.file_id{}"
    if names & set(LINE_MARKERS):
        keys = ("file_id", "line_no")
        at = " OR ".join(f"(l.format_id = {int(f)} AND l.part = '{p}')" for f, p in sorted(places or ())) or "TRUE"
        base = ("SELECT l.file_id, l.line_no, l.seq3, l.check_id, l.invoice_id, l.trx_lines, l.sum_trans, r.payment_document_id, s.checkrun_id"
                " FROM lines l JOIN requests r ON r.file_id = l.file_id"
                f" LEFT JOIN selection s ON s.file_id = l.file_id AND s.check_id = l.check_id WHERE {at}")
    elif names & set(INVOICE_MARKERS):
        keys, base = ("check_id", "invoice_id"), base.format(", p.check_id, p.invoice_id, s.checkrun_id",
            " JOIN (SELECT DISTINCT file_id, check_id, invoice_id FROM paid) p ON p.file_id = r.file_id"
            " JOIN selection s ON s.file_id = p.file_id AND s.check_id = p.check_id")
    elif names & set(CHECK_MARKERS):
        keys, base = ("check_id",), base.format(", s.check_id, s.checkrun_id", " JOIN selection s ON s.file_id = r.file_id")
    else:
        keys, base = ("file_id",), base.format("", "")
    own = [c for c in query(_MARKER.sub("NULL", sql)).columns]
    value = "value" if "value" in own else own[0] if len(own) == 1 else None
    if value is None:
        raise ValueError(f"no column named value among {own}")
    picked = [f"outer_row.{k}" for k in keys] + [f"q.{value} AS value"] + ["q.ord"] * ("ord" in own)
    if keys == ("file_id",) and set(own) - {"value", "ord"}:  # the query has keys of its own
        picked = [f"q.{c}" for c in own]
    if len({local[n] for n in names & set(local)}) > 1 and re.search(r"\bFROM\b", bound, re.I):
        # A value computed from a marker (`number + :V_SEQUENCE3`) makes Spark join the marker's values with every row the query
        # reads, and compare the keys only afterwards. Below a set operation it looks up by all markers at once, keys among them.
        bound = f"(\n{bound}\n) UNION ALL (SELECT {', '.join(['NULL'] * len(own))} WHERE FALSE)"
    return query(f"SELECT {', '.join(picked)} FROM ({base}) outer_row, LATERAL (\n{bound}\n) q", args)


KEY_SETS = (("file_id", "line_no"), ("check_id", "invoice_id"), ("check_id",), ("invoice_id",), ("file_id",), ())


def _key_of(columns: list[str]) -> tuple:
    extra = [c for c in columns if c not in ("value", "ord")]
    for k in KEY_SETS:
        if sorted(k) == sorted(extra):
            return k
    raise ValueError(f"keyed query must return key columns {KEY_SETS} plus value, got {columns}")


@dataclass
class DynamicValues:
    frames: dict          # key columns -> DataFrame(key..., dyn_<id>...)
    scalars: dict         # definition_id -> text (keyless queries)
    failed: dict          # definition_id -> why its query could not be run


def scalar_value(q: DataFrame, text: Column) -> str | None:
    """A keyless query's value: its first row, by ``ord`` or else by the text itself."""
    order = F.col("ord") if "ord" in q.columns else text
    row = q.select(order.alias("o"), text.alias("t")).orderBy("o").limit(1).collect()
    return row[0]["t"] if row else None


def first_per_key(q: DataFrame, key: tuple) -> DataFrame:
    """The first row of each key by the query's ``ord``, in its own type, then by value; without one, all rows."""
    if not key or "ord" not in q.columns:
        return q
    return q.groupBy(*key).agg(F.min(F.struct("ord", "value")).alias("_first")).select(*key, "_first.value")


def dynamic_values(query: Callable[..., DataFrame], specs: list[FieldSpec], binds: dict,
                   legacy: frozenset = frozenset(), wanted: dict[tuple, DataFrame] | None = None) -> DynamicValues:
    """Evaluate every dynamic field once, grouped by key (JN-23, RND-05, WIN-05).

    One scan for each distinct query text, one aggregation and one join for each key.  ``wanted``:
    the keys the run has, for keys whose queries read more than the run's own rows.

    The first row per key wins under the query's ``ord`` column when present,
    else the smallest rendered value — deterministic where the reference's
    single FETCH was not.  Keyless queries are scalars (first row only).  A query that
    Spark cannot run leaves its fields empty and is listed in ``failed``.
    """
    out = DynamicValues({}, {}, {})
    parts: dict[tuple, list[DataFrame]] = {}
    by_sql: dict[str, list[FieldSpec]] = {}
    for s in specs:
        if s.type_value == T_DYNAMIC and s.sql:
            by_sql.setdefault(s.sql, []).append(s)
    for sql, group in by_sql.items():
        texts = {s.definition_id: typed_text(F.col("value"), s.data_type, s.format_model, legacy) for s in group}
        try:
            q = run_keyed_query(query, sql, binds, {(s.format_id, s.part) for s in group})
            key = _key_of(q.columns)
            if not key:
                out.scalars.update({fid: scalar_value(q, text) for fid, text in texts.items()})
                continue
        except (ValueError, PySparkException) as e:
            why = str(e).strip().split("\n")[0][:200]
            out.failed.update({fid: why for fid in texts})
            continue
        if wanted and key in wanted:
            q = q.join(wanted[key], list(key), "left_semi")
        parts.setdefault(key, []).append(
            first_per_key(q, key).select(*key, *[text.alias(f"dyn_{fid}") for fid, text in texts.items()]))
    for key, frames in parts.items():
        u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        out.frames[key] = u.groupBy(*key).agg(*[F.min(c).alias(c) for c in u.columns if c not in key])
    return out


def _attach(lines: DataFrame, dyn: DynamicValues, part_specs: list[FieldSpec]) -> DataFrame:
    """Left-join the dynamic values a part needs (missing key → NULL, as a fetch with no row)."""
    need = {s.definition_id for s in part_specs if s.type_value == T_DYNAMIC}
    for k, fr in dyn.frames.items():
        cols = [c for c in fr.columns if c.startswith("dyn_") and int(c[4:]) in need]
        if not cols or not set(k) <= set(lines.columns):
            continue
        lines = lines.join(fr.select(*k, *cols), list(k), "left")
    for fid, text in dyn.scalars.items():
        if fid in need:
            lines = lines.withColumn(f"dyn_{fid}", F.lit(text).cast("string"))
    for fid in need:
        if f"dyn_{fid}" not in lines.columns:
            lines = lines.withColumn(f"dyn_{fid}", F.lit(None).cast("string"))
    return lines


def _by_format(specs: list[FieldSpec], part: str, legacy: frozenset) -> Column | None:
    per_fmt: dict[int, list[FieldSpec]] = {}
    for s in specs:
        if s.part == part:
            per_fmt.setdefault(s.format_id, []).append(s)
    if not per_fmt:
        return None
    expr = None
    for fid, fs in sorted(per_fmt.items()):
        e = line_expr(fs, legacy)
        expr = F.when(F.col("format_id") == fid, e) if expr is None else expr.when(F.col("format_id") == fid, e)
    return expr


# ---------------------------------------------------------------------------
# Line assembly
# ---------------------------------------------------------------------------

@dataclass
class Layout:
    specs: list[FieldSpec]
    parts: dict           # format_id -> set of parts

    @classmethod
    def load(cls, formats: DataFrame, fields: DataFrame) -> "Layout":
        specs = load_specs(formats, fields)
        parts: dict[int, set] = {}
        for s in specs:
            parts.setdefault(s.format_id, set()).add(s.part)
        return cls(specs, parts)

    def formats_with(self, part: str) -> list[int]:
        return sorted(f for f, ps in self.parts.items() if part in ps)


def _numbered_by_window(body: DataFrame, det: DataFrame, invoice_order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Files below the hot threshold: one window over payment + invoice lines gives every counter.

    Order: payment (check_number, check_id), its line first, then its invoices.  ``_pos`` is
    row_number; seq1 is the running count of payment lines; seq2 the running count of invoice
    lines minus that count at the payment's own line; seq3 = position - 1 (- 1 more on invoices).
    One exchange and one sort replace three windows and a join.
    """
    from pyspark.sql import Window
    both = body.withColumn("_sub", F.lit(0)).unionByName(det.withColumn("_sub", F.lit(1)), allowMissingColumns=True)
    order = [F.col("check_number"), F.col("check_id"), F.col("_sub")] + [F.col(c).asc_nulls_first() for c in invoice_order]
    w = Window.partitionBy("file_id").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = (both.withColumn("_pos", F.row_number().over(w).cast("bigint"))
            .withColumn("seq1", F.sum(1 - F.col("_sub")).over(upto).cast("bigint"))
            .withColumn("_dc", F.sum("_sub").over(upto).cast("bigint")))
    both = both.withColumn("_bd", F.max(F.when(F.col("_sub") == 0, F.col("_dc"))).over(upto))
    both = both.withColumn("seq2", F.when(F.col("_sub") == 1, F.col("_dc") - F.col("_bd")).cast("bigint")) \
        .withColumn("seq3", F.col("_pos") - 1 - F.col("_sub")).drop("_dc", "_bd")
    return both.where("_sub = 0"), both.where("_sub = 1")


def _numbered_by_sort(body: DataFrame, det: DataFrame, invoice_order: list[str], hot_rows, hot_files):
    """Hot files: the same counters as ``_numbered_by_window`` in one distributed pass.

    Lines are range-partitioned on (file, payment, part, invoice order), so a file spans many
    tasks; ids from ``monotonically_increasing_id`` are consecutive inside a partition and are
    frozen by a checkpoint.  A window per (file, partition) — bounded by the partition size —
    gives local running counts; a per-(file, partition) table (at most #hot files + #partitions
    rows, broadcast) gives each partition's offsets and the invoice count at the last payment
    line of earlier partitions (a payment's invoices may continue in the next partition).
    """
    from pyspark.sql import Window

    from ..session import ensure_checkpoint_dir
    both = body.withColumn("_sub", F.lit(0)).unionByName(det.withColumn("_sub", F.lit(1)), allowMissingColumns=True)
    keys = [F.col("file_id"), F.col("check_number"), F.col("check_id"), F.col("_sub")] + \
        [F.col(c).asc_nulls_first() for c in invoice_order]
    tagged = (both.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ensure_checkpoint_dir(both.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    upto = Window.partitionBy("file_id", "_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding,
                                                                             Window.currentRow)
    local = (tagged.withColumn("_lb", F.sum(1 - F.col("_sub")).over(upto))
             .withColumn("_ld", F.sum("_sub").over(upto)))
    local = local.withColumn("_lbd", F.max(F.when(F.col("_sub") == 0, F.col("_ld"))).over(upto))
    stats = local.groupBy("file_id", "_pid").agg(
        F.min("_mid").alias("_lo"), F.count(F.lit(1)).alias("_n"), F.sum(1 - F.col("_sub")).alias("_nb"),
        F.sum("_sub").alias("_nd"), F.max(F.when(F.col("_sub") == 0, F.col("_ld"))).alias("_mbd"))
    before = Window.partitionBy("file_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        "file_id", "_pid", "_lo", "_mbd",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_on"),
        F.coalesce(F.sum("_nb").over(before), F.lit(0)).alias("_ob"),
        F.coalesce(F.sum("_nd").over(before), F.lit(0)).alias("_od"))
    # invoice count (file-wide) at the last payment line of any earlier partition
    offsets = offsets.withColumn("_carry", F.max(F.col("_od") + F.col("_mbd")).over(before)).drop("_mbd")
    j = local.join(F.broadcast(offsets), ["file_id", "_pid"])
    dcum = F.col("_od") + F.col("_ld")
    bd = F.coalesce(F.col("_od") + F.col("_lbd"), F.col("_carry"))
    out = (j.withColumn("_pos", (F.col("_on") + F.col("_mid") - F.col("_lo") + 1).cast("bigint"))
           .withColumn("seq1", (F.col("_ob") + F.col("_lb")).cast("bigint"))
           .withColumn("seq2", F.when(F.col("_sub") == 1, dcum - bd).cast("bigint")))
    out = out.withColumn("seq3", F.col("_pos") - 1 - F.col("_sub")).drop(
        "_pid", "_mid", "_lb", "_ld", "_lbd", "_lo", "_on", "_ob", "_od", "_carry")
    return out.where("_sub = 0"), out.where("_sub = 1")


def detail_formats(layout) -> list[int]:
    """Formats with invoice lines: they stand under their payment's line, so only with a BODY."""
    return sorted(set(layout.formats_with("DETAIL")) & set(layout.formats_with("BODY")))


def sequence_lines(selection: DataFrame, paid: DataFrame, layout: Layout, invoice_order: list[str],
                   hot_rows: int | None = None, hot_files: list | None = None):
    """WIN-01..04: body lines with seq1, seq3, line position; detail lines with seq1, seq2, seq3, position.

    Only files whose format defines the part get its lines (RND-18).  ``_pos``
    is the 1-based place of a line among its file's payment and invoice lines.
    ``paid`` must carry ``check_number``.
    """
    from .sequences import hot_groups, hot_rows_of
    body = selection.where(F.col("format_id").isin(layout.formats_with("BODY")))
    det = paid.where(F.col("format_id").isin(detail_formats(layout)))
    if "check_number" not in det.columns:
        det = det.join(selection.select("file_id", "check_id", "check_number"), ["file_id", "check_id"])
    if hot_files is None:
        hot_rows = hot_rows if hot_rows is not None else hot_rows_of(selection.sparkSession)
        hot_files = hot_groups(body.select("file_id").unionByName(det.select("file_id")), ["file_id"], hot_rows)
    if not hot_files:
        return _numbered_by_window(body, det, invoice_order)
    hot = F.broadcast(selection.sparkSession.createDataFrame(hot_files, "file_id string"))
    cb, cd = _numbered_by_window(body.join(hot, "file_id", "left_anti"), det.join(hot, "file_id", "left_anti"),
                                 invoice_order)
    hb, hd = _numbered_by_sort(body.join(hot, "file_id", "left_semi"), det.join(hot, "file_id", "left_semi"),
                               invoice_order, hot_rows, hot_files)
    return cb.unionByName(hb, allowMissingColumns=True), cd.unionByName(hd, allowMissingColumns=True)


def line_contexts(requests: DataFrame, selection: DataFrame, paid: DataFrame, totals: DataFrame, parts,
                  invoice_order: list[str], hot_rows: int | None = None,
                  hot_files: list | None = None) -> dict[str, DataFrame]:
    """Per part, one context row per output line: keys, counters (seq1/2/3), file totals, line_no.

    ``parts`` answers ``formats_with(part)`` (a Layout or a PartsIndex).  Files with an empty
    selection get no lines (DQ-01); files whose format is missing or disabled get none (DQ-03).
    """
    req = requests.select("file_id", "format_id").join(totals, "file_id")   # inner: empty files vanish
    fmt_of = requests.select("file_id", "format_id")
    sel = selection if "format_id" in selection.columns else selection.join(fmt_of, "file_id")
    pd_ = paid if "format_id" in paid.columns else paid.join(fmt_of, "file_id")
    # Only what numbers and names a line is sorted and checkpointed.
    keys = ["file_id", "format_id", "check_id", "check_number"]
    body, det = sequence_lines(sel.select(*keys), pd_.select(*dict.fromkeys([c for c in keys if c in pd_.columns] + ["invoice_id", *invoice_order])),
                               parts, invoice_order, hot_rows, hot_files)
    tot_b = bounded_broadcast(totals)  # one row per file
    has_header = F.col("format_id").isin(parts.formats_with("HEADER")).cast("bigint")
    has_body = F.col("format_id").isin(parts.formats_with("BODY"))
    none = F.lit(None).cast("bigint")
    out = {}
    if parts.formats_with("HEADER"):
        out["HEADER"] = req.where(F.col("format_id").isin(parts.formats_with("HEADER"))).select(
            "file_id", "format_id", none.alias("check_id"), none.alias("invoice_id"), "trx_lines", "sum_trans",
            F.lit(0).cast("bigint").alias("seq1"), F.lit(0).cast("bigint").alias("seq2"),
            F.lit(0).cast("bigint").alias("seq3"), F.lit(1).cast("bigint").alias("line_no"))
    if parts.formats_with("BODY"):
        out["BODY"] = body.join(tot_b, "file_id").select(
            "file_id", "format_id", "check_id", none.alias("invoice_id"), "trx_lines", "sum_trans", "seq1",
            none.alias("seq2"), "seq3", (F.col("_pos") + has_header).alias("line_no"))
    if detail_formats(parts):
        out["DETAIL"] = det.join(tot_b, "file_id").select(
            "file_id", "format_id", "check_id", "invoice_id", "trx_lines", "sum_trans", "seq1", "seq2", "seq3",
            (F.col("_pos") + has_header).alias("line_no"))
    if parts.formats_with("TRAILER"):
        n_det = pd_.where(F.col("format_id").isin(detail_formats(parts))) \
            .groupBy("file_id").agg(F.count(F.lit(1)).alias("_nd"))
        t = req.where(F.col("format_id").isin(parts.formats_with("TRAILER"))).join(n_det, "file_id", "left")
        seq3 = (F.when(has_body, F.col("trx_lines")).otherwise(F.lit(0)) + F.coalesce(F.col("_nd"), F.lit(0)))
        out["TRAILER"] = t.select(
            "file_id", "format_id", none.alias("check_id"), none.alias("invoice_id"), "trx_lines", "sum_trans",
            F.when(has_body, F.col("trx_lines") + 1).otherwise(F.lit(0)).cast("bigint").alias("seq1"),
            none.alias("seq2"), seq3.cast("bigint").alias("seq3"), (seq3 + has_header + 1).cast("bigint").alias("line_no"))
    return out


LINE_COLUMNS = ("file_id", "format_id", "part", "seq1", "seq2", "seq3", "line_no", "value")


def expected_rows(requests: DataFrame, selection: DataFrame, paid: DataFrame, layout,
                  contexts: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Per part, (file_id, format_id, check_id, invoice_id[, line_no]) of the lines its fields stand in.

    ``contexts``: numbered lines, where the run has them; only they know a line's number.
    """
    if contexts is not None:
        return {part: c.select("file_id", "format_id", "check_id", "invoice_id", "line_no") for part, c in contexts.items()}
    none = F.lit(None).cast("bigint")
    used = requests.join(selection.select("file_id").distinct(), "file_id", "left_semi")
    rows = {"HEADER": used.select("file_id", "format_id", none.alias("check_id"), none.alias("invoice_id")),
            "BODY": selection.select("file_id", "format_id", "check_id", none.alias("invoice_id")),
            "DETAIL": paid.where(F.col("format_id").isin(detail_formats(layout))).select("file_id", "format_id", "check_id", "invoice_id")}
    rows["TRAILER"] = rows["HEADER"]
    return rows


MISSING_COLUMNS = ("file_id", "part", "check_id", "invoice_id", "definition_id")
_MISSING_SCHEMA = "file_id string, part string, check_id long, invoice_id long, definition_id long"


def _without_value(specs: list[FieldSpec]) -> Column:
    """The definitions of a line's dynamic fields that have no value."""
    lacks = [((F.col("format_id") == s.format_id) & F.col(f"dyn_{s.definition_id}").isNull(), F.lit(s.definition_id).cast("bigint"))
             for s in specs if s.type_value == T_DYNAMIC]
    if not lacks:
        return F.lit(None).cast("array<bigint>")
    # The array is made only for a line that lacks a value.
    return F.when(reduce(Column.__or__, [c for c, _ in lacks]), F.array_compact(F.array(*[F.when(c, i) for c, i in lacks])))


def missing_values(requests: DataFrame, selection: DataFrame, paid: DataFrame, layout: Layout, dyn: DynamicValues,
                   contexts: dict[str, DataFrame] | None = None) -> DataFrame:
    """DQ-10 / RND-19: (file_id, part, check_id, invoice_id, definition_id) of every dynamic field without a value."""
    out = None
    for part, base in expected_rows(requests, selection, paid, layout, contexts).items():
        specs = [s for s in layout.specs if s.part == part and s.type_value == T_DYNAMIC]
        if not specs:
            continue
        c = _attach(base.where(F.col("format_id").isin(sorted({s.format_id for s in specs}))), dyn, specs)
        found = c.select("file_id", F.lit(part).alias("part"), "check_id", "invoice_id", F.explode(_without_value(specs)).alias("definition_id"))
        out = found if out is None else out.unionByName(found)
    return requests.sparkSession.createDataFrame([], _MISSING_SCHEMA) if out is None else out


def render_lines(spark: SparkSession, requests: DataFrame, selection: DataFrame, paid: DataFrame,
                 totals: DataFrame, layout: Layout, dyn: DynamicValues, invoice_order: list[str],
                 legacy: frozenset = frozenset(), hot_rows: int | None = None,
                 hot_files: list | None = None, contexts: dict[str, DataFrame] | None = None) -> DataFrame:
    """RND-14..18 + SET-01 (compiled form): (file_id, format_id, part, seq1, seq2, seq3, line_no, value, missing).

    ``missing``: the definitions of the line's own dynamic fields without a value (DQ-10; NULL if there are none), so that a job which writes the lines
    need not fetch the values a second time to report them.
    """
    specs = layout.specs
    ctxs = contexts if contexts is not None else line_contexts(requests, selection, paid, totals, layout, invoice_order, hot_rows, hot_files)
    header_expr = _by_format(specs, "HEADER", legacy)
    out = []
    for part, ctx in ctxs.items():
        expr = _by_format(specs, part, legacy)
        own = [s for s in specs if s.part == part]
        c = _attach(ctx, dyn, own)
        if part == "TRAILER" and "Q6" in legacy and header_expr is not None:
            c = _attach(c, dyn, [s for s in specs if s.part == "HEADER"])
            expr = F.concat_ws("", F.when(F.col("format_id").isin(layout.formats_with("HEADER")), header_expr), expr)
        out.append(c.select("file_id", "format_id", F.lit(part).alias("part"), "seq1", "seq2", "seq3", "line_no",
                            expr.alias("value"), _without_value(own).alias("missing")))
    lines = out[0]
    for o in out[1:]:
        lines = lines.unionByName(o)
    return lines
