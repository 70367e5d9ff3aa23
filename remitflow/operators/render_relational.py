"""Relational rendering (RND-*, AGG-12): lines ⋈ layout rows, per-row field text, ordered fold per line.

The compiled renderer collects the layout to the driver; this form never does,
so it is the path for layouts beyond ``render.FIELD_ROW_LIMIT`` (many formats,
thousands of fields).  Only the *distinct* number masks, the format ids of each
part and the dynamic fields' definitions reach the driver, because a mask compiles to an
expression and a query text must be parsed by Spark.  Dynamic values come from
the same function as in the compiled renderer.  Both produce identical bytes (tested).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.masks import to_char_number
from ..functions.text import number_text
from ..schema import DELIMITED, PARTS, T_CONSTANT, T_DYNAMIC, T_SEQ1, T_SEQ2, T_SEQ3, T_SUM_TRANS, T_TRX_LINES
from ..session import bounded_broadcast
from .render import (LINE_COLUMNS, MISSING_COLUMNS, DynamicValues, FieldSpec, dynamic_values, expected_rows, field_projection,
                     line_contexts)

COUNTERS = {T_SEQ1: "seq1", T_SEQ2: "seq2", T_SEQ3: "seq3", T_TRX_LINES: "trx_lines", T_SUM_TRANS: "sum_trans"}


@dataclass
class PartsIndex:
    """Which formats define which part (at most 4 rows per format)."""
    by_part: dict

    @classmethod
    def load(cls, formats: DataFrame, fields: DataFrame) -> "PartsIndex":
        proj = field_projection(formats, fields).select("format_id", "part").distinct()
        by_part: dict = {p: set() for p in PARTS}
        for r in proj.collect():
            by_part.setdefault(r["part"], set()).add(r["format_id"])
        return cls(by_part)

    def formats_with(self, part: str) -> list[int]:
        return sorted(self.by_part.get(part, ()))


def _mask_chain(value: Column, mask: Column, masks: list[str], fn) -> Column:
    out = F.lit(None).cast("string")
    for m in masks:
        out = F.when(mask == m, fn(value, m)).otherwise(out)
    return out


def dynamic_specs(formats: DataFrame, fields: DataFrame) -> list[FieldSpec]:
    """The fields whose value is a query: each text has to be parsed by Spark, so they reach the driver."""
    proj = field_projection(formats, fields)
    return [FieldSpec(**r.asDict()) for r in proj.where((F.col("type_value") == T_DYNAMIC) & F.col("sql").isNotNull()).collect()]


def missing_relational(requests: DataFrame, selection: DataFrame, paid: DataFrame, formats: DataFrame, fields: DataFrame, parts: PartsIndex,
                       dyn: DynamicValues, contexts: dict[str, DataFrame] | None = None) -> DataFrame:
    """DQ-10 / RND-19: as ``render.missing_values``, without the layout on the driver.

    Expected values (lines ⋈ definitions of their format and part) less those that were found, an anti join on
    the query's key and the definition for each key.
    """
    definitions = field_projection(formats, fields).where(F.col("type_value") == T_DYNAMIC).select("format_id", "part", "definition_id")
    lines = None
    for part, base in expected_rows(requests, selection, paid, parts, contexts).items():
        c = base.withColumn("part", F.lit(part))
        lines = c if lines is None else lines.unionByName(c)
    left = lines.join(bounded_broadcast(definitions), ["format_id", "part"])
    for key, frame in dyn.frames.items():
        if set(key) <= set(left.columns):
            left = left.join(_long(key, frame).where(F.col("t").isNotNull()).select(*key, "definition_id"), [*key, "definition_id"], "left_anti")
    with_value = [fid for fid, text in dyn.scalars.items() if text is not None]
    if with_value:
        left = left.where(~F.col("definition_id").isin(with_value))
    return left.select(*MISSING_COLUMNS)


def _long(key: tuple, frame: DataFrame) -> DataFrame:
    """(key, definition_id, t): one row per dynamic field of a key."""
    ids = [c for c in frame.columns if c not in key]
    pairs = F.array(*[F.struct(F.lit(int(c[4:])).cast("bigint").alias("definition_id"), F.col(c).alias("t")) for c in ids])
    return frame.select(*key, F.explode(pairs).alias("_e")).select(*key, "_e.definition_id", "_e.t")


def render_relational(query: Callable[..., DataFrame], requests: DataFrame, selection: DataFrame, paid: DataFrame,
                      totals: DataFrame, formats: DataFrame, fields: DataFrame, binds: dict,
                      invoice_order: list[str], legacy: frozenset = frozenset(), hot_rows: int | None = None,
                      hot_files: list | None = None, wanted: dict[tuple, DataFrame] | None = None,
                      contexts: dict[str, DataFrame] | None = None, dyn: DynamicValues | None = None) -> DataFrame:
    """Same output as ``render.render_lines`` without collecting the layout.

    ``contexts``, ``dyn``: numbered lines and dynamic values, where the caller has them already.
    """
    parts = PartsIndex.load(formats, fields)
    proj = field_projection(formats, fields)
    ctxs = contexts if contexts is not None else line_contexts(requests, selection, paid, totals, parts, invoice_order, hot_rows, hot_files)
    lines = None
    for part, ctx in ctxs.items():
        c = ctx.withColumn("part", F.lit(part)).withColumn("from_part", F.lit(part))
        if part == "TRAILER" and "Q6" in legacy:  # the header's fields, in the trailer's context, come first
            c = c.unionByName(ctx.withColumn("part", F.lit(part)).withColumn("from_part", F.lit("HEADER")))
        lines = c if lines is None else lines.unionByName(c)
    # Layout rows are not broadcast here: this path exists for layouts too large to bound.
    x = lines.join(proj.withColumnRenamed("part", "from_part"), ["format_id", "from_part"])
    if dyn is None:
        dyn = dynamic_values(query, dynamic_specs(formats, fields), binds, legacy, wanted)
    dyn_text = F.lit(None).cast("string")
    for key, fr in dyn.frames.items():
        name = f"_dyn_{'_'.join(key)}"
        x = x.join(_long(key, fr).withColumnRenamed("t", name), [*key, "definition_id"], "left")
        dyn_text = F.coalesce(dyn_text, F.col(name))
    for fid, text in dyn.scalars.items():
        dyn_text = F.when(F.col("definition_id") == fid, F.lit(text)).otherwise(dyn_text)

    masks = [r["format_model"] for r in
             proj.where((F.col("data_type") == "NUMBER") & F.col("format_model").isNotNull()
                        & F.col("type_value").isin(*COUNTERS)).select("format_model").distinct().collect()]
    num = F.lit(None).cast("decimal(38,10)")
    for t, col in COUNTERS.items():
        num = F.when(F.col("type_value") == t, F.col(col).cast("decimal(38,10)")).otherwise(num)
    counter = (F.when(F.col("data_type") == "NUMBER",
                      F.trim(_mask_chain(num, F.col("format_model"), masks, to_char_number)))
               .when(F.col("data_type") == "DATE", F.lit(None).cast("string"))
               .otherwise(number_text(num)))
    const = F.col("constant_value")
    if "Q3" in legacy:
        const = F.when(F.col("data_type").isin("NUMBER", "DATE"), F.lit(None).cast("string")).otherwise(const)
    value = (F.when(F.col("type_value") == T_CONSTANT, const)
             .when(F.col("type_value") == T_DYNAMIC, dyn_text)
             .when(F.col("type_value").isin(*COUNTERS), counter))
    needs = F.col("needs_padding")
    needs = F.when(needs == "R", F.lit(None if "Q2" in legacy else "Y")).otherwise(needs)
    filled = F.coalesce(value, F.lit(" "))
    length = F.greatest(F.col("length"), F.lit(0))
    padded = (F.when(F.col("length").isNull(), F.lit(None).cast("string"))
              .when(F.col("direction") == "LEFT", F.lpad(filled, length, F.col("pad_char")))
              .otherwise(F.rpad(filled, length, F.col("pad_char"))))
    text = F.when(needs == "Y", padded).otherwise(value)
    delim = F.col("delimiter")
    text = F.when((F.col("format_type") == DELIMITED) & delim.isNotNull(),
                  F.concat(F.coalesce(F.replace(text, delim, F.lit("")), F.lit("")), delim)).otherwise(text)
    x = x.select("file_id", "format_id", "part", "seq1", "seq2", "seq3", "line_no", "format_type",
                 F.struct("secuence", "definition_id", text.alias("t"), (F.col("from_part") != F.col("part")).alias("header")).alias("_f"))
    folded = x.groupBy("file_id", "format_id", "part", "seq1", "seq2", "seq3", "line_no", "format_type").agg(
        F.array_sort(F.collect_list("_f")).alias("_fs"))

    def line_of(header: bool) -> Column:
        own = F.filter("_fs", lambda f: f["header"] == F.lit(header))
        line = F.concat_ws("", F.transform(own, lambda f: f["t"]))
        return F.when(F.col("format_type") == DELIMITED, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    return folded.select(*LINE_COLUMNS[:-1], F.concat(line_of(True), line_of(False)).alias("value"))
