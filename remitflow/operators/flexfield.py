"""Context-dependent attribute columns (descriptive flexfield) → named columns (FLX-01..05, DQ-05..07).

Two forms of the same projection.  Compiled: few segments become one ``CASE WHEN context = c THEN
COALESCE(attributeN, default) END`` per logical column.  Relational: any number of segments is grouped into one
row per context (its segments in an array) and joined to the payments on the context; each payment then reads
its own columns through the map (column → value).  No per-row lookup, no UDF, no payment is shuffled by key.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bounded_broadcast

#: Segments up to which the projection is compiled into expressions; more go through the join.
COMPILE_SEGMENTS = 1_000


def logical_name(end_user_name: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", end_user_name.lower()).strip("_")


def _segments(segments: DataFrame) -> list[dict] | None:
    """The segments, or None when there are more than a compiled projection takes."""
    rows = segments.limit(COMPILE_SEGMENTS + 1).collect()
    return None if len(rows) > COMPILE_SEGMENTS else [r.asDict() for r in rows]


def _attribute_map(df: DataFrame) -> Column:
    """Column name (upper case) → value of every generic attribute column the rows have."""
    names = [c for c in df.columns if re.fullmatch(r"(?i)attribute[0-9]+", c)]
    if not names:
        return F.create_map().cast("map<string,string>")
    return F.map_from_arrays(F.array(*[F.lit(c.upper()) for c in names]), F.array(*[F.col(c).cast("string") for c in names]))


def _by_context(df: DataFrame, segments: DataFrame, context_col: str) -> DataFrame:
    """``df`` with ``_segments``: the segments of its row's context in their order (rows of contexts without any go)."""
    optional = ("value_set_name", "default_type", "default_value", "required_flag")
    have = segments.select("context_code", "column_seq_num", F.upper("application_column_name").alias("column"),
                           F.col("end_user_column_name").alias("segment"), F.col("application_column_name").alias("written"),
                           *[(F.col(c) if c in segments.columns else F.lit(None)).cast("string").alias(c) for c in optional])
    grouped = have.groupBy("context_code").agg(F.array_sort(F.collect_list(F.struct(
        "column_seq_num", "segment", "column", "written", *optional))).alias("_segments"))
    return df.withColumn("_attributes", _attribute_map(df)).join(
        bounded_broadcast(grouped), F.col(context_col) == F.col("context_code"))


def _value(segment: Column, apply_default: bool) -> Column:
    own = F.col("_attributes")[segment["column"]]
    return F.coalesce(own, F.when(segment["default_type"] == "C", segment["default_value"])) if apply_default else own


def _attr(df: DataFrame, column: str) -> Column:
    c = column.lower()
    return F.col(c) if c in df.columns else F.lit(None).cast("string")


def segment_value(df: DataFrame, seg: dict, apply_default: bool = True) -> Column:
    """FLX-03: constant defaults (type C) fill NULLs; other default types need a query (FLX-04)."""
    v = _attr(df, seg["application_column_name"])
    if apply_default and seg.get("default_type") == "C" and seg.get("default_value") is not None:
        v = F.coalesce(v, F.lit(seg["default_value"]))
    elif apply_default and seg.get("default_type") == "S" and seg.get("default_value"):
        v = F.coalesce(v, F.lit(sql_default(df.sparkSession, seg["default_value"])))
    return v


def sql_default(spark, query: str):
    """FLX-04 / FLT-21: a default given as a query: its first column of its first row (NULL if none).

    The query is expected to order its rows; only one scalar reaches the driver.
    """
    rows = spark.sql(query).limit(1).collect()
    return None if not rows else (None if rows[0][0] is None else str(rows[0][0]))


def context_listing(contexts: DataFrame, name_like: str | None = None) -> DataFrame:
    """PRJ-08 / SRT-04 / FLT-18: contexts of a flexfield, global context first, then by code."""
    c = contexts if name_like is None else contexts.where(F.col("flexfield_name").like(name_like))
    return c.orderBy(F.when(F.col("global_flag") == "Y", 1).otherwise(2), "context_code")


def segment_listing(segments: DataFrame, context: str) -> DataFrame:
    """PRJ-08 / SRT-05: a context's segments by column sequence."""
    return segments.where(F.col("context_code") == context).orderBy("column_seq_num")


def locate_column(segments: DataFrame, end_user_name: str) -> DataFrame:
    """PRJ-09 / FLX-05: physical column(s) holding a logical segment name, per context."""
    return segments.where(F.col("end_user_column_name") == end_user_name) \
        .select("context_code", "application_column_name")


def project_context(df: DataFrame, segments: DataFrame, keep: list[str], context_col: str = "attribute_category",
                    apply_default: bool = True, form: str = "auto") -> DataFrame:
    """FLX-01: one named column per (context, segment); NULL on rows of other contexts.

    ``form``: ``compiled``, ``relational``, or ``auto``: compiled for few segments.  Both give the same rows.
    """
    segs = None if form == "relational" else _segments(segments)
    if segs is None:
        return _project_relational(df, segments, keep, context_col, apply_default)
    by_name: dict[str, Column] = {}
    for s in sorted(segs, key=lambda s: (s["context_code"], s["column_seq_num"])):
        name = logical_name(s["end_user_column_name"])
        expr = F.when(F.col(context_col) == s["context_code"], segment_value(df, s, apply_default))
        by_name[name] = expr if name not in by_name else F.coalesce(by_name[name], expr)
    return df.select(*keep, *[e.alias(n) for n, e in by_name.items()])


def _with_query_defaults(segments: DataFrame) -> DataFrame:
    """FLX-04 for any number of segments: each distinct default query runs once, its scalar becomes a constant."""
    queries = [r[0] for r in segments.where((F.col("default_type") == "S") & (F.col("default_value") != "")).select("default_value").distinct().collect()]
    if not queries:
        return segments
    spark = segments.sparkSession
    found = spark.createDataFrame([(q, sql_default(spark, q)) for q in queries], "default_value string, _scalar string")
    own = segments.join(bounded_broadcast(found), "default_value", "left")
    ran = F.col("default_type") == "S"
    return own.withColumn("default_value", F.when(ran, F.col("_scalar")).otherwise(F.col("default_value"))) \
        .withColumn("default_type", F.when(ran, F.lit("C")).otherwise(F.col("default_type"))).drop("_scalar")


def _project_relational(df: DataFrame, segments: DataFrame, keep: list[str], context_col: str, apply_default: bool) -> DataFrame:
    """The projection as a join on the context.  Only the output's own column names reach the driver."""
    name = F.trim(F.regexp_replace(F.lower("end_user_column_name"), "[^0-9a-z]+", "_"), F.lit("_"))
    named = _with_query_defaults(segments).withColumn("end_user_column_name", name)
    names = [r[0] for r in named.groupBy("end_user_column_name").agg(F.min(F.struct("context_code", "column_seq_num")).alias("first"))
             .orderBy("first", "end_user_column_name").select("end_user_column_name").collect()]
    rows = _by_context(df, named, context_col)
    # Of several segments of a name the first with a value counts, as in the compiled form.
    found = F.filter(F.transform("_segments", lambda x: F.struct(x["segment"].alias("name"), _value(x, apply_default).alias("value"))),
                     lambda x: x["value"].isNotNull())
    first = F.aggregate(found, F.create_map().cast("map<string,string>"), lambda held, x: F.when(
        F.map_contains_key(held, x["name"]), held).otherwise(F.map_concat(held, F.create_map(x["name"], x["value"]))))
    inside = rows.select(*keep, first.alias("_named")).select(*keep, *[F.col("_named")[n].alias(n) for n in names])
    contexts = bounded_broadcast(segments.select(F.col("context_code").alias("_c")).distinct())
    outside = df.join(contexts, F.col(context_col) == F.col("_c"), "left_anti").select(
        *keep, *[F.lit(None).cast("string").alias(n) for n in names])
    return inside.unionByName(outside)


def unpivot(df: DataFrame, segments: DataFrame, key: str = "check_id", context_col: str = "attribute_category",
            apply_default: bool = False, keep_nulls: bool = False) -> DataFrame:
    """FLX-02: (key, context, segment, column, value) for every defined, non-NULL segment value."""
    long = _by_context(df, segments, context_col).select(key, "context_code", "_attributes", F.explode("_segments").alias("_s"))
    out = long.select(key, "context_code", F.col("_s.segment").alias("segment"), F.col("_s.written").alias("application_column_name"),
                      _value(F.col("_s"), apply_default).alias("value"), F.col("_s.value_set_name").alias("value_set_name"),
                      F.col("_s.required_flag").alias("required_flag"))
    return out if keep_nulls else out.where(F.col("value").isNotNull()).drop("required_flag")


def domain_violations(df: DataFrame, segments: DataFrame, domains: DataFrame, key: str = "check_id",
                      context_col: str = "attribute_category") -> DataFrame:
    """DQ-05: segment values (after constant defaults) outside their value set, as a left-anti join."""
    long = unpivot(df, segments, key, context_col, apply_default=True).where(F.col("value_set_name").isNotNull())
    known_sets = bounded_broadcast(domains.select("value_set_name").distinct())
    long = long.join(known_sets, "value_set_name", "left_semi")
    bad = long.join(bounded_broadcast(domains.select("value_set_name", F.col("flex_value").alias("value"))),
                    ["value_set_name", "value"], "left_anti")
    return bad.select(F.lit("DQ-05 value outside value set").alias("check_name"), F.col(key).cast("string").alias("key"),
                      F.concat_ws("=", F.col("segment"), F.col("value")).alias("detail"))


def segment_rules(df: DataFrame, segments: DataFrame, rules: DataFrame, domains: DataFrame, key: str = "check_id",
                  context_col: str = "attribute_category") -> DataFrame:
    """DQ-05/06/07: every segment value (constant defaults applied) against what the metadata says of its segment
    and value set, in one pass over the payments: required, code list, number, least and greatest value,
    decimals, number of characters.  Any number of segments, rules and codes; one row per violation.

    A set without a rule restricts nothing; a NULL bound is no bound.  Numbers are compared as decimals.
    """
    long = unpivot(df, segments, key, context_col, apply_default=True, keep_nulls=True)
    long = long.join(bounded_broadcast(rules.dropDuplicates(["value_set_name"])), "value_set_name", "left")
    codes = domains.select("value_set_name", F.col("flex_value").alias("value"), F.lit(True).alias("_listed")).distinct()
    long = long.join(bounded_broadcast(codes), ["value_set_name", "value"], "left")
    value, number = F.col("value"), F.expr("try_cast(value AS DECIMAL(38,10))")
    is_number = (F.col("kind") == "NUMBER") & value.isNotNull()

    def bound(c: str) -> Column:
        return F.expr(f"try_cast({c} AS DECIMAL(38,10))")

    decimals = F.col("number_precision")
    # Decimals beyond the allowed ones leave a rest when the value is scaled up and cut.
    scaled = number * F.pow(F.lit(10), decimals).cast("decimal(11,0)")
    violated = [
        ("DQ-05 value outside value set", (F.col("kind") == "LIST") & value.isNotNull() & F.col("_listed").isNull()),
        ("DQ-06 not a number", is_number & number.isNull()),
        ("DQ-06 below minimum", is_number & (number < bound("minimum_value"))),
        ("DQ-06 above maximum", is_number & (number > bound("maximum_value"))),
        ("DQ-06 too many decimals", is_number & decimals.between(0, 9) & (scaled != F.floor(scaled))),
        ("DQ-06 too long", F.length(value) > F.col("maximum_size")),
        ("DQ-07 required value missing", (F.col("required_flag") == "Y") & value.isNull()),
    ]
    found = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in violated]))
    return long.select(F.explode(found).alias("check_name"), F.col(key).cast("string").alias("key"),
                       F.concat_ws("=", F.col("segment"), value).alias("detail"))


def with_resolved_column(df: DataFrame, segments: DataFrame, end_user_name: str, out: str,
                         context_col: str = "attribute_category") -> DataFrame:
    """FLX-05 / Q35: add ``out`` = the physical column that holds ``end_user_name`` in each row's
    context (NULL in contexts without that segment).  With ``out`` as the selection's status
    column, a request number stored in the same physical column elsewhere is not read as a status."""
    where = [r.asDict() for r in locate_column(segments, end_user_name).collect()]
    expr = F.lit(None).cast("string")
    for w in where:
        expr = F.when(F.col(context_col) == w["context_code"], _attr(df, w["application_column_name"])) \
            .otherwise(expr)
    return df.withColumn(out, expr)
