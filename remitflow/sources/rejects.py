"""Reject report of landed files (SNK-09): which record, bad or discarded, and why.

A record is ``BAD`` when it cannot be loaded (too few or too many columns, a value that does not convert, a
required value that is missing) and ``DISCARDED`` when it can be but does not meet the load condition.  Records are
counted per physical line of their file, blank ones included.  A file may be read in many splits: a line's
number is its place in its split plus the lines of the splits before, a prefix sum over one row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .ingest import path_of

BAD, DISCARDED = "BAD", "DISCARDED"
_EMPTY = "\u0001"   # how the parser writes a value that is there but empty; a column that is not there is NULL
_END = "\u0002"     # one column more, behind the last one: tells an empty last column from an absent one
OUT = ("file_path", "record_no", "kind", "column_name", "reason", "raw_record")


#: Tasks that read landed files, for each core: small files go together into one.
_TASKS_A_CORE = 4


def _landed_records(spark: SparkSession, path: str, parsed: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Every line of every landed file, written once with its place in its split (and ``parsed`` as ``_r``); and what stands
    before each split."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path).select(
        path_of("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"), F.col("value").alias("raw_record"))
    if parsed is not None:
        raw = raw.withColumn("_r", parsed)
    # Ids count by the partitions of the scan, however many of these a task reads; written, they are frozen.
    rows = materialize(raw.coalesce(_TASKS_A_CORE * spark.sparkContext.defaultParallelism), "landed-records")
    splits = rows.groupBy("file_path", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    return rows, splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")


_RECORD_NO = "_before + _id - _first + 1"


def numbered_records(spark: SparkSession, path: str) -> DataFrame:
    """file_path, record_no (from 1), raw_record of every line of every landed file, written once."""
    rows, splits = _landed_records(spark, path)
    return rows.join(splits, ["file_path", "_split"]).select("file_path", F.expr(_RECORD_NO).alias("record_no"), "raw_record")


def _columns_of(schema: T.StructType, sep: str) -> Column:
    """The columns of ``raw_record`` as texts, and one more."""
    raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields) + 1)])
    return F.from_csv(F.concat("raw_record", F.lit(sep + _END)), raw.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                      {"sep": sep, "mode": "PERMISSIVE", "nullValue": _EMPTY, "emptyValue": ""})


def diagnosed(records: DataFrame, schema: T.StructType, required: list[str], sep: str = ",", when: str | None = None) -> DataFrame:
    """``records`` with its columns by ``schema`` and ``_problems``: an array of (kind, column_name, reason).

    Records that were parsed before have their columns in ``_r``.
    """
    names = [f.name for f in schema.fields]
    x = records.where(F.trim("raw_record") != "")
    if "_r" not in records.columns:
        x = x.withColumn("_r", _columns_of(schema, sep))

    def problem(condition: Column, kind: str, column: str | None, reason: Column) -> Column:
        return F.when(condition, F.struct(F.lit(kind).alias("kind"), F.lit(column).cast("string").alias("column_name"), reason.alias("reason")))

    texts = {n: F.when(~F.col(f"_r.c{i}").isin(_EMPTY, _END), F.col(f"_r.c{i}")) for i, n in enumerate(names)}
    values = {f.name: texts[f.name].try_cast(f.dataType) for f in schema.fields}
    few = F.col(f"_r.c{len(names)}").isNull()
    many = F.col(f"_r.c{len(names)}") != _END
    found = [problem(few, BAD, None, F.lit("too few columns")), problem(~few & many, BAD, None, F.lit("too many columns"))]
    for f in schema.fields:
        text, value = texts[f.name], values[f.name]
        found.append(problem(text.isNotNull() & value.isNull(), BAD, f.name,
                             F.concat(F.lit("'"), text, F.lit(f"' is not a {f.dataType.simpleString()}"))))
    for n in required:
        found.append(problem(~few & texts[n].isNull(), BAD, n, F.lit("required value missing")))
    out = x.select(*records.columns, *[values[n].alias(n) for n in names], F.array_compact(F.array(*found)).alias("_problems"))
    if when is not None:
        refused = problem((F.size("_problems") == 0) & ~F.coalesce(F.expr(when), F.lit(False)), DISCARDED, None, F.lit(f"not {when}"))
        out = out.withColumn("_problems", F.array_compact(F.concat("_problems", F.array(refused))))
    return out


def reject_report(spark: SparkSession, path: str, schema: T.StructType, required: list[str], sep: str = ",",
                  when: str | None = None) -> DataFrame:
    """One row per problem: file_path, record_no, kind, column_name, reason, raw_record."""
    # Parsed as they are written: a filter on the problems, pushed below the parser, would parse a record for every rule again.
    records, splits = _landed_records(spark, path, _columns_of(schema, sep))
    rows = diagnosed(records, schema, required, sep, when)
    # Only records with a problem are given their number.
    found = rows.select("file_path", "_split", "_id", "raw_record", F.explode("_problems").alias("_p")).join(splits, ["file_path", "_split"])
    return found.select("file_path", F.expr(_RECORD_NO).alias("record_no"), "_p.kind", "_p.column_name", "_p.reason", "raw_record")
