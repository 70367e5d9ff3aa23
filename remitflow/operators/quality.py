"""Data-quality checks; every function returns (check_name, key, detail) rows (DQ-01..10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_broadcast
from ..sinks.files import known_terminator

OUT = ("check_name", "key", "detail")


def _rows(df: DataFrame, name: str, key, detail) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), key.cast("string").alias("key"), detail.cast("string")
                     .alias("detail"))


def request_checks(requests: DataFrame, totals: DataFrame, formats: DataFrame) -> DataFrame:
    """DQ-01 empty selection (no file is produced) and DQ-03 missing / unknown / disabled format."""
    r = requests.select("file_id", "format_id").join(totals.select("file_id", "trx_lines"), "file_id", "left") \
        .join(bounded_broadcast(formats.select("format_id", "enable_flag", "end_of_line")), "format_id", "left")
    empty = _rows(r.where(F.col("trx_lines").isNull()), "DQ-01 empty selection", F.col("file_id"),
                  F.lit("Warning : Parameters did not retrieve any data"))
    fmt = _rows(r.where(F.col("trx_lines").isNotNull() & (F.col("format_id").isNull()
                                                         | F.col("enable_flag").isNull()
                                                         | (F.col("enable_flag") != "Y"))),
                "DQ-03 format not usable", F.col("file_id"),
                F.concat(F.lit("format "), F.coalesce(F.col("format_id").cast("string"), F.lit("none"))))
    eol = _rows(r.where(F.col("trx_lines").isNotNull() & (F.col("enable_flag") == "Y") & ~known_terminator()),
                "DQ-03 format not usable", F.col("file_id"),
                F.concat(F.lit("line terminator "), F.col("end_of_line")))
    return empty.unionByName(fmt).unionByName(eol)


def usable_formats(formats: DataFrame) -> DataFrame:
    """``formats`` with those of an unknown line terminator disabled: they render no line."""
    return formats.withColumn("enable_flag", F.when(known_terminator(), F.col("enable_flag")).otherwise(F.lit("N")))


def required_parameters(requests: DataFrame, required=("payment_document_id", "start_ts", "end_ts")) -> DataFrame:
    """DQ-02: mandatory request parameters present."""
    out = None
    for c in required:
        d = _rows(requests.where(F.col(c).isNull()), "DQ-02 missing parameter", F.col("file_id"), F.lit(c))
        out = d if out is None else out.unionByName(d)
    return out


def field_lengths(fields: DataFrame) -> DataFrame:
    """DQ-04: non-positive fixed-width field length (END - START + 1 < 1)."""
    f = fields.where((F.col("end_position") - F.col("start_position") + 1) < 1)
    return _rows(f, "DQ-04 non-positive length", F.col("definition_id"),
                 (F.col("end_position") - F.col("start_position") + 1))


def position_gaps(fields: DataFrame, formats: DataFrame) -> DataFrame:
    """Q32: fixed-width fields must tile 1..N in SECUENCE order (no gap, no overlap)."""
    from pyspark.sql import Window
    fw = fields.join(formats.where(F.col("format_type") == "FIXED_WIDTH").select("format_id"), "format_id")
    w = Window.partitionBy("format_id", "part_of_file").orderBy("secuence")
    prev_end = F.lag("end_position").over(w)
    g = fw.select("definition_id", "start_position", F.coalesce(prev_end, F.lit(0)).alias("_pe"))
    return _rows(g.where(F.col("start_position") != F.col("_pe") + 1), "Q32 gap or overlap", F.col("definition_id"),
                 F.concat(F.lit("starts at "), F.col("start_position").cast("string"), F.lit(", previous ends at "),
                          F.col("_pe").cast("string")))


def amount_domain(checks: DataFrame, width: int = 12, scale: int = 2) -> DataFrame:
    """DQ-06: money domain (12 digits, 2 decimals, positive)."""
    bad = (F.col("amount") <= 0) | (F.abs(F.col("amount")) >= F.lit(10 ** (width - scale))) \
        | (F.col("amount") != F.round(F.col("amount"), scale))
    return _rows(checks.where(bad), "DQ-06 amount outside domain", F.col("check_id"), F.col("amount"))


def required_columns(df: DataFrame, columns: list[str], key: str = "check_id") -> DataFrame:
    """DQ-07: NULL in a required column, one row per offending (row, column)."""
    out = None
    for c in columns:
        d = _rows(df.where(F.col(c).isNull()), "DQ-07 required value missing", F.col(key), F.lit(c))
        out = d if out is None else out.unionByName(d)
    return out


def dynamic_values_missing(missing: DataFrame, specs) -> DataFrame:
    """DQ-10: a dynamic field without a value (no row, or one that does not convert), with the payment or
    invoice it is missing for, its definition and its query (``missing``: ``render.missing_values``)."""
    spark = missing.sparkSession
    sql = spark.createDataFrame([(s.definition_id, s.sql) for s in specs if s.sql] or [], "definition_id long, sql string")
    key = F.concat_ws("/", "file_id", F.col("check_id").cast("string"), F.col("invoice_id").cast("string"))
    return _rows(missing.join(bounded_broadcast(sql), "definition_id", "left"), "DQ-10 dynamic value missing", key,
                 F.concat(F.lit("definition "), F.col("definition_id").cast("string"), F.lit(": "), F.coalesce("sql", F.lit("no query"))))


def missing_by_file(missing: DataFrame) -> DataFrame:
    """DQ-10 for the run outcome: one row per file and field, with the number of payments or invoices."""
    n = missing.groupBy("file_id", "definition_id").agg(F.count(F.lit(1)).alias("n"))
    return _rows(n, "DQ-10 dynamic value missing", F.col("file_id"),
                 F.concat(F.lit("definition "), F.col("definition_id").cast("string"), F.lit(": "), F.col("n").cast("string"), F.lit(" lines")))


def unconverted_fields(requests: DataFrame, specs, failed: dict) -> DataFrame:
    """Fields whose query could not be run, for every file of their format."""
    spark = requests.sparkSession
    rows = [(s.format_id, s.definition_id, failed[s.definition_id]) for s in specs if s.definition_id in failed]
    bad = bounded_broadcast(spark.createDataFrame(rows or [], "format_id long, definition_id long, why string"))
    return _rows(requests.join(bad, "format_id"), "DQ-12 query not runnable", F.col("file_id"),
                 F.concat(F.lit("definition "), F.col("definition_id").cast("string"), F.lit(": "), F.col("why")))


def zero_right_padding(fields: DataFrame) -> DataFrame:
    """Q12: right-padding a number with '0' makes 1 and 10 print alike."""
    f = fields.where((F.col("data_type") == "NUMBER") & (F.col("padding_character") == 48)
                     & F.col("direction_padding").isin("RIGHT", "RIGTH"))
    return _rows(f, "Q12 number right-padded with zeros", F.col("definition_id"), F.col("field_name"))
