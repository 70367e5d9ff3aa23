"""Layout-table maintenance: legacy migration, surrogate ids, orphan removal (DML-03..06, PRJ-03/04, JN-15).

All legacy formats migrate in one DataFrame job (the reference looped one
format per call).  New ids come from ``sequence_within`` on a constant group,
which stays a single small window for configuration-sized tables and switches
to the distributed path beyond ``hot_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bounded_broadcast
from ..functions.text import ESCAPES, decode_escapes, letter_code
from ..schema import LEGACY_PART_NAMES
from .sequences import sequence_within

# The migration decodes only these escapes in constants (\T is left as is).
MIGRATION_ESCAPES = (("\\E", " "), ("\\N", ""))


def assign_ids(df: DataFrame, order: list[str], out: str, start_after: int) -> DataFrame:
    """DML-05: ``start_after + 1, + 2, …`` in ``order``."""
    g = df.withColumn("_g", F.lit(0))
    return sequence_within(g, ["_g"], order, "_rn").withColumn(out, (F.col("_rn") + start_after).cast("bigint")) \
        .drop("_g", "_rn")


def migrate_header(legacy: DataFrame) -> DataFrame:
    """PRJ-03: legacy master row → format row (ids assigned later)."""
    return legacy.select(
        F.col("id_master"),
        F.col("format_name"),
        F.when(F.col("type_text_file") == "DELIMITED", F.lit("DELIMITED"))
        .when(F.col("type_text_file") == "POSITIONS", F.lit("FIXED_WIDTH")).alias("format_type"),
        F.ascii(F.when(F.col("delimiter") == "T", F.lit("\t")).otherwise(F.col("delimiter"))).alias("ascii_delimiter"),
        F.lit(None).cast("string").alias("file_extension"),
        F.lit("LF").alias("end_of_line"),
        F.col("enable").alias("enable_flag"),
    ).withColumn("ascii_delimiter", F.when(F.col("ascii_delimiter") == 0, F.lit(None)).otherwise(F.col("ascii_delimiter")))


def _part(col: Column) -> Column:
    out = col
    for old, new in LEGACY_PART_NAMES.items():
        out = F.when(col == old, F.lit(new)).otherwise(out)
    return out


def migrate_fields(legacy_fields: DataFrame, legacy: DataFrame, faithful: bool = True) -> DataFrame:
    """PRJ-04: legacy detail row → field row.

    ``faithful=True`` repeats the reference's mapping exactly (quirk Q37: ``\\T``
    and letter codes for tab are not decoded, non-'Y' needs-padding becomes
    NONE).  ``faithful=False`` preserves what the legacy renderer printed:
    every escape and letter code decoded, NUMBER fields default-padded with
    '0', and POSITIONS fields keep their direction.
    """
    f = legacy_fields.join(legacy.select("id_master", "type_text_file"), "id_master", "left")
    needs = F.coalesce(F.col("needs_padding"), F.lit("N"))
    if faithful:
        const = decode_escapes(F.col("constant_value"), MIGRATION_ESCAPES)
        pad = F.ascii(F.replace(F.col("padding_character"), F.lit("E"), F.lit(" ")))
        direction = F.when(needs == "Y", F.col("direction_padding")).when(needs == "N", F.lit("NONE"))
    else:
        const = decode_escapes(F.col("constant_value"), ESCAPES)
        pad = F.ascii(F.coalesce(letter_code(F.col("padding_character")),
                                 F.when(F.col("data_type") == "NUMBER", F.lit("0"))))
        direction = F.when((needs == "Y") | (F.col("type_text_file") == "POSITIONS"), F.col("direction_padding")) \
            .otherwise(F.lit("NONE"))
    pad = F.when(pad == 0, F.lit(None)).otherwise(pad)
    return f.select(
        F.col("id_file_format"), F.col("id_master"), "field_name", "type_value",
        F.when(const == "", F.lit(None)).otherwise(const).alias("constant_value"),
        "secuence", "start_position", "end_position", "data_type", F.col("format").alias("format_model"),
        pad.alias("padding_character"), direction.alias("direction_padding"),
        F.col("sql_statement"), _part(F.col("part_of_file")).alias("part_of_file"),
    )


def migrate_formats(legacy: DataFrame, legacy_fields: DataFrame, max_format_id: int, max_definition_id: int,
                    new_names: DataFrame | None = None, faithful: bool = True):
    """DML-03: every legacy format (optionally renamed through ``new_names(old_name, new_name)``,
    matched on ``UPPER(TRIM(name))``) → (formats, format_fields) with fresh ids."""
    h = migrate_header(legacy)
    if new_names is not None:
        nn = new_names.select(F.upper(F.trim("old_name")).alias("_k"), "new_name")
        h = h.join(bounded_broadcast(nn), F.upper(F.trim(F.col("format_name"))) == F.col("_k"), "left") \
            .withColumn("format_name", F.coalesce(F.col("new_name"), F.col("format_name"))).drop("_k", "new_name")
    h = assign_ids(h, ["id_master"], "format_id", max_format_id)
    fields = migrate_fields(legacy_fields, legacy, faithful)
    fields = fields.join(h.select("id_master", "format_id"), "id_master")
    fields = assign_ids(fields, ["format_id", "secuence", "id_file_format"], "definition_id", max_definition_id)
    return h.drop("id_master"), fields.drop("id_master", "id_file_format")


def orphan_fields(fields: DataFrame, formats: DataFrame) -> DataFrame:
    """JN-15 / DML-04: fields whose format is gone, with ``NOT IN`` semantics
    (a NULL format id among the formats means no field is an orphan)."""
    has_null = formats.where(F.col("format_id").isNull()).limit(1).count() > 0
    if has_null:
        return fields.limit(0)
    return fields.join(formats.select("format_id"), "format_id", "left_anti").where(F.col("format_id").isNotNull())


def backfill_ids(df: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """DML-06: give rows with a NULL id new ids above the current maximum; keep the others."""
    top = df.agg(F.max(id_col)).first()[0] or 0
    missing = assign_ids(df.where(F.col(id_col).isNull()).drop(id_col), order, id_col, int(top))
    return df.where(F.col(id_col).isNotNull()).unionByName(missing.select(*df.columns))


def only_format(df: DataFrame, id_col: str, value: int | None) -> DataFrame:
    """FLT-19: ``id = NVL(:value, id)``: one format, or all of them when none is named; NULL ids never pass."""
    return df.where(F.col(id_col) == F.coalesce(F.lit(value).cast("bigint"), F.col(id_col)))


def without_named(formats: DataFrame, fields: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """DML-04: the layout tables without the formats of a name (``UPPER(TRIM(name))``) and without their fields."""
    key = F.upper(F.trim(F.col("format_name")))
    left = formats.where(F.coalesce(key != F.upper(F.trim(F.lit(name))), F.lit(True)))
    return left, without_orphans(fields, left)


def without_orphans(fields: DataFrame, formats: DataFrame) -> DataFrame:
    """DML-04: the fields that stay when orphans are deleted (``orphan_fields``)."""
    gone = orphan_fields(fields, formats).select("format_id").distinct()
    return fields.join(gone, "format_id", "left_anti").select(*fields.columns)
