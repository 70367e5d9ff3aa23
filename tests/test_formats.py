from pyspark.sql import functions as F

from remitflow.operators import formats as fm
from remitflow.operators import quality
from remitflow.schema import FORMAT_FIELDS, LEGACY_FORMAT_FIELDS, LEGACY_FORMATS
from remitflow.sources import metadata

LEGACY = [(1, "T", 200, "Bank A tab", "DELIMITED", 11, "Y"), (2, ";", 200, "Bank B semicolon", "DELIMITED", 12, "Y"),
          (3, None, None, "Bank C positions", "POSITIONS", 13, "Y")]
LEGACY_FIELDS = [
    (10, 1, "H1", "CONSTANT", "HDR\\T1\\E", 1, None, None, "STRING", None, None, None, "N", None, "HEADER"),
    (11, 1, "B1", "DINAMIC", None, 1, None, None, "STRING", None, None, "RIGHT", "Y", "SELECT 1", "TRX"),
    (12, 3, "B1", "SEQUENCE1", None, 1, 1, 8, "NUMBER", "99999999", "0", "LEFT", "Y", None, "TRX"),
    (13, 3, "B2", "CONSTANT", "\\N", 2, 9, 12, "STRING", None, "E", "RIGHT", None, None, "TRX"),
    (14, 3, "F1", "TRX_LINES", None, 1, 1, 6, "NUMBER", "000000", None, "LEFT", "N", None, "FOOTER"),
]


def test_migrate_faithful(spark):
    legacy = spark.createDataFrame(LEGACY, LEGACY_FORMATS)
    lf = spark.createDataFrame(LEGACY_FIELDS, LEGACY_FORMAT_FIELDS)
    names = spark.createDataFrame([(" bank a TAB ", "Bank A (new)")], "old_name string, new_name string")
    fmts, fields = fm.migrate_formats(legacy, lf, max_format_id=100, max_definition_id=5000, new_names=names)
    f = {r.format_id: r for r in fmts.collect()}
    assert sorted(f) == [101, 102, 103]
    assert (f[101].format_name, f[101].format_type, f[101].ascii_delimiter) == ("Bank A (new)", "DELIMITED", 9)
    assert (f[102].ascii_delimiter, f[103].ascii_delimiter, f[103].format_type) == (59, None, "FIXED_WIDTH")
    assert {r.end_of_line for r in f.values()} == {"LF"}
    d = {r.field_name + str(r.format_id): r for r in fields.collect()}
    assert sorted(r.definition_id for r in d.values()) == [5001, 5002, 5003, 5004, 5005]
    assert d["H1101"].constant_value == "HDR\\T1 "          # \T left as is (Q37)
    assert d["B1101"].part_of_file == "BODY" and d["B1101"].direction_padding == "RIGHT"
    assert d["F1103"].part_of_file == "TRAILER" and d["F1103"].direction_padding == "NONE"
    assert d["B2103"].padding_character == 32 and d["B2103"].constant_value is None
    assert d["B1103"].padding_character == 48


def test_migrate_preserving(spark):
    legacy = spark.createDataFrame(LEGACY, LEGACY_FORMATS)
    lf = spark.createDataFrame(LEGACY_FIELDS, LEGACY_FORMAT_FIELDS)
    _, fields = fm.migrate_formats(legacy, lf, 0, 0, faithful=False)
    d = {r.field_name + str(r.format_id): r for r in fields.collect()}
    assert d["H11"].constant_value == "HDR\t1 "
    assert d["F13"].direction_padding == "LEFT"            # POSITIONS keeps its direction
    assert d["F13"].padding_character == 48                # NUMBER defaults to '0'


def test_orphans_not_in_semantics(spark):
    fields = metadata.format_fields(spark)
    fmts = metadata.formats(spark)
    assert fm.orphan_fields(fields, fmts).count() == 0
    some = fmts.where(F.col("format_id") != 3)
    assert {r.format_id for r in fm.orphan_fields(fields, some).collect()} == {3}
    nullable = "format_id long, format_name string, format_type string, ascii_delimiter int, " \
               "file_extension string, end_of_line string, enable_flag string"
    with_null = some.unionByName(spark.createDataFrame([(None, "x", None, None, None, None, "Y")], nullable))
    assert fm.orphan_fields(fields, with_null).count() == 0


def test_backfill_ids(spark):
    df = spark.createDataFrame([(5, "a"), (None, "b"), (9, "c"), (None, "d")], "id long, name string")
    got = {r.name: r.id for r in fm.backfill_ids(df, "id", ["name"]).collect()}
    assert got == {"a": 5, "b": 10, "c": 9, "d": 11}


def test_layout_quality_checks(spark):
    fields = metadata.format_fields(spark)
    bad = spark.createDataFrame([(1, 9, "x", "CONSTANT", "A", 1, 5, 4, "STRING", None, None, None, None, "BODY")],
                                FORMAT_FIELDS)
    assert quality.field_lengths(bad).count() == 1
    assert quality.field_lengths(fields).count() == 0
    gaps = quality.position_gaps(fields, metadata.formats(spark))
    assert gaps.count() == 0
    # format 1's detail numbers are right-padded with zeros (Q12)
    assert quality.zero_right_padding(fields).count() == 2


def test_migrated_legacy_layout_renders(spark):
    """G1 layouts run through the G3 renderer after migration (DML-03 → RND-*)."""
    from datetime import datetime
    from decimal import Decimal
    from remitflow.operators import aggregate as agg
    from remitflow.operators import render
    legacy = spark.createDataFrame([(7, None, None, "Legacy positions", "POSITIONS", 1, "Y")], LEGACY_FORMATS)
    lf = spark.createDataFrame([
        (1, 7, "K", "CONSTANT", "AB\\TC", 1, 1, 6, "STRING", None, None, "RIGHT", "Y", None, "TRX"),
        (2, 7, "S", "SEQUENCE1", None, 2, 7, 10, "NUMBER", "9999", None, "LEFT", "Y", None, "TRX"),
        (3, 7, "T", "TRX_LINES", None, 1, 1, 5, "NUMBER", "99999", None, "LEFT", "N", None, "FOOTER"),
    ], LEGACY_FORMAT_FIELDS)
    fmts, fields = fm.migrate_formats(legacy, lf, 0, 0, faithful=False)
    layout = render.Layout.load(fmts, fields)
    sel = spark.createDataFrame([("f", 1, 10, 10, Decimal("5.00"), datetime(2014, 1, 1)),
                                 ("f", 1, 11, 11, Decimal("6.00"), datetime(2014, 1, 1))],
                                "file_id string, format_id long, check_id long, check_number long, "
                                "amount decimal(18,2), check_date timestamp_ntz")
    paid = spark.createDataFrame([], "file_id string, format_id long, check_id long, invoice_id long, check_number long")
    req = spark.createDataFrame([("f", 1)], "file_id string, format_id long")
    lines = render.render_lines(spark, req, sel, paid, agg.selection_totals(sel), layout,
                                render.dynamic_values(spark.sql, layout.specs, {}), ["invoice_id"])
    got = [r.value for r in lines.orderBy("line_no").collect()]
    # escape decoded, NUMBER padded with '0' on the left, trailer direction kept for a POSITIONS file
    assert got == ["AB\tC  0001", "AB\tC  0002", "00002"]
