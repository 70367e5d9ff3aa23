"""Field and line semantics of the renderer, including the quirk ledger rows it covers."""
from pyspark.sql import functions as F

from remitflow.operators.render import FieldSpec, field_text, line_expr


def spec(**kw):
    base = dict(definition_id=1, format_id=1, format_type="FIXED_WIDTH", delimiter=None, part="BODY", secuence=1,
                type_value="CONSTANT", constant_value=None, length=None, data_type="STRING", format_model=None,
                pad_char=" ", direction="RIGTH", needs_padding="Y", sql=None)
    base.update(kw)
    return FieldSpec(**base)


def ctx(spark):
    return spark.sql("SELECT CAST(7 AS BIGINT) AS seq1, CAST(10 AS BIGINT) AS seq2, CAST(3 AS BIGINT) AS seq3, "
                     "CAST(22 AS BIGINT) AS trx_lines, CAST(1234.5 AS DECIMAL(38,2)) AS sum_trans, "
                     "CAST(NULL AS STRING) AS dyn_1, 'a;b' AS dyn_2")


def ev(spark, col):
    return ctx(spark).select(col).first()[0]


def test_fixed_width_padding(spark):
    assert ev(spark, field_text(spec(constant_value="PAY", length=6))) == "PAY   "
    assert ev(spark, field_text(spec(type_value="SEQUENCE1", data_type="NUMBER", format_model="99999999",
                                     length=8, pad_char="0", direction="LEFT"))) == "00000007"
    # Q12: right-padding a number with zeros: 1 and 10 collide
    assert ev(spark, field_text(spec(type_value="SEQUENCE2", data_type="NUMBER", format_model="9999", length=4,
                                     pad_char="0", direction="RIGHT"))) == "1000"
    # truncation to the field length
    assert ev(spark, field_text(spec(constant_value="ABCDEFGH", length=3))) == "ABC"
    # a NULL value is padded as blanks
    assert ev(spark, field_text(spec(type_value="DINAMIC", definition_id=1, length=4))) == "    "
    # non-positive length renders nothing (DQ-04 reports it)
    assert ev(spark, field_text(spec(constant_value="X", length=0))) == ""


def test_totals_and_masks(spark):
    assert ev(spark, field_text(spec(type_value="TRX_LINES", data_type="NUMBER", format_model="000000",
                                     length=6))) == "000022"
    assert ev(spark, field_text(spec(type_value="SUM_TRANS", data_type="NUMBER", format_model="9999990.00",
                                     length=11, direction="LEFT"))) == "    1234.50"
    # NUMBER with no mask is NULL (then padded)
    assert ev(spark, field_text(spec(type_value="SEQUENCE3", data_type="NUMBER", format_model=None, length=2))) == "  "


def test_constant_with_number_type_q3(spark):
    s = spec(constant_value="00", data_type="NUMBER", length=2)
    assert ev(spark, field_text(s)) == "00"
    assert ev(spark, field_text(s, frozenset({"Q3"}))) == "  "


def test_delimited_fields_q2_and_stripping(spark):
    d = dict(format_type="DELIMITED", delimiter=";", needs_padding=None, direction=None)
    assert ev(spark, field_text(spec(type_value="DINAMIC", definition_id=2, **d))) == "ab;"
    assert ev(spark, field_text(spec(type_value="DINAMIC", definition_id=1, **d))) == ";"
    r = dict(d, needs_padding="R", direction="RIGHT", length=4, constant_value="X")
    assert ev(spark, field_text(spec(**r))) == "X   ;"
    assert ev(spark, field_text(spec(**r), frozenset({"Q2"}))) == "X;"


def test_line_drops_trailing_delimiter(spark):
    d = dict(format_type="DELIMITED", delimiter=";", needs_padding=None, direction=None)
    fields = [spec(secuence=2, constant_value="B", **d), spec(secuence=1, constant_value="A", **d),
              spec(secuence=3, type_value="DINAMIC", definition_id=1, **d)]
    assert ev(spark, line_expr(fields)) == "A;B;"


def test_legacy_number_fetch_q26(spark):
    from remitflow.operators.render import typed_text
    df = spark.createDataFrame([("-12.5",), ("1 000",), ("abc",)], "v string")
    fixed = [r[0] for r in df.select(typed_text(F.col("v"), "NUMBER", "99990.00")).collect()]
    legacy = [r[0] for r in df.select(typed_text(F.col("v"), "NUMBER", "99990.00", frozenset({"Q26"}))).collect()]
    assert legacy == ["12.50", "1000.00", None]        # sign lost, blanks removed, non-numbers NULL
    assert fixed == ["-12.50", None, None]                # Q23: unconvertible values become NULL
