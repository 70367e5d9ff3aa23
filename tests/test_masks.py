from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from remitflow.functions.masks import date_elements, money, to_char_date, to_char_number
from remitflow.functions.text import cat, decode_escapes, latin1, letter_code, number_text


@pytest.mark.parametrize("mask,value,expected", [
    ("999,999,999.99", Decimal("1013.70"), "       1,013.70"),
    ("999,999,999.99", Decimal("-1013.70"), "      -1,013.70"),
    ("9.99", Decimal("0.50"), "  .50"),
    ("990.99", Decimal("0.50"), "   0.50"),
    ("000", Decimal("5"), " 005"),
    ("000", Decimal("-5"), "-005"),
    ("99", Decimal("123"), "###"),
    ("999", Decimal("0"), "   0"),
    ("FM999.00", Decimal("5"), "5.00"),
    ("9999", Decimal("2.5"), "    3"),
    ("9999", Decimal("-2.5"), "   -3"),
    ("99999999", Decimal("42"), "       42"),
    ("999,999,999.99", Decimal("1000000000"), "###############"),
    ("S999", Decimal("42"), " +42"),
    ("S999", Decimal("-42"), " -42"),
    ("999S", Decimal("-42"), " 42-"),
    ("999MI", Decimal("-42"), " 42-"),
    ("999MI", Decimal("42"), " 42 "),
    ("999PR", Decimal("-42"), " <42>"),
    ("999PR", Decimal("42"), "  42 "),
    ("$9,999.00", Decimal("12.5"), "    $12.50"),
    ("FM$999.00", Decimal("-12.5"), "-$12.50"),
    ("999X", Decimal("1"), None),
    ("EEEE", Decimal("1"), None),
])
def test_number_mask(spark, mask, value, expected):
    df = spark.createDataFrame([(value,)], "x decimal(18,2)")
    assert df.select(to_char_number(F.col("x"), mask)).first()[0] == expected


def test_number_mask_null(spark):
    df = spark.createDataFrame([(Decimal("1"),), (None,)], "x decimal(18,2)")
    assert [r[0] for r in df.select(to_char_number(F.col("x"), None)).collect()] == [None, None]
    assert df.select(to_char_number(F.col("x"), "999")).collect()[1][0] is None
    assert df.select(money(F.col("x"))).first()[0] == "           1.00"


def test_date_masks(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2014-04-25 09:09:17' AS t")
    got = df.select(to_char_date(F.col("t"), "YYYY-MON-DD_HHAM-MI-SS"), to_char_date(F.col("t"), "DD/MM/YYYY"),
                    to_char_date(F.col("t"), "DD-MON-YYYY HH24:MI:SS"), to_char_date(F.col("t"), None)).first()
    assert tuple(got) == ("2014-APR-25_09AM-09-17", "25/04/2014", "25-APR-2014 09:09:17", None)


@pytest.mark.parametrize("mask,expected", [
    ("RRRR", "2014"), ("DDD", "115"), ("Q", "2"), ("MONTH", "APRIL    "), ("Month", "April    "), ("Mon", "Apr"), ("mon", "apr"),
    ("DY", "FRI"), ("Day", "Friday   "), ("D", "6"), ("IW", "17"), ("WW", "17"), ('DD" of "MM', "25 of 04"), ("YYYY\"T\"HH24", "2014T09"),
    ("hh:mi am", "09:09 am"), ("YYYYZZ", None), ("FOO", None),
])
def test_date_mask_elements(spark, mask, expected):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2014-04-25 09:09:17' AS t")
    assert df.select(to_char_date(F.col("t"), mask)).first()[0] == expected
    assert (date_elements(mask) is None) == (expected is None)


def test_text_helpers(spark):
    df = spark.createDataFrame([("a\\Tb\\Ec\\N", "T", Decimal("1013.70"), "x€é")], "s string, c string, n decimal(18,2), u string")
    r = df.select(decode_escapes(F.col("s")), letter_code(F.col("c")), number_text(F.col("n")), latin1(F.col("u")),
                  cat(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))).first()
    assert tuple(r) == ("a\tb c", "\t", "1013.7", "x¿é", "ab")
    df2 = spark.createDataFrame([(Decimal("1000.00"),), (Decimal("12.05"),)], "n decimal(18,2)")
    assert [r[0] for r in df2.select(number_text(F.col("n"))).collect()] == ["1000", "12.05"]
