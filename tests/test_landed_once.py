"""Landed records are parsed once."""
from pyspark.sql import types as T

from remitflow.sources import rejects


def test_landed_records_are_parsed_once(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "one.csv").write_text("1,2\n\n3,z\n4\n,5\n6,7,8\n9,1\n")
    (tmp_path / "two.csv").write_text("a,1\n")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    found = rejects.reject_report(spark, str(tmp_path), schema, ["k"], when="v >= 2")
    assert "from_csv" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r["file_path"].rsplit("/", 1)[1], r["record_no"], r["kind"], r["reason"]) for r in found.collect())
    assert got == [("one.csv", 3, "BAD", "'z' is not a double"), ("one.csv", 4, "BAD", "too few columns"), ("one.csv", 5, "BAD", "required value missing"),
                   ("one.csv", 6, "BAD", "too many columns"), ("one.csv", 7, "DISCARDED", "not v >= 2"), ("two.csv", 1, "BAD", "'a' is not a bigint")]
