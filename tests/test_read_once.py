"""Values are fetched once: what a report needs comes with the lines."""
from pyspark.sql import functions as F

from remitflow.operators import aggregate as agg
from remitflow.operators import render


def _spec(i: int, part: str, fmt: int = 1) -> render.FieldSpec:
    return render.FieldSpec(i, fmt, "FIXED_WIDTH", None, part, i, "DINAMIC", None, 5, "STRING", None, " ", "RIGTH", "Y", "q")


def test_lines_name_the_fields_they_lack(spark):
    selection = spark.createDataFrame([("a", 1, 1, 1, 5), ("a", 1, 2, 2, 5), ("b", 2, 3, 3, 5), ("b", 2, 3, 3, 5)],
                                      "file_id string, format_id long, check_id long, check_number long, amount long")
    requests = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "file_id string, format_id long")
    paid = spark.createDataFrame([("a", 1, 1, 1, 10), ("a", 1, 2, 2, 11), ("b", 2, 3, 3, None)],
                                 "file_id string, format_id long, check_id long, check_number long, invoice_id long")
    specs = [_spec(1, "BODY"), _spec(2, "BODY"), _spec(3, "DETAIL"), _spec(4, "TRAILER"), _spec(5, "BODY", 2), _spec(6, "HEADER", 2)]
    layout = render.Layout(specs, {1: {"BODY", "DETAIL", "TRAILER"}, 2: {"BODY", "HEADER"}})
    frames = {("check_id",): spark.createDataFrame([(1, "x", None, None), (2, None, "y", None)], "check_id long, dyn_1 string, dyn_2 string, dyn_5 string"),
              ("invoice_id",): spark.createDataFrame([(10, "i")], "invoice_id long, dyn_3 string")}
    dyn, totals = render.DynamicValues(frames, {6: "h"}, {4: "not runnable"}), agg.selection_totals(selection)
    lines = render.render_lines(spark, requests, selection, paid, totals, layout, dyn, ["invoice_id"])
    got = sorted(map(tuple, lines.select("file_id", "part", F.explode("missing")).collect()))
    reported = render.missing_values(requests, selection, paid, layout, dyn).select("file_id", "part", "definition_id")
    assert got == sorted(map(tuple, reported.collect()))
    assert got == [("a", "BODY", 1), ("a", "BODY", 2), ("a", "DETAIL", 3), ("a", "TRAILER", 4), ("b", "BODY", 5), ("b", "BODY", 5)]
