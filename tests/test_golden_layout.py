"""Re-render the small sample's layout from synthetic payments.

Sample facts: 22 payment lines of 1024 characters, 61 invoice lines of 250, one trailer of 100;
no header; LF terminators. Payment ordinal at 41-48 left-padded with '0'; on invoice lines the
payment ordinal at 32-39 and the invoice ordinal at 40-43 are right-padded with '0' (so invoice 1
and invoice 10 both print '1000', quirk Q12). Invoices per payment: 18 x 1, 2 x 2, 1 x 4, 1 x 35
(payment 8 has 35).
"""
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from remitflow.operators import aggregate as agg
from remitflow.operators import render
from remitflow.schema import FORMAT_FIELDS, FORMATS

DETAILS = [1] * 7 + [35] + [1] * 8 + [2, 2, 4] + [1] * 3


def _layout_rows():
    f = []

    def add(part, seq, typ, start, end, const=None, dtype="STRING", mask=None, pad=None, direction=None):
        f.append((len(f) + 1, 1, f"{part}{seq}", typ, const, seq, start, end, dtype, mask, pad, direction, None, part))
    add("BODY", 1, "CONSTANT", 1, 16, "PAY0000000000001")
    add("BODY", 2, "CONSTANT", 17, 40)
    add("BODY", 3, "SEQUENCE1", 41, 48, dtype="NUMBER", mask="99999999", pad=48, direction="LEFT")
    add("BODY", 4, "CONSTANT", 49, 68)
    add("BODY", 5, "CONSTANT", 69, 71, "USD")
    add("BODY", 6, "CONSTANT", 72, 1024)
    add("DETAIL", 1, "CONSTANT", 1, 6, "VOI")
    add("DETAIL", 2, "CONSTANT", 7, 31)
    add("DETAIL", 3, "SEQUENCE1", 32, 39, dtype="NUMBER", mask="99999999", pad=48, direction="RIGHT")
    add("DETAIL", 4, "SEQUENCE2", 40, 43, dtype="NUMBER", mask="9999", pad=48, direction="RIGHT")
    add("DETAIL", 5, "CONSTANT", 44, 250)
    add("TRAILER", 1, "CONSTANT", 1, 3, "TRL")
    add("TRAILER", 2, "CONSTANT", 4, 100, None, pad=48)
    return f


def test_small_sample_layout(spark):
    formats = spark.createDataFrame([(1, "SAMPLE", "FIXED_WIDTH", None, "txt", "LF", "Y")], FORMATS)
    fields = spark.createDataFrame(_layout_rows(), FORMAT_FIELDS)
    layout = render.Layout.load(formats, fields)
    checks = [("f", 1, 1000 + i, 1000 + i, Decimal("10.00"), datetime(2014, 4, 24)) for i in range(len(DETAILS))]
    sel = spark.createDataFrame(checks, "file_id string, format_id long, check_id long, check_number long, "
                                        "amount decimal(18,2), check_date timestamp_ntz")
    paid = spark.createDataFrame(
        [("f", 1, 1000 + i, 10 * i + j, j) for i, d in enumerate(DETAILS) for j in range(1, d + 1)],
        "file_id string, format_id long, check_id long, invoice_id long, line_number long")
    requests = spark.createDataFrame([("f", 1)], "file_id string, format_id long")
    dyn = render.dynamic_values(spark.sql, layout.specs, {})
    lines = render.render_lines(spark, requests, sel, paid, agg.selection_totals(sel), layout, dyn,
                                ["line_number", "invoice_id"], hot_rows=10)
    rows = lines.orderBy("line_no").collect()
    assert [r.line_no for r in rows] == list(range(1, 85))
    kinds = [r.value[:3] for r in rows]
    assert kinds.count("PAY") == 22 and kinds.count("VOI") == 61 and kinds[-1] == "TRL" and kinds.count("TRL") == 1
    assert {len(r.value) for r in rows if r.part == "BODY"} == {1024}
    assert {len(r.value) for r in rows if r.part == "DETAIL"} == {250}
    # a NULL field value becomes one blank before padding, as in the reference
    assert len(rows[-1].value) == 100 and rows[-1].value == "TRL " + "0" * 96
    pays = [r.value for r in rows if r.part == "BODY"]
    assert [p[40:48] for p in pays] == [f"{k:08d}" for k in range(1, 23)]
    assert all(p[68:71] == "USD" for p in pays)
    vois = [r.value for r in rows if r.part == "DETAIL"]
    # payment 8 has 35 invoices: ordinal '8' right-padded; invoice 1 and 10 collide as '1000' (Q12)
    of8 = [v for v in vois if v[31:39] == "80000000"]
    assert len(of8) == 35 and of8[0][39:43] == "1000" and of8[9][39:43] == "1000"
    # every invoice ordinal of payment 8, in order, even where its run crosses partition boundaries
    assert [v[39:43] for v in of8] == [str(k).ljust(4, "0") for k in range(1, 36)]
    det_rows = [r for r in rows if r.part == "DETAIL"]
    assert [r.seq2 for r in det_rows if r.seq1 == 8] == list(range(1, 36))
    assert all(r.seq3 == r.line_no - 2 for r in det_rows) and all(r.seq3 == r.line_no - 1 for r in rows
                                                                      if r.part == "BODY")
    # each payment line is followed by its invoices
    order = [r.part for r in rows]
    assert order[:3] == ["BODY", "DETAIL", "BODY"]
    assert order[14] == "BODY" and order[15:50] == ["DETAIL"] * 35 and order[50] == "BODY"
