from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from remitflow.operators import flexfield, quality
from remitflow.operators.render import choose_alternative, run_keyed_query


def test_alternate_query_by_mode(spark):
    sql = "SELECT 1 AS value /*SQLS_ALT*/ SELECT 2 AS value"
    assert choose_alternative(sql, True) == "SELECT 1 AS value"
    assert choose_alternative(sql, False) == "SELECT 2 AS value"
    assert run_keyed_query(spark.sql, sql, {"CHECKRUN_ID": 7}).first()[0] == 1
    assert run_keyed_query(spark.sql, sql, {"CHECKRUN_ID": None}).first()[0] == 2


def test_named_binds(spark):
    q = run_keyed_query(spark.sql, "SELECT CAST(:P_START_DATE AS TIMESTAMP_NTZ) AS value, :P_DOC_FIN AS d",
                        {"P_START_DATE": datetime(2014, 4, 25), "P_DOC_FIN": 3})
    r = q.first()
    assert r.value == datetime(2014, 4, 25) and r.d == 3


def test_unset_parameters_make_their_predicate_a_no_op():
    from remitflow.operators.render import without_unset
    binds = {"LO": None, "HI": 9, "X": None}
    assert without_unset("a.n >= :LO AND n <= :HI AND m = :X AND k <> :X", binds) == "a.n >= a.n AND n <= :HI AND m = m AND k = k"
    assert without_unset("n between :LO and :HI AND d BETWEEN 1 AND 2", binds) == "n BETWEEN n AND :HI AND d BETWEEN 1 AND 2"
    assert without_unset("x > :LO", binds) == "x = x"


def test_sql_default_and_listings(spark):
    seg = spark.createDataFrame(
        [("HQ", "ATTRIBUTE11", "FIRST READER", 10, "READERS", "S",
          "SELECT name FROM VALUES ('ZED'), ('AMY') AS t(name) ORDER BY name"),
         ("HQ", "ATTRIBUTE12", "SECOND READER", 20, None, "S", "SELECT name FROM VALUES ('x') AS t(name) WHERE 1 = 0")],
        "context_code string, application_column_name string, end_user_column_name string, column_seq_num int, "
        "value_set_name string, default_type string, default_value string")
    rows = spark.createDataFrame([(1, "HQ", None, None), (2, "HQ", "BOB", "C")],
                                 "check_id long, attribute_category string, attribute11 string, attribute12 string")
    out = {r.check_id: (r.first_reader, r.second_reader) for r in flexfield.project_context(rows, seg, ["check_id"]).collect()}
    assert out == {1: ("AMY", None), 2: ("BOB", "C")}
    assert [r.context_code for r in flexfield.segment_listing(seg, "HQ").collect()] == ["HQ", "HQ"]
    assert [r.application_column_name for r in flexfield.locate_column(seg, "SECOND READER").collect()] == ["ATTRIBUTE12"]
    ctxs = spark.createDataFrame([("AP_CHECKS", "ZZ", "N"), ("AP_CHECKS", "Global Data Elements", "Y"),
                                  ("AP_CHECKS", "AA", "N"), ("OTHER", "BB", "N")],
                                 "flexfield_name string, context_code string, global_flag string")
    assert [r.context_code for r in flexfield.context_listing(ctxs, "AP_%").collect()] == \
        ["Global Data Elements", "AA", "ZZ"]


def test_parameter_and_amount_checks(spark):
    req = spark.createDataFrame([("f1", 1, datetime(2014, 1, 1), None), ("f2", None, None, datetime(2014, 2, 1))],
                                "file_id string, payment_document_id long, start_ts timestamp_ntz, end_ts timestamp_ntz")
    got = sorted((r.key, r.detail) for r in quality.required_parameters(req).collect())
    assert got == [("f1", "end_ts"), ("f2", "payment_document_id"), ("f2", "start_ts")]
    checks = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("-1.00")), (3, Decimal("12345678901.00"))],
                                   "check_id long, amount decimal(18,2)")
    assert sorted(r.key for r in quality.amount_domain(checks).collect()) == ["2", "3"]
    assert sorted(r.detail for r in quality.required_columns(
        spark.createDataFrame([(1, None), (2, "x")], "check_id long, v string"), ["v"]).collect()) == ["v"]


def test_a_query_that_cannot_run_is_listed(spark):
    from remitflow.operators.render import FieldSpec, dynamic_values
    def spec(i, sql):
        return FieldSpec(i, 1, "FIXED_WIDTH", None, "BODY", i, "DINAMIC", None, 5, "STRING", None, " ", "RIGTH", "Y", sql)
    dyn = dynamic_values(spark.sql, [spec(1, "SELECT x FROM no_such_table"), spec(2, "SELECT :NOBODY_KNOWS AS value"), spec(3, "SELECT 1 AS value")], {})
    assert set(dyn.failed) == {1, 2} and "NOBODY_KNOWS" in dyn.failed[2] and dyn.scalars == {3: "1"}
    req = spark.createDataFrame([("f", 1), ("g", 2)], "file_id string, format_id long")
    rows = quality.unconverted_fields(req, [spec(1, "q"), spec(2, "q"), spec(3, "q")], dyn.failed).collect()
    assert {(r.key, r.check_name) for r in rows} == {("f", "DQ-12 query not runnable")} and len(rows) == 2


def test_first_row_and_yes_no(spark):
    from remitflow.functions.text import yes_no
    from remitflow.operators.render import first_per_key
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "e")], "k long, ord long, value string")
    assert sorted((r.k, r.value) for r in first_per_key(df, ("k",)).collect()) == [(1, "a"), (2, "e")]
    b = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in b.select(yes_no(F.col("b"))).collect()] == ["Y", "N", "N"]



def test_keyed_query_first_row_uses_ord_in_its_type(spark):
    from remitflow.operators.render import FieldSpec, dynamic_values
    spark.createDataFrame([(1, "late", 10), (1, "early", 9), (2, "only", 1)],
                          "check_id long, v string, o long").createOrReplaceTempView("kq_src")
    spec = FieldSpec(7, 1, "FIXED_WIDTH", None, "BODY", 1, "DINAMIC", None, 5, "STRING", None, " ", "RIGTH", "Y",
                     "SELECT check_id, v AS value, o AS ord FROM kq_src")
    dyn = dynamic_values(spark.sql, [spec], {})
    got = {r.check_id: r.dyn_7 for r in dyn.frames[("check_id",)].collect()}
    assert got == {1: "early", 2: "only"}


def test_payment_checks_cover_every_method_and_request(spark):
    from conftest import SF
    from remitflow.plans.context import Ctx
    from remitflow.plans.queries import dq_payments
    ctx = Ctx(spark, SF)
    want = {("DQ-02 missing parameter", f"{ctx.params.run_id}-{r.payment_document_id}", "end_ts") for r in ctx.docs.collect()}
    for r in ctx.checks.collect():
        if r.amount <= 0 or r.amount >= 100000:
            want.add(("DQ-06 amount outside domain", str(r.check_id), str(r.amount)))
        want |= {("DQ-07 required value missing", str(r.check_id), c) for c in ("attribute2", "attribute14") if r[c] is None}
    got = [tuple(r) for r in dq_payments(spark, SF).collect()]
    assert len(got) == len(want) and set(got) == want
