"""Queries that compute with a line's counter look their rows up by key."""
from remitflow.operators import render

LINES = "file_id string, line_no long, seq3 long, format_id long, part string, check_id long, invoice_id long, trx_lines long, sum_trans decimal(10,2)"


def test_counter_in_a_value_joins_by_key(spark):
    frames = dict(
        selection=spark.createDataFrame([("a", 1, 7), ("a", 2, 7)], "file_id string, check_id long, checkrun_id long"),
        requests=spark.createDataFrame([("a", 1)], "file_id string, payment_document_id long"),
        totals=spark.createDataFrame([("a", 2, 10)], "file_id string, trx_lines long, sum_trans long"),
        paid=spark.createDataFrame([("a", 1, 10, 1), ("a", 1, 10, 2), ("a", 1, 11, 3), ("a", 2, None, 1)], "file_id string, check_id long, invoice_id long, line_number int"),
        lines=spark.createDataFrame([("a", 1, 1, 3, "BODY", 1, None, 2, None), ("a", 2, 2, 3, "DETAIL", 1, 10, 2, None), ("a", 3, 3, 3, "DETAIL", 1, 10, 2, None),
                                     ("a", 4, 4, 3, "DETAIL", 1, 11, 2, None), ("a", 5, None, 3, "DETAIL", 2, None, 2, None)], LINES))
    sql = ("SELECT p.line_number + 10 * :V_SEQUENCE3 AS value, p.line_number AS ord FROM paid p "
           "WHERE p.check_id = :IDCHECK AND p.invoice_id = :INVOICEID")
    with render.query_views(spark, **frames) as query:
        found = render.run_keyed_query(query, sql, {}, {(3, "DETAIL")})
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert sorted(map(tuple, found.collect())) == [("a", 2, 21, 1), ("a", 2, 22, 2), ("a", 3, 31, 1), ("a", 3, 32, 2), ("a", 4, 43, 3)]
