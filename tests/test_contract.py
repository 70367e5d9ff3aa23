"""Driver contract: entry runs, every query has an oracle, a fast subset matches DuckDB at sf0.001."""
import __spark_entry__ as E
from compare import compare
from conftest import SF


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["file_id", "part", "line_no", "value"]


def test_every_query_has_an_oracle():
    from remitflow.plans.queries import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_oracle_sf0001(spark):
    names = ["check_register", "selection_totals", "report_lines", "invoice_list", "fixed_width_lines",
             "delimited_lines", "register_text", "unsent_after_final", "dq_requests", "flex_project"]
    res = compare(spark, SF, names, verbose=True)
    assert all(v[0] == "OK" for v in res.values()), res
