"""Plan guards for scale: no cross joins anywhere; filters and column pruning reach the scan."""
import __spark_entry__ as E
from conftest import SF

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _global_windows(df) -> list[str]:
    """Window operators without a partition key (every row would meet in one task)."""
    out, stack = [], [df._jdf.queryExecution().sparkPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "Window" and node.partitionSpec().isEmpty():
            out.append(node.toString()[:200])
        it = node.children().iterator()
        while it.hasNext():
            stack.append(it.next())
    return out


def test_no_cross_joins_or_global_windows_in_registered_queries(spark):
    bad = {}
    for name, q in sorted(E.queries().items()):
        df = q(spark, SF)
        p = _plan(df)
        hits = [f for f in FORBIDDEN if f in p] + (["global Window"] if _global_windows(df) else [])
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_global_window_detector(spark):
    from pyspark.sql import Window, functions as F
    df = spark.range(10)
    assert _global_windows(df.withColumn("r", F.row_number().over(Window.orderBy("id"))))
    assert not _global_windows(df.withColumn("r", F.row_number().over(Window.partitionBy(F.col("id") % 2)
                                                                     .orderBy("id"))))


def test_selection_pushes_filters_and_prunes_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    p = _plan(E.queries()["check_register"](spark, SF))
    scan = [line for line in p.split("\n") if "orders.parquet" in line][0]
    assert "GreaterThanOrEqual(o_orderdate" in scan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double," \
           "o_orderdate:timestamp_ntz,o_orderpriority:string>" in scan
    li = _plan(E.queries()["paid_invoices"](spark, SF))
    scan = [line for line in li.split("\n") if "lineitem.parquet" in line][0]
    assert "l_quantity" not in scan and "l_shipdate" not in scan
