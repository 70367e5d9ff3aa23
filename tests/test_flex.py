from decimal import Decimal

from remitflow.operators import flexfield
from remitflow.sources import metadata


def _checks(spark):
    rows = [(1, "STANDARD", "B1", None, None, "7", "PRINTED"), (2, "COURIER", None, "Y", "DAWN", "12.5", "W7"),
            (3, "COURIER", None, None, None, None, None), (4, "OTHER", "B1", "x", "y", "z", "w"), (5, None, "B1", None, None, None, None)]
    return spark.createDataFrame(rows, "check_id long, attribute_category string, attribute2 string, attribute3 string, "
                                       "attribute5 string, attribute8 string, attribute14 string")


def test_project_context_with_defaults(spark):
    out = flexfield.project_context(_checks(spark), metadata.flex_segments(spark), ["check_id"])
    r = {x.check_id: x for x in out.collect()}
    # Q35: column 14 is the send status only in STANDARD; a waybill elsewhere
    assert r[1].send_mark == "PRINTED" and r[1].waybill is None
    assert r[2].waybill == "W7" and r[2].send_mark is None
    assert (r[3].delivery_window, r[3].parcel_grams, r[3].doorstep) == ("ANYTIME", None, None)
    assert r[1].delivery_window is None and r[4].waybill is None and r[5].ledger_branch is None


def test_both_forms_are_equal(spark):
    from conftest import SF
    from remitflow.plans.context import Ctx
    segments = metadata.flex_segments(spark).unionByName(spark.createDataFrame(
        [("COURIER", "ATTRIBUTE3", "delivery-window", 9, None, None, None, "N"), ("STANDARD", "ATTRIBUTE99", "Absent", 9, None, "C", "A", "N"),
         ("STANDARD", "ATTRIBUTE3", "Asked", 10, None, "S", "SELECT w FROM VALUES ('b'), ('a') AS t(w) ORDER BY w", "N")],
        metadata.FLEX_SEGMENT_SCHEMA))
    for checks in (_checks(spark), Ctx(spark, SF).checks):
        for defaults in (True, False):
            one, two = (flexfield.project_context(checks, segments, ["check_id"], apply_default=defaults, form=f) for f in ("compiled", "relational"))
            assert one.columns == two.columns
            assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_more_segments_than_are_compiled(spark):
    n = flexfield.COMPILE_SEGMENTS * 12
    segments = spark.range(n).selectExpr(
        "concat('C', id) AS context_code", "concat('ATTRIBUTE', 1 + id % 3) AS application_column_name", "concat('Name ', id % 4) AS end_user_column_name",
        "1 AS column_seq_num", "CAST(NULL AS STRING) AS value_set_name", "'C' AS default_type", "concat('d', id) AS default_value", "'N' AS required_flag")
    rows = spark.range(n).selectExpr("id AS check_id", "concat('C', id) AS attribute_category", "IF(id % 2 = 0, 'a', NULL) AS attribute1",
                                     "'b' AS attribute2", "CAST(NULL AS STRING) AS attribute3")
    out = flexfield.project_context(rows, segments, ["check_id"])
    assert out.columns == ["check_id", "name_0", "name_1", "name_2", "name_3"] and out.count() == n
    got = {r.check_id: r for r in out.where("check_id IN (4, 5, 6, 11)").collect()}
    want = {4: ("name_0", "b"), 5: ("name_1", "d5"), 6: ("name_2", "a"), 11: ("name_3", "d11")}
    assert all(got[i][name] == v for i, (name, v) in want.items())
    assert flexfield.unpivot(rows, segments).count() == sum(i % 3 == 1 or (i % 3 == 0 and i % 2 == 0) for i in range(n))


def test_unpivot_and_domain(spark):
    c = _checks(spark)
    long = flexfield.unpivot(c, metadata.flex_segments(spark))
    assert {(r.check_id, r.segment, r.value) for r in long.collect()} == {
        (1, "Ledger Branch", "B1"), (1, "Value Days", "7"), (1, "Send Mark", "PRINTED"), (2, "Waybill", "W7"), (2, "Parcel Grams", "12.5"),
        (2, "Doorstep", "Y"), (2, "Delivery Window", "DAWN")}
    bad = {(r.key, r.detail) for r in flexfield.domain_violations(c, metadata.flex_segments(spark),
                                                                   metadata.flex_domains(spark)).collect()}
    # Q36: the default 'ANYTIME' is outside its own set
    assert bad == {("2", "Delivery Window=DAWN"), ("3", "Delivery Window=ANYTIME")}


def test_segment_rules_equal_plain_python(spark):
    from conftest import SF
    from remitflow.plans.context import Ctx
    from remitflow.plans.queries import dq_segment_rules
    rules = {name: rest for name, *rest in metadata.FLEX_RULES}
    want = []
    for r in Ctx(spark, SF).checks.collect():
        for context, column, name, _, values, kind, default, required in metadata.FLEX_SEGMENTS:
            if r.attribute_category != context:
                continue
            v = getattr(r, column.lower())
            v = default if v is None and kind == "C" else v
            if v is None:
                want += [("DQ-07 required value missing", str(r.check_id), name)] if required == "Y" else []
                continue
            kind, least, most, decimals, size = rules.get(values, [None] * 5)
            found = []
            if kind == "LIST" and v not in metadata.FLEX_DOMAINS[values]:
                found.append("DQ-05 value outside value set")
            if kind == "NUMBER":
                try:
                    x = Decimal(v)
                except ArithmeticError:
                    found.append("DQ-06 not a number")
                else:
                    found += ["DQ-06 below minimum"] if x < Decimal(least) else []
                    found += ["DQ-06 above maximum"] if x > Decimal(most) else []
                    found += ["DQ-06 too many decimals"] if x != round(x, decimals) else []
            found += ["DQ-06 too long"] if size is not None and len(v) > size else []
            want += [(f, str(r.check_id), f"{name}={v}") for f in found]
    got = dq_segment_rules(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {w[0] for w in want} >= {"DQ-05 value outside value set", "DQ-06 not a number", "DQ-06 below minimum", "DQ-06 above maximum",
                                    "DQ-06 too many decimals", "DQ-06 too long", "DQ-07 required value missing"}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("] parquet") == 1


def test_rules_without_bounds_and_unknown_sets(spark):
    c = spark.createDataFrame([(1, "A", "abc", "1e3"), (2, "A", None, "-7.25")], "check_id long, attribute_category string, attribute1 string, attribute2 string")
    segments = spark.createDataFrame([("A", "ATTRIBUTE1", "Free", 1, "NOWHERE", None, None, "N"), ("A", "ATTRIBUTE2", "Any", 2, "OPEN", None, None, "Y")],
                                     metadata.FLEX_SEGMENT_SCHEMA)
    rules = spark.createDataFrame([("OPEN", "NUMBER", None, None, None, None), ("TWICE", "LIST", None, None, None, None)], metadata.flex_rules(spark).schema)
    assert flexfield.segment_rules(c, segments, rules, metadata.flex_domains(spark)).collect() == []
    strict = spark.createDataFrame([("OPEN", "NUMBER", "0", None, 1, None)], rules.schema)
    got = {(r.check_name, r.detail) for r in flexfield.segment_rules(c, segments, strict, metadata.flex_domains(spark).limit(0)).collect()}
    assert got == {("DQ-06 below minimum", "Any=-7.25"), ("DQ-06 too many decimals", "Any=-7.25")}


def test_status_resolved_through_metadata_q35(spark):
    from conftest import SF
    from remitflow.operators import selection as sel_ops
    from remitflow.plans.context import Ctx
    ctx = Ctx(spark, SF)
    checks = flexfield.with_resolved_column(ctx.checks, metadata.flex_segments(spark), "Send Mark", "send_status_col")
    p = ctx.params.with_(only_unsent="Y")
    _, faithful = sel_ops.run_selection(spark, ctx.checks, ctx.sites, ctx.values, ctx.docs, p)
    _, fixed = sel_ops.run_selection(spark, checks, ctx.sites, ctx.values, ctx.docs, p, status_col="send_status_col")
    # STANDARD documents are unchanged; COURIER (document 5) no longer reads column 14 as a status
    f = {r.payment_document_id: r.n for r in faithful.groupBy("payment_document_id").count().withColumnRenamed("count", "n").collect()}
    g = {r.payment_document_id: r.n for r in fixed.groupBy("payment_document_id").count().withColumnRenamed("count", "n").collect()}
    assert all(f[d] == g[d] for d in (1, 2, 3, 4))
    assert g[5] > f[5]
    assert fixed.where("payment_document_id = 5").where("send_code <> 'NEW'").count() == 0
