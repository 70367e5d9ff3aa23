"""Quirk-ledger rows not covered elsewhere."""
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF
from remitflow.operators import aggregate as agg
from remitflow.operators import lookups, render
from remitflow.operators import selection as sel_ops
from remitflow.plans.context import Ctx
from remitflow.schema import FORMAT_FIELDS, FORMATS, RunParams


def test_q6_trailer_prefixed_with_header_only_in_legacy_mode(spark):
    formats = spark.createDataFrame([(1, "HT", "FIXED_WIDTH", None, "txt", "LF", "Y")], FORMATS)
    fields = spark.createDataFrame([
        (1, 1, "h", "CONSTANT", "HEAD", 1, 1, 4, "STRING", None, None, None, None, "HEADER"),
        (2, 1, "b", "SEQUENCE1", None, 1, 1, 3, "NUMBER", "999", 48, "LEFT", None, "BODY"),
        (3, 1, "t", "TRX_LINES", None, 1, 1, 3, "NUMBER", "999", 48, "LEFT", None, "TRAILER")], FORMAT_FIELDS)
    layout = render.Layout.load(formats, fields)
    sel = spark.createDataFrame([("f", 1, 1, 1, Decimal("1.00"))], "file_id string, format_id long, check_id long, "
                                                                    "check_number long, amount decimal(18,2)")
    paid = spark.createDataFrame([], "file_id string, format_id long, check_id long, invoice_id long, check_number long")
    req = spark.createDataFrame([("f", 1)], "file_id string, format_id long")
    dyn = render.dynamic_values(spark.sql, layout.specs, {})

    def lines(legacy):
        out = render.render_lines(spark, req, sel, paid, agg.selection_totals(sel), layout, dyn, ["invoice_id"],
                                  legacy=legacy)
        return [r.value for r in out.orderBy("line_no").collect()]
    assert lines(frozenset()) == ["HEAD", "001", "001"]
    assert lines(frozenset({"Q6"})) == ["HEAD", "001", "HEAD001"]


def test_q8_inner_joins_drop_payments_without_site(spark):
    ctx = Ctx(spark, SF)
    some_sites = ctx.sites.where(F.col("vendor_site_code") != "BUILDING")
    req, full = sel_ops.run_selection(spark, ctx.checks, ctx.sites, ctx.values, ctx.docs, ctx.params)
    _, part = sel_ops.run_selection(spark, ctx.checks, some_sites, ctx.values, ctx.docs, ctx.params)
    lost = full.where(F.col("vendor_site_code") == "BUILDING").count()
    assert lost > 0 and part.count() == full.count() - lost


def test_q9_status_switch(spark):
    ctx = Ctx(spark, SF)

    def codes(only_unsent):
        _, s = sel_ops.run_selection(spark, ctx.checks, ctx.sites, ctx.values, ctx.docs,
                                     ctx.params.with_(only_unsent=only_unsent))
        return {r.send_code for r in s.select("send_code").distinct().collect()}
    assert codes("Y") == {"NEW"}
    assert codes("N") == {"NEW", "PRINTED"}
    assert codes(None) == {"NEW"}
    assert RunParams("a", "b", only_unsent=None).status_check is None


def test_q19_site_in_distinct_duplicates_lines(spark):
    chain = {
        "ext_bank_accounts": spark.createDataFrame([(1, "ACC", "001")], "ext_bank_account_id long, bank_account_name string, bank_account_num string"),
        "account_owners": spark.createDataFrame([(1, 7)], "ext_bank_account_id long, account_owner_party_id long"),
        "party_sites": spark.createDataFrame([(7, "S1"), (7, "S2")], "party_id long, party_site_name string"),
        "parties": spark.createDataFrame([(7, "P")], "party_id long, party_name string"),
        "suppliers": spark.createDataFrame([(70, 7)], "vendor_id long, party_id long"),
    }
    assert lookups.supplier_bank(chain).count() == 1
    assert lookups.supplier_bank(chain, dedupe_site=False).count() == 2
