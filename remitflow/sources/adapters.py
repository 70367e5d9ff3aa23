"""Map the given tables onto the payables entities.

| entity              | source                                                     |
| ------------------- | ---------------------------------------------------------- |
| checks              | orders (one payment per order)                             |
| supplier sites      | customer                                                   |
| invoice payments    | lineitem (check = order, invoice = part)                   |
| invoices            | part                                                       |
| banks               | region                                                     |
| bank accounts, uses, operating units, legal entities, payment documents | nation |
| supplier bank chain | customer (party, site, supplier, one account each; a second account for overdrawn customers) |

Every mapping is a projection of the scan (no joins, no filters), so each
entity scales with its table.  The same rules are written in SQL in
``remitflow.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MONEY, STATUS_NEW, STATUS_PRINTED
from .tables import table


def _doc_id(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("bigint")


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
              "o_orderdate", "o_orderpriority")
    doc = _doc_id(F.col("o_orderpriority"))
    courier = F.coalesce(doc == 5, F.lit(False))
    return o.select(
        F.col("o_orderkey").alias("check_id"),
        F.col("o_orderkey").alias("doc_sequence_value"),
        F.col("o_orderkey").alias("check_number"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderdate").alias("check_date"),
        F.col("o_custkey").alias("vendor_id"),
        F.col("o_custkey").alias("vendor_site_id"),
        doc.alias("payment_document_id"),
        (doc - 1).alias("ce_bank_acct_use_id"),
        F.when(doc == 5, F.lit("CHECK")).otherwise(F.lit("EFT")).alias("payment_method_code"),
        F.when(doc <= 2, F.lit("A")).otherwise(F.lit("Q")).alias("payment_type_flag"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias("checkrun_id"),
        F.concat(F.lit("PAYRUN "), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("checkrun_name"),
        F.when(F.dayofmonth("o_orderdate") == 31, F.lit("VOIDED")).otherwise(F.lit("NEGOTIABLE"))
        .alias("status_lookup_code"),
        F.when(courier, F.lit("COURIER")).otherwise(F.lit("STANDARD")).alias("attribute_category"),
        F.when(~courier & (F.col("o_custkey") % 11 != 0), F.concat(F.lit("B"), F.col("o_custkey") % 9)).alias("attribute2"),
        F.when(courier & (F.col("o_orderstatus") == "O"), F.lit("Y")).alias("attribute3"),
        F.when(courier, F.when(F.col("o_orderkey") % 10 == 3, F.lit("NOON")).when(F.col("o_totalprice") > 250000, F.lit("NIGHT")))
        .alias("attribute5"),
        F.when(~courier, (F.col("o_orderkey") % 40 - 4).cast("string"))
        .otherwise(F.when(F.col("o_orderkey") % 25 == 0, F.lit("n/a"))
                   .otherwise((F.col("o_totalprice").cast(MONEY) % F.lit(1000).cast(MONEY)).cast("string"))).alias("attribute8"),
        F.when(F.col("o_orderstatus") == "P", F.lit(STATUS_NEW))
        .when(F.col("o_orderstatus") == "F", F.lit(STATUS_PRINTED))
        .alias("attribute14"),
        F.when(F.dayofmonth("o_orderdate") == 31, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
        .alias("void_date"),
    )


def supplier_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("vendor_site_id"),
        F.col("c_mktsegment").alias("vendor_site_code"),
        F.col("c_name").alias("vendor_name"),
    )


def invoice_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(check_id, invoice_id) with the columns that order a check's invoices deterministically."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
               "l_extendedprice")
    return li.select(
        F.col("l_orderkey").alias("check_id"),
        F.col("l_partkey").alias("invoice_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("supplier_ref"),
        F.col("l_extendedprice").cast(MONEY).alias("amount_paid"),
    )


# Unique order of a check's invoice payments (the reference's cursor has none).
INVOICE_ORDER = ("line_number", "invoice_id", "supplier_ref", "amount_paid")


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part", "p_partkey")
    return p.select(
        F.col("p_partkey").alias("invoice_id"),
        F.concat(F.lit("INV"), F.col("p_partkey").cast("string")).alias("invoice_num"),
    )


def banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return r.select(
        F.col("r_regionkey").cast("bigint").alias("bank_party_id"),
        F.concat(F.col("r_name"), F.lit(" BANK")).alias("bank_name"),
    )


def bank_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("bank_account_id"),
        F.col("n_regionkey").cast("bigint").alias("bank_id"),
        F.concat(F.col("n_name"), F.lit(" OPERATING")).alias("bank_account_name"),
        F.lpad(F.col("n_nationkey").cast("string"), 10, "0").alias("bank_account_num"),
    )


def bank_acct_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("bank_acct_use_id"),
        F.col("n_nationkey").cast("bigint").alias("bank_account_id"),
        F.col("n_nationkey").cast("bigint").alias("org_id"),
    )


def operating_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("organization_id"),
        F.concat(F.lit("OU "), F.col("n_name")).alias("name"),
    )


def legal_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("operating_unit_id"),
        F.concat(F.lower(F.col("n_name")), F.lit(" payments sa")).alias("legal_entity_name"),
    )


# Format assigned to each payment document (attribute11 holds it as text).
DOCUMENT_FORMAT = {1: "1", 2: "2", 3: "3", 4: "1", 5: "4", 6: "5", 7: "5"}


def payment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    doc = (F.col("n_nationkey") + 1).cast("bigint")
    fmt = F.lit(None).cast("string")
    for d, f in sorted(DOCUMENT_FORMAT.items(), reverse=True):
        fmt = F.when(doc == d, F.lit(f)).otherwise(fmt)
    return n.select(
        doc.alias("payment_document_id"),
        F.col("n_nationkey").cast("bigint").alias("internal_bank_account_id"),
        F.concat(F.lit("DOC "), F.col("n_name")).alias("payment_document_name"),
        F.when(doc == 5, F.lit("CHECK")).otherwise(F.lit("EFT")).alias("payment_doc_category"),
        F.lit(None).cast("timestamp_ntz").alias("inactive_date"),
        F.when(doc == 5, F.lit("CHECK_FMT")).otherwise(F.lit("EFT_FMT")).alias("format_code"),
        fmt.alias("attribute11"),
    )


def supplier_bank_accounts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables of the supplier bank chain, each a projection of ``customer``.

    Customers with a negative balance hold a second (savings) account, so the
    vendor ⋈ account relation is n:m as in the reference.
    """
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    main = c.select(
        (F.col("c_custkey") * 2).alias("ext_bank_account_id"),
        F.col("c_custkey").alias("owner"),
        F.concat(F.col("c_name"), F.lit(";MAIN")).alias("bank_account_name"),
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.lit("-"),
                 F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("bank_account_num"),
    )
    second = c.where(F.col("c_acctbal") < 0).select(
        (F.col("c_custkey") * 2 + 1).alias("ext_bank_account_id"),
        F.col("c_custkey").alias("owner"),
        F.concat(F.col("c_name"), F.lit(";SAVINGS")).alias("bank_account_name"),
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.lit("-9"),
                 F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("bank_account_num"),
    )
    accts = main.unionByName(second)
    return {
        "ext_bank_accounts": accts.select("ext_bank_account_id", "bank_account_name", "bank_account_num"),
        "account_owners": accts.select("ext_bank_account_id", F.col("owner").alias("account_owner_party_id")),
        "party_sites": c.select(F.col("c_custkey").alias("party_id"),
                                F.concat(F.lit("SITE "), F.col("c_mktsegment")).alias("party_site_name")),
        "parties": c.select(F.col("c_custkey").alias("party_id"), F.col("c_name").alias("party_name")),
        "suppliers": c.select(F.col("c_custkey").alias("vendor_id"), F.col("c_custkey").alias("party_id")),
    }
