"""Status transitions as an append-only log (DML-01/02/07, WIN-06, ST-02, DQ-08).

The reference updated ``ATTRIBUTE14`` in place row by row.  Here a run appends
``(check_id, status, run_id, event_ts)`` rows; a payment's current status is
its latest log entry, else its base column.  A FINAL run's log is appended
after its file is written, so the next run's selection skips what was sent.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ntz
from ..schema import FINAL, GRANT_VALUE_SET
from .lookups import granted_users

# The messages of a refused reset.
NO_ACCESS = "User Does not have Access"
AMBIGUOUS_ACCESS = "Contac Payables Setup Administator for Help"


def mark(selection: DataFrame, status: str, run_id: str, event_ts: datetime, process_type: str = FINAL,
         category: str | None = None) -> DataFrame:
    """DML-01 / DML-07: log rows for every selected payment; a DRAFT run logs nothing.

    ``category``: the attribute context stamped on the payments with the status (none: they keep theirs).
    """
    rows = selection.select("check_id").distinct() if process_type == FINAL else selection.select("check_id").limit(0)
    return rows.select(
        "check_id",
        F.lit(status).alias("status"),
        F.lit(run_id).alias("run_id"),
        ntz(event_ts).alias("event_ts"),
        F.lit(category).cast("string").alias("attribute_category"),
    )


def latest_entry(log: DataFrame) -> DataFrame:
    """WIN-06: the latest entry of every payment (ties on time broken by run id, then status), with the last category
    that any entry has stamped.

    Both are mergeable states: the entry of a union is the entry of the parts' entries, so snapshots and later
    rows are merged by the same partial aggregation.
    """
    when = F.struct("event_ts", "run_id", "status")
    # A snapshot row keeps when its category was stamped, which may be before its last entry.
    stamp = F.coalesce(F.col("category_ts"), F.col("event_ts")) if "category_ts" in log.columns else F.col("event_ts")
    stamped = F.when(F.col("attribute_category").isNotNull(), F.struct(stamp.alias("category_ts"), F.col("attribute_category").alias("category"))) \
        if "attribute_category" in log.columns else F.lit(None).cast("struct<category_ts:timestamp_ntz,category:string>")
    last = log.groupBy("check_id").agg(F.max(when).alias("_last"), F.max(stamped).alias("_stamp"))
    return last.select("check_id", "_last.status", "_last.event_ts", "_last.run_id", F.col("_stamp.category").alias("attribute_category"),
                       F.col("_stamp.category_ts").alias("category_ts"))


def latest_status(log: DataFrame) -> DataFrame:
    """WIN-06: latest status per payment."""
    return latest_entry(log).select("check_id", F.col("status").alias("logged_status"), F.col("attribute_category").alias("logged_category"))


def current_checks(checks: DataFrame, log: DataFrame | None, status_col: str = "attribute14") -> DataFrame:
    """Checks with ``status_col`` replaced by the latest logged status where one exists, and the attribute context by the
    last one stamped."""
    if log is None:
        return checks
    j = checks.join(latest_status(log), "check_id", "left").withColumn(status_col, F.coalesce(F.col("logged_status"), F.col(status_col)))
    if "attribute_category" in checks.columns:
        j = j.withColumn("attribute_category", F.coalesce(F.col("logged_category"), F.col("attribute_category")))
    return j.drop("logged_status", "logged_category")


def as_claimed(checks: DataFrame, claimed: DataFrame, status_col: str = "attribute14") -> DataFrame:
    """Checks in which a run's claimed payments have the status they had when it claimed them."""
    own = claimed.select("check_id", F.col("status_before").alias("_before"), F.lit(True).alias("_own"))
    return checks.join(own, "check_id", "left").withColumn(
        status_col, F.when(F.col("_own"), F.col("_before")).otherwise(F.col(status_col))).drop("_before", "_own")


def grant_outcome(values: DataFrame, users: DataFrame, user_ids: DataFrame, as_of) -> DataFrame:
    """DQ-08: per requesting user, the number of grants and the resulting return code / message."""
    g = granted_users(values, users, GRANT_VALUE_SET, as_of).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_grants"))
    o = user_ids.join(g, "user_id", "left").withColumn("n_grants", F.coalesce(F.col("n_grants"), F.lit(0)))
    return o.select(
        "user_id", "n_grants",
        F.when(F.col("n_grants") == 1, F.lit("0")).otherwise(F.lit("1")).alias("retcode"),
        F.when(F.col("n_grants") == 0, F.lit(NO_ACCESS))
        .when(F.col("n_grants") > 1, F.lit(AMBIGUOUS_ACCESS))
        .alias("errbuf"),
    )


def unlock(selection: DataFrame, values: DataFrame, users: DataFrame, user_id: int, set_status: str,
           run_id: str, event_ts: datetime) -> DataFrame:
    """DML-02: reset the selection to ``set_status`` only for a user with exactly one grant.

    Without a unique grant the result is empty (the reference's retcode 1).
    """
    me = selection.sparkSession.createDataFrame([(user_id,)], "user_id long")
    granted = bool(grant_outcome(values, users, me, event_ts).where(F.col("retcode") == "0").limit(1).collect())
    sel = selection.select("check_id").distinct()
    if not granted:
        sel = sel.limit(0)
    return sel.select("check_id", F.lit(set_status).alias("status"), F.lit(run_id).alias("run_id"),
                      ntz(event_ts).alias("event_ts"))


LOG_SCHEMA = "check_id long, status string, event_ts timestamp_ntz, attribute_category string, run_id string"


def append_log(rows: DataFrame, path: str) -> None:
    """Write a run's rows under its own ``run_id`` folder: a rerun replaces them."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def rows_updated(log_rows: DataFrame, selection: DataFrame) -> DataFrame:
    """AGG-11: changed rows per file."""
    return selection.select("file_id", "check_id").join(log_rows.select("check_id"), "check_id") \
        .groupBy("file_id").agg(F.count(F.lit(1)).alias("rows_updated"))

