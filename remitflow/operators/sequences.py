"""Dense 1..N numbering within groups (SEQUENCE1/2/3, line numbers), skew-safe.

A plain ``row_number() OVER (PARTITION BY file_id …)`` puts a whole file in one
task; one payment document can hold a third of all payments.  ``sequence_within``
therefore splits groups by size:

* groups with at most ``hot_rows`` rows use the window (one hash shuffle);
* larger ("hot") groups are range-partitioned on (group, order) so one group
  spans many tasks; each task numbers its rows with
  ``monotonically_increasing_id`` (consecutive inside a partition), and the
  per-(group, partition) counts — at most #hot groups + #partitions rows — give
  each partition's offset through a small window and a broadcast join.

The hot branch is checkpointed into ``spark.checkpoint.dir`` before its ids are
read twice, so a lost executor cannot renumber half of a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

HOT_GROUP_ROWS = 2_000_000
HOT_ROWS_CONF = "remitflow.hotGroupRows"


def hot_rows_of(spark, default: int = HOT_GROUP_ROWS) -> int:
    """Group size above which numbering leaves the single-task window (session setting)."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(default)))


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def sequence_by_window(df: DataFrame, group: list[str], order: list, out: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def sequence_by_sort(df: DataFrame, group: list[str], order: list, out: str, checkpoint: bool = True) -> DataFrame:
    keys = _cols(group) + _cols(order)
    tagged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        tagged = tagged.checkpoint(eager=True)
    stats = tagged.groupBy(*group, "_pid").agg(F.min("_mid").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(*group, "_pid", "_lo", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # offsets has at most (#groups + #partitions) rows: bounded, safe to broadcast.
    joined = tagged.join(F.broadcast(offsets), [*group, "_pid"])
    return joined.withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_lo") + 1).cast("bigint")) \
        .drop("_pid", "_mid", "_lo", "_off")


def hot_groups(df: DataFrame, group: list[str], hot_rows: int = HOT_GROUP_ROWS) -> list[tuple]:
    """Keys of groups with more than ``hot_rows`` rows (at most total/hot_rows keys, collected)."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_gn"))
    return [tuple(r[c] for c in group) for r in sizes.where(F.col("_gn") > hot_rows).select(*group).collect()]


def sequence_within(df: DataFrame, group: list[str], order: list, out: str = "seq",
                    hot_rows: int | None = None, hot_keys: list[tuple] | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in its group under ``order``.

    ``order`` must make rows unique within a group (ties would make the
    numbering depend on scheduling).  ``hot_keys`` may be passed when the
    caller already knows the group sizes; otherwise one small aggregation finds
    them.  With no hot group the plan is a single window.
    """
    if hot_rows is None:
        hot_rows = hot_rows_of(df.sparkSession)
    if hot_keys is None:
        hot_keys = hot_groups(df, group, hot_rows)
    if not hot_keys:
        return sequence_by_window(df, group, order, out)
    hot = F.broadcast(df.sparkSession.createDataFrame(hot_keys, df.select(*group).schema))
    cold = sequence_by_window(df.join(hot, group, "left_anti"), group, order, out)
    warm = sequence_by_sort(df.join(hot, group, "left_semi"), group, order, out)
    return cold.unionByName(warm)
