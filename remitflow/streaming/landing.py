"""Incremental landing ingest with Structured Streaming (ST-01).

New files in a landing folder are picked up by a file-source stream with
``trigger(availableNow=True)``.  Each micro-batch is decided file by file first: rows of a file with
any reject are not taken (all-or-nothing), its rejects are, and every file with a row gets a status
row (``empty_files`` lists the others).  A batch writes under its own ``epoch=<n>`` folders and replaces them, so a batch that is
tried again after a failure repeats no row.  The stream checkpoint (under the shared checkpoint
folder) records processed files, replacing the reference's move-to-archive step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_snapshot, materialize
from ..sources.ingest import CORRUPT, batch_status, list_files, path_of, split_rows


def start_landing_stream(spark: SparkSession, landing: str, schema: T.StructType, required: list[str],
                         good_path: str, rejected_path: str, status_path: str, checkpoint: str,
                         sep: str = ","):
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    stream = (spark.readStream.schema(full).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("sep", sep).option("header", "false")
              .csv(landing)
              .withColumn("file_name", F.col("_metadata.file_name"))
              .withColumn("file_path", F.col("_metadata.file_path")))

    def batch(df: DataFrame, epoch: int) -> None:
        rows = materialize(df, "landing-batch")  # parsed once
        try:
            good, rejected = split_rows(rows, required)
            failed = rejected.select("file_path").distinct()
            clean = good.join(failed, "file_path", "left_anti").select(*good.columns)
            for out, path in ((clean, good_path), (rejected, rejected_path), (_statuses(rows, good, rejected), status_path)):
                out.withColumn("epoch", F.lit(epoch).cast("bigint")).write.mode("overwrite") \
                    .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)
        finally:
            drop_snapshot(rows)

    def _statuses(rows: DataFrame, good: DataFrame, rejected: DataFrame) -> DataFrame:
        def count(part: DataFrame, name: str) -> DataFrame:
            return part.groupBy(path_of("file_path").alias("file_path")).agg(F.count(F.lit(1)).alias(name))
        seen = rows.select(path_of("file_path").alias("file_path")).distinct()
        s = seen.join(count(good, "n_good"), "file_path", "left").join(count(rejected, "n_bad"), "file_path", "left").fillna(0, ["n_good", "n_bad"])
        return s.select("file_path", "n_good", "n_bad", batch_status(F.lit(1), F.col("n_good"), F.col("n_bad")).alias("status"))

    return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Make the stream try its last batch again, as after a failure between a batch's writes and its commit."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()]
    if done:
        fs.delete(hadoop.Path(f"{checkpoint}/commits/{max(done)}"), False)


def empty_files(spark: SparkSession, landing: str, glob: str = "*.csv") -> DataFrame:
    """Status rows of landed files without a byte, which the stream never sees a row of."""
    return list_files(spark, landing, glob).where("length = 0").select(
        path_of("file_path").alias("file_path"), F.lit(0).cast("bigint").alias("n_good"), F.lit(0).cast("bigint").alias("n_bad"),
        F.lit("EMPTY FILE").alias("status"))
