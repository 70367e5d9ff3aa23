"""Named delivery of bank files (SNK-01, SNK-04): a committed manifest of ordered parts.

A written file is a folder of parts, as a huge file is written by many tasks.  The manifest gives it its name and
says which parts make it up, in which order: for each part its number, its byte offset and first line (prefix sums
over the parts of the file), its length, number of lines and SHA-256; for the file its size and the SHA-256 of
its parts' digests in order.  Whoever reads by the manifest sees committed parts only, one after the other, and can
tell a part that is missing, cut short or changed.  The manifest of a run replaces its own rows when the run is
made again.  Parts are read as whole rows (``write_bank_files`` bounds their number of lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = ("file_id string, file_name string, part_no int, path string, byte_offset long, n_bytes long, first_line long, n_lines long, "
            "sha256 string, n_parts int, file_bytes long, file_sha256 string")


def _parts(spark: SparkSession, files_path: str) -> DataFrame:
    """file_id, path (from the folder of the file on), content of every part there is."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(files_path)
    return raw.select(F.col("file_id").cast("string").alias("file_id"), F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("path"), "length", "content")


def _newlines(content: Column) -> Column:
    text = F.decode(content, "ISO-8859-1")
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).cast("long")


def commit_manifest(names: DataFrame, files_path: str, manifest_path: str) -> DataFrame:
    """Describe the parts under ``files_path`` of the files in ``names`` (file_id, file_name, file_extension) and commit
    that as Parquet, one folder per file.  A file without parts has no rows."""
    spark = names.sparkSession
    own = names.select("file_id", F.concat_ws(".", F.col("file_name"), F.col("file_extension")).alias("file_name"))
    parts = _parts(spark, files_path).select("file_id", "path", F.col("length").alias("n_bytes"), _newlines(F.col("content")).alias("n_lines"),
                                             F.sha2("content", 256).alias("sha256")).join(own, "file_id")
    ordered = Window.partitionBy("file_id").orderBy("path")   # a file's parts, not its lines
    before, every = ordered.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file_id")
    digests = F.array_sort(F.collect_list(F.struct("path", "sha256")).over(every))
    out = parts.select(
        "file_id", "file_name", F.row_number().over(ordered).alias("part_no"), "path", F.coalesce(F.sum("n_bytes").over(before), F.lit(0)).alias("byte_offset"),
        "n_bytes", (F.coalesce(F.sum("n_lines").over(before), F.lit(0)) + 1).alias("first_line"), "n_lines", "sha256",
        F.count(F.lit(1)).over(every).cast("int").alias("n_parts"), F.sum("n_bytes").over(every).alias("file_bytes"),
        F.sha2(F.concat_ws("", F.transform(digests, lambda d: d["sha256"])), 256).alias("file_sha256"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_id").parquet(manifest_path)
    return read_manifest(spark, manifest_path).join(names.select("file_id"), "file_id", "left_semi")


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(manifest_path)


def delivered_lines(manifest: DataFrame, files_path: str) -> DataFrame:
    """file_name, line_no, value: the lines of the named files, read part by part.  Parts that the manifest does not
    name (left by an attempt that failed) are not read into them."""
    spark = manifest.sparkSession
    parts = _parts(spark, files_path).join(manifest.select("file_id", "path", "file_name", "first_line", "n_bytes", "sha256"), ["file_id", "path"])
    checked = F.when((F.col("length") == F.col("n_bytes")) & (F.sha2("content", 256) == F.col("sha256")), F.col("content")) \
        .otherwise(F.raise_error(F.concat(F.lit("part differs from its manifest: "), F.col("path"))))
    lines = F.split(F.decode(checked, "ISO-8859-1"), "\n")   # a line ends in LF: what follows the last one is empty
    own = parts.select("file_name", "first_line", F.posexplode(F.slice(lines, F.lit(1), F.size(lines) - 1)).alias("at", "value"))
    return own.select("file_name", (F.col("first_line") + F.col("at")).alias("line_no"), "value")


def delivery_problems(manifest: DataFrame, files_path: str) -> DataFrame:
    """(check_name, key, detail): parts that are missing, cut or changed, and names that two files have."""
    found = _parts(manifest.sparkSession, files_path).select("file_id", "path", "length", F.sha2("content", 256).alias("_sha"))
    j = manifest.join(found, ["file_id", "path"], "left")
    what = (F.when(F.col("_sha").isNull(), F.lit("missing")).when(F.col("length") != F.col("n_bytes"), F.lit("other length"))
            .when(F.col("_sha") != F.col("sha256"), F.lit("other content")))
    bad = j.select(F.lit("DQ-13 part not as delivered").alias("check_name"), F.col("file_id").alias("key"),
                   F.concat_ws(": ", F.col("path"), what).alias("detail"), what.alias("_w")).where("_w IS NOT NULL").drop("_w")
    twice = manifest.groupBy("file_name").agg(F.countDistinct("file_id").alias("n")).where("n > 1").select(
        F.lit("DQ-14 file name used twice").alias("check_name"), F.col("file_name").alias("key"), F.col("n").cast("string").alias("detail"))
    return bad.unionByName(twice)
