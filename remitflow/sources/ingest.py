"""Landing-file loader with quarantine (SRC-13/14, SNK-09/10, DQ-09).

Delimited files are read in PERMISSIVE mode with a corrupt-record column;
each row carries its source file name.  A file with any rejected row is
marked ``BATCH ERROR`` as a whole; empty files are reported from the file
listing.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


@dataclass
class Landing:
    good: DataFrame
    rejected: DataFrame
    file_status: DataFrame


def read_landing(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("sep", sep).option("header", "false").option("recursiveFileLookup", "true").csv(path)
            .withColumn("file_name", F.col("_metadata.file_name"))
            .withColumn("file_path", F.col("_metadata.file_path")))


def split_rows(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rejected = unparsable (corrupt column set) or missing a required value (too few columns)."""
    bad = F.col(CORRUPT).isNotNull()
    for c in required:
        bad = bad | F.col(c).isNull()
    tagged = rows.withColumn("_bad", bad)
    good = tagged.where(~F.col("_bad")).drop("_bad", CORRUPT)
    rejected = tagged.where(F.col("_bad")).select("file_name", "file_path", F.col(CORRUPT).alias("raw_record"),
                                                  *[c for c in required])
    return good, rejected


def list_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(file_path, length) of every landed file, empty ones included (scans skip those).

    The listing is Spark's own file index, made in parallel; file contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    names = spark.createDataFrame([(unquote(f),) for f in files.inputFiles()], "file_path string").withColumn("_p", path_of("file_path"))
    sized = files.select(path_of("path").alias("_p"), "length")
    return names.join(sized, "_p", "left").select("file_path", F.coalesce("length", F.lit(0)).cast("long").alias("length"))


def path_of(column: str) -> Column:
    """A file's path without scheme and host: listings and scans spell them differently."""
    return F.regexp_replace(F.col(column), "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")


def batch_status(length: Column, n_good: Column, n_bad: Column) -> Column:
    """SNK-10 / DQ-09: one reject fails the whole file; a file without a row is empty."""
    return (F.when(length == 0, F.lit("EMPTY FILE")).when(n_bad > 0, F.lit("BATCH ERROR"))
            .when(n_good == 0, F.lit("EMPTY FILE")).otherwise(F.lit("OK")))


def file_status(spark: SparkSession, path: str, good: DataFrame, rejected: DataFrame,
                glob: str = "*.csv") -> DataFrame:
    """SNK-10 / DQ-09: per landed file: good rows, rejected rows, status."""
    listing = list_files(spark, path, glob).withColumn("file_path", path_of("file_path"))
    counted = (good.select(path_of("file_path").alias("file_path"), F.lit(1).alias("g"), F.lit(0).alias("b"))
               .unionByName(rejected.select(path_of("file_path").alias("file_path"), F.lit(0).alias("g"), F.lit(1).alias("b")))
               .groupBy("file_path").agg(F.sum("g").alias("n_good"), F.sum("b").alias("n_bad")))
    s = listing.join(counted, "file_path", "left").fillna(0, ["n_good", "n_bad"])
    return s.select("file_path", "length", "n_good", "n_bad", batch_status(F.col("length"), F.col("n_good"), F.col("n_bad")).alias("status"))


def load_landing(spark: SparkSession, path: str, schema: T.StructType, required: list[str],
                 sep: str = ",") -> Landing:
    """All-or-nothing per file: ``good`` holds the rows of files without a reject only."""
    rows = read_landing(spark, path, schema, sep)
    good, rejected = split_rows(rows, required)
    st = file_status(spark, path, good, rejected)
    failed = rejected.select("file_path").distinct()
    return Landing(good.join(failed, "file_path", "left_anti").select(*good.columns), rejected, st)
