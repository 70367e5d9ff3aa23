"""Parquet scans of the input tables.

Each reader names only the columns it needs so the scan's ``ReadSchema`` is
pruned; filters applied later by the jobs are pushed into the Parquet reader by
Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
