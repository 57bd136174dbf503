"""Catalog tables: databases, current database, saved tables.

Works with whatever catalog the session has; start it with Hive support to use
a Hive metastore.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    spark.sql(f"USE `{name}`")


def save_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0) -> None:
    """Save a table, bucketed if later joins and windows on ``bucket_by`` should not shuffle."""
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
