"""File and table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    df.write.mode("overwrite").option("sep", sep).csv(path)


def insert_select(spark: SparkSession, target: str, select: str) -> None:
    """``INSERT INTO target SELECT ...`` into a saved table."""
    spark.sql(f"INSERT INTO `{target}` {select}")

