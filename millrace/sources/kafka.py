"""Kafka topics as streams and as a sink.

The connector is an add-on package of Spark (``spark-sql-kafka``); it has to be
on the class path for ``read_topic`` and ``write_topic``. What goes into and
comes out of a record's value is plain column work and needs no connector.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(servers: str, topic: str, group: str | None = None, start: str = "latest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    return options


def read_topic(spark: SparkSession, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(**options)).load()


def text_values(records: DataFrame) -> DataFrame:
    return records.select(F.col("value").cast("string").alias("value"))


def json_rows(records: DataFrame, schema: str) -> DataFrame:
    """Records whose value is a JSON object, as typed columns."""
    return records.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def csv_rows(records: DataFrame, schema: str, sep: str = ",") -> DataFrame:
    """Records whose value is a delimited line, as typed columns."""
    value = F.col("value").cast("string")
    return records.select(F.from_csv(value, schema, {"sep": sep}).alias("r")).select("r.*")


def as_records(df: DataFrame, key: Column | str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows as records: a JSON value and, if given, a string key."""
    key = F.col(key) if isinstance(key, str) else key
    value = F.to_json(F.struct(*(columns or df.columns))).alias("value")
    return df.select(value) if key is None else df.select(key.cast("string").alias("key"), value)


def write_topic(records: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Batch write, or a started streaming write."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if records.isStreaming:
        writer = records.writeStream.format("kafka").options(**options)
        return writer.option("checkpointLocation", checkpoint).start()
    return records.write.format("kafka").options(**options).save()
