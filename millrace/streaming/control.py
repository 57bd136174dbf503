"""Rules that change while a stream runs: control rows and data rows in one stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import combine
from ..operators.sequences import as_micros


def apply_as_of(stream: DataFrame, path: str, checkpoint: str, is_control: Column, time: str, ident: str, value: str,
                keep: Sequence[str], delay_us: int = 0, trigger: dict | None = None):
    """Give each data row the control value that held at its own time; start the stream that does so.

    Rows where ``is_control`` holds set ``value`` from their ``time`` on (ties by
    ``ident``); the others are data. Each micro-batch works with its own control
    rows and the versions that earlier ones left: the newest, and those at most
    ``delay_us`` behind the newest row seen, so data rows may come that late.
    Rows go to ``path/rows`` with the columns ``keep`` and ``value``, versions to
    ``path/versions``, a folder per micro-batch, overwritten if it runs again.
    """
    spark = stream.sparkSession
    version = [time, ident, value]
    kinds = stream.select(*version).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        versions = batch.where(is_control).select(*version)
        if batch_id > 0:
            earlier = spark.read.schema(kinds).parquet(f"{path}/versions/batch_id={batch_id - 1}")
            versions = versions.unionByName(earlier)
        data = batch.where(~is_control).select(*{c: None for c in (*keep, time, ident)})
        seen = combine.control_as_of(data, versions, time, ident, value)
        seen.select(*keep, value).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        newest = F.max(as_micros(batch, time))
        edge = batch.select(time).unionByName(versions.select(time)).agg(newest.alias("t")).select((F.col("t") - delay_us).alias("_edge"))
        timed = versions.crossJoin(F.broadcast(edge)).withColumn("_old", as_micros(versions, time) <= F.col("_edge"))
        last = timed.where("_old").agg(F.max_by(F.struct(*version), F.struct(time, ident)).alias("v")).where("v is not null").select("v.*")
        left = timed.where("not _old").select(*version).unionByName(last)
        left.write.mode("overwrite").parquet(f"{path}/versions/batch_id={batch_id}")

    started = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return started.trigger(**(trigger or {"availableNow": True})).start()
