"""Streams that keep their late rows.

Spark's windows drop rows behind the watermark. Here each micro-batch is split
against a mark this sink keeps itself: the largest event time of all earlier
micro-batches, less the allowed disorder. The mark is one number, written anew
next to the output by each micro-batch; only the one before is read, and a
micro-batch that runs again reads the same mark again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequences import as_micros


def split_late(
    stream: DataFrame, path: str, checkpoint: str, time: str,
    disorder_us: int, window_us: int, lateness_us: int, trigger: dict | None = None,
):
    """Start a stream that writes rows in time and late rows to ``path``, by ``status``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema("mark bigint").parquet(f"{path}/marks/{batch_id - 1}").collect() if batch_id else []
        mark = before[0]["mark"] if before else None
        at = as_micros(batch, time)
        end = (F.floor(at / window_us) + 1) * window_us
        passed = F.lit(None).cast("bigint") if mark is None else F.lit(mark - disorder_us)
        status = (
            F.when(passed.isNull() | (end > passed), "on_time")
            .when(end + lateness_us > passed, "update")
            .otherwise("late")
        )
        marked = batch.withColumn("window_start_us", (end - window_us).cast("bigint")).withColumn("status", status)
        marked.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        newest = batch.agg(F.greatest(F.max(at), F.lit(mark).cast("bigint")).alias("mark"))
        newest.write.mode("overwrite").parquet(f"{path}/marks/{batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
