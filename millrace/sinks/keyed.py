"""Keyed sinks: the last value of each key goes to an outside store.

A store is anything with ``upsert(rows)`` and ``close()``; ``connect`` opens one
and must be picklable. One connection is opened per task, and rows go out in
batches. A task that runs again writes the same keys with the same values, so
the sinks are safe to repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def last_by_key(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each key with its newest row as JSON: key -> value."""
    row = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(key).agg(F.to_json(row).alias("value"))


def write_partitions(df: DataFrame, connect: Callable[[], Any], batch_size: int = 500) -> None:
    """Send rows to a store, one connection per task."""

    def task(rows: Iterator[Row]) -> None:
        store = connect()
        try:
            while chunk := [tuple(r) for r in islice(rows, batch_size)]:
                store.upsert(chunk)
        finally:
            store.close()

    df.foreachPartition(task)


def upsert_stream(
    df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str],
    connect: Callable[[], Any], checkpoint: str, batch_size: int = 500,
):
    """A started stream that upserts the last value per key of each micro-batch."""

    def write(batch: DataFrame, _: int) -> None:
        write_partitions(last_by_key(batch, key, order, columns), connect, batch_size)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


class SqlStore:
    """A store over a DB-API connection and a prepared statement."""

    def __init__(self, connection: Any, statement: str):
        self.connection, self.statement = connection, statement

    def upsert(self, rows: list[tuple]) -> None:
        cursor = self.connection.cursor()
        cursor.executemany(self.statement, rows)
        self.connection.commit()

    def close(self) -> None:
        self.connection.close()


def jdbc_options(url: str, table: str, driver: str, user: str = "", password: str = "", batch_size: int = 1000) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "driver": driver, "batchsize": str(batch_size)}
    if user:
        options |= {"user": user, "password": password}
    return options


def write_jdbc(df: DataFrame, mode: str = "append", **options) -> None:
    """Spark's own JDBC writer: prepared inserts, batched, one connection per task."""
    df.write.format("jdbc").options(**jdbc_options(**options)).mode(mode).save()
