"""Generated test events: tables, streams and a custom data source.

Every value looks random but is a fixed function of
the row's number and a seed, so a task that runs again makes the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.scalar import pick

# The behaviours and channels of the marketing events.
BEHAVIORS = ["download", "install", "update", "uninstall"]
CHANNELS = ["huawwei", "xiaomi", "apple", "baidu", "qq", "oppo", "vivo"]


def marketing_events(rows: DataFrame, number: str, millis: Column, seed: int = 0) -> DataFrame:
    """One marketing event per row of ``rows``, from the row's ``number``."""
    n = F.col(number)
    return rows.select(
        F.pmod(n * 7919 + seed, F.lit(1_000_000)).alias("user_id"),
        pick(BEHAVIORS, n * 17 + seed).alias("behavior"),
        pick(CHANNELS, n * 31 + seed).alias("channel"),
        millis.alias("ts"),
    )


class _Range(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def _sensor_rows(start: int, end: int) -> Iterator[tuple]:
    for n in range(start, end):
        mixed = (n * 2_654_435_761) & 0xFFFFFFFF
        yield f"sensor{mixed % 100}", n * 1000, (mixed >> 8) % 1000


class _BatchReader(DataSourceReader):
    def __init__(self, rows: int, parts: int):
        self.rows, self.parts = rows, parts

    def partitions(self):
        step = -(-self.rows // self.parts)
        return [_Range(a, min(a + step, self.rows)) for a in range(0, self.rows, step)]

    def read(self, partition):
        return _sensor_rows(partition.start, partition.end)


class _StreamReader(DataSourceStreamReader):
    """Offers ``per_batch`` more rows at each step, until ``rows`` are out."""

    def __init__(self, rows: int, parts: int, per_batch: int):
        self.rows, self.parts, self.per_batch, self.offered = rows, parts, per_batch, 0

    def initialOffset(self):
        return {"row": 0}

    def latestOffset(self):
        self.offered = min(self.rows, self.offered + self.per_batch)
        return {"row": self.offered}

    def partitions(self, start, end):
        self.offered = max(self.offered, end["row"])
        lo, hi = start["row"], end["row"]
        step = max(1, -(-(hi - lo) // self.parts))
        return [_Range(a, min(a + step, hi)) for a in range(lo, hi, step)]

    def read(self, partition):
        return _sensor_rows(partition.start, partition.end)


class SensorSource(DataSource):
    """``spark.read.format("sensor_rows")`` and ``spark.readStream...``."""

    @classmethod
    def name(cls):
        return "sensor_rows"

    def schema(self):
        return "id string, ts bigint, vc int"

    def _option(self, name: str, default: int) -> int:
        return int(self.options.get(name, default))

    def reader(self, schema):
        return _BatchReader(self._option("rows", 1000), self._option("parts", 2))

    def streamReader(self, schema):
        rows, parts = self._option("rows", 1000), self._option("parts", 2)
        return _StreamReader(rows, parts, self._option("perBatch", 100))
