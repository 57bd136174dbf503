"""Starting streams, repeatable sinks, and replaying a table as a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequences import as_micros
from ..session import ROCKSDB_PROVIDER, scratch_path

Build = Callable[[DataFrame], DataFrame]

# Any time in the past: only the order of the files' times counts.
_FIRST_FILE_MS = 1_000_000_000_000


@contextmanager
def stream_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a stream takes over when it starts.

    Custom state needs the RocksDB store. The number of state ``partitions`` is
    fixed at the first start; the session's number of shuffle partitions if
    none is asked for.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None,
                  partitions: int | None = None):
    """Start a stream whose every micro-batch overwrites its own folder.

    A micro-batch that runs again after a failure replaces what it wrote
    before, so each row of the result appears once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    with stream_settings(stream.sparkSession, partitions):
        return writer.start()


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows written by ``write_batches``, with their ``batch_id``."""
    full = spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0).cast("bigint")).schema
    return spark.read.schema(full).parquet(path)


def latest(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last update of each key: the result table an update stream describes."""
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return newest.select(*keys, "_v.*")


def lay_out(rows: DataFrame, path: str, order: Sequence[Column | str], files: int, dated: int = 0) -> int:
    """Write rows as files by ranges of ``order``, which a file stream then reads in that order.

    A file stream takes files by their time of change, so the files' times are
    set to follow their ranges; ``dated`` is how many earlier files there are.
    Returns how many there are now. Rows of equal order may part between files.
    The file system has to keep times as they are set, as HDFS and disks do.
    """
    spark = rows.sparkSession
    names = [f"_order{k}" for k in range(len(order))]
    keyed = rows.withColumns({n: F.col(c) if isinstance(c, str) else c for n, c in zip(names, order)})
    keyed.repartitionByRange(files, *names, F.xxhash64(*rows.columns)).drop(*names).write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    written = {f.getPath().getName(): f.getPath() for f in system.listStatus(folder)}
    for name in sorted(n for n in written if n.startswith("part-")):
        dated += 1
        system.setTimes(written[name], _FIRST_FILE_MS + 1000 * dated, -1)
    return dated


def replay(
    spark: SparkSession, rows: DataFrame, time: str, build: Build, mode: str = "append",
    steps: int = 3, rows_per_step: int | None = None, closing: DataFrame | None = None,
    partitions: int | None = None, order: Sequence[Column | str] | None = None, restart: bool = False,
) -> DataFrame:
    """Run a streaming job over a table, in time order, and return all it wrote.

    The table is laid out once in files by ranges of ``order`` (``time`` if not
    given), cut by rows, so that bursts are spread too. One query reads them as
    at least ``steps`` micro-batches of about ``rows_per_step`` rows at most.
    With ``restart`` the job ends half way and goes on from its checkpoint, so
    its state has to survive. ``closing`` rows come last, to move the watermark
    past every open window.
    """
    base = scratch_path(spark, "replay")
    out, checkpoint = f"{base}/out", f"{base}/checkpoint"
    order, at_once = list(order or [time]), spark.sparkContext.defaultParallelism
    n = rows.count()
    steps = max(steps, -(-n // rows_per_step)) if rows_per_step else steps
    halves = [rows]
    if restart:
        middle = rows.select(F.percentile_approx(as_micros(rows, time), 0.5).alias("m")).first()["m"] or 0
        early = F.coalesce(as_micros(rows, time) <= middle, F.lit(True))
        halves = [rows.where(early), rows.where(~early)]
    dated = 0
    for k, half in enumerate(halves):
        dated = lay_out(half, f"{base}/in/rows-{k}", order, max(steps * at_once // len(halves), 1), dated)
        if k + 1 == len(halves) and closing is not None:
            dated = lay_out(closing.select(rows.columns), f"{base}/in/rows-{k + 1}", [time], 1, dated)
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", at_once).option("maxFileAge", "36500d")
        result = build(source.parquet(f"{base}/in/*"))
        write_batches(result, out, checkpoint, mode, partitions=partitions).awaitTermination()
    return read_batches(spark, out, result.schema)
