"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Runtime settings the streaming operators with custom state rely on.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app: str = "millrace",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; ``master`` stays unset on a cluster (spark-submit sets it)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
        **STREAM_CONF,
        **(extra or {}),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a
    cluster a machine-local path would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/millrace/{name}-{uuid.uuid4().hex}"


# A query's shuffle files go when it ends, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# By rows alone, a batch of long texts takes tens of MB on both sides of a Python worker.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold some 4 MB, unless the session has its own limit."""
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(4 << 20))


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` down in the shared folder and go on from there.

    Cuts the lineage; later steps read only the columns they need, and nothing
    reads the shuffle files of this one.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, "settled"), {k: spark.conf.get(k, None) for k in (_CLEANUP, _BATCH_BYTES)}
    spark.conf.set(_CLEANUP, "true")
    bounded_batches(spark)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)
