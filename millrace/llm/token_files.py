"""Token ids in Parquet list columns, in document order, read back by column and by page.

The file format: one row per document in ascending id order, with

* ``ids`` - the token ids, a list column, dictionary encoded (the vocabulary is
  small, so an index takes two bytes or less);
* ``doc_id``, ``part``, ``ids_before``, ``n_ids`` - delta encoded: the document,
  the file's place in the order, how many ids come before the document in that
  file, and how many it has.

Row groups and pages are small and carry column and page indexes, so reading
some documents, or only the metadata, touches only those pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import gathered, pieces
from .tokens import encoder

WRITE_OPTIONS = {
    "compression": "snappy",
    "parquet.writer.version": "PARQUET_2_0",  # delta encoding where no dictionary is used
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#ids_before": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}

_COLUMNS = "doc_id bigint, part int, ids_before bigint, n_ids int, ids array<int>"
_FILE = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("ids_before", pa.int64()), ("n_ids", pa.int32()), ("ids", pa.list_(pa.int32()))])


def with_end(ids: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Put ``end_id`` after the ids of each text; returns ids and the n+1 offsets."""
    n = len(at) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    keep = np.ones(len(out), bool)
    new = at + np.arange(n + 1)
    keep[new[1:] - 1] = False
    out[keep] = ids
    return out, new


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode whole texts (null: empty), append ``end_id``, write the files in ascending id order.

    Rows with a null id come first; repeated rows are written as often as they
    occur. Other columns are not read. An empty table makes an empty folder of
    files with the schema.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in pieces(gathered(batches, 7 << 20), "text", 7 << 20):
            ids, at = with_end(*encode_texts(batch.column("text")), end_id)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.view(np.int32)))
            parts = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), parts, pa.array(before + at[:-1]),
                                               pa.array(np.diff(at).astype(np.int32)), lists], schema=_FILE)
            before += int(at[-1])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    coded = ordered.mapInArrow(encode, _COLUMNS)
    coded.write.options(**WRITE_OPTIONS).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_COLUMNS).parquet(path)


def digest(files: DataFrame) -> DataFrame:
    """Per document, from the files: place of its first id, number of ids, CRC-32 of the ids.

    Only one row per file is brought together for the files' places in the order.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            at = np.asarray(lists.offsets, np.int64)
            raw = memoryview(np.ascontiguousarray(np.asarray(lists.values), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "part", "ids_before")), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                ["doc_id", "part", "ids_before", "n_tokens", "ids_crc32"],
            )

    rows = files.mapInArrow(check, "doc_id bigint, part int, ids_before bigint, n_tokens bigint, ids_crc32 bigint")
    # A file's size is where its last document ends, read without the ids.
    sizes = files.groupBy("part").agg(F.max(F.col("ids_before") + F.col("n_ids")).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return rows.join(places, "part").select(
        "doc_id", (F.col("base") + F.col("ids_before")).alias("start"), "n_tokens", "ids_crc32", "part"
    )
