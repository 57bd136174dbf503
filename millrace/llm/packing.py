"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

Only the *number* of pieces of each length decides how they fit, and there are
no more lengths than the capacity. So the fit is worked out on that histogram
(at most ``capacity`` rows, whatever the corpus), as a list of bin patterns with
how often each is used; pieces then take their places by a join on length.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .text import gathered, pieces
from .token_files import with_end
from .tokens import encoder

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Patterns of lengths that fill a sequence, and how many sequences use each.

    A sequence is filled with the longest pieces that fit. Then its smallest
    piece gives way to two unpacked ones, if two exist that together fill the
    widened gap better. While no length involved runs out, the next sequence
    comes out the same, so all of them are made in one step; the number of
    steps is bounded by the sum of capacity / length over the lengths.
    """
    left = Counter({n: c for n, c in counts.items() if c > 0})
    lengths = sorted(left, reverse=True)
    out: list[tuple[int, list[int]]] = []
    while lengths:
        held: Counter[int] = Counter()
        gap = capacity
        for n in lengths:
            take = min(gap // n, left[n])
            if take:
                held[n] = take
                gap -= n * take
        most = Counter(held)
        small = min(held)
        if gap and (pair := _two(lengths, left - held, gap + small, small)):
            held.subtract([small])
            held.update(pair)
            most |= held
        held = +held
        times = min((left[n] - most[n]) // held[n] + 1 if held[n] else 1 << 62 for n in most)
        out.append((times, sorted(held.elements(), reverse=True)))
        for n, k in held.items():
            left[n] -= k * times
        lengths = [n for n in lengths if left[n] > 0]
    return out


def _two(lengths: list[int], free: Counter[int], gap: int, more_than: int) -> tuple[int, int] | None:
    """The two free lengths whose sum is largest, above ``more_than`` and within ``gap``."""
    fits = [n for n in reversed(lengths) if free[n] > 0 and n < gap]
    best, found = more_than, None
    low, high = 0, len(fits) - 1
    while low <= high:
        a, b = fits[high], fits[low]
        if a + b > gap:
            high -= 1
        else:
            if a + b > best and (low < high or free[a] > 1):
                best, found = a + b, (a, b)
            low += 1
    return found


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool = False, text: str = "text", doc_id: str = "doc_id",
        batch_bytes: int = 16 << 20) -> DataFrame:
    """One row per piece of each whole text with ``end_id`` at its end.

    A document of at most ``capacity`` ids is one piece. A longer one is cut
    into pieces of ``capacity``, of which the first takes what is left over.
    ``nth`` numbers the pieces of one length within the task ``part``. Texts
    are encoded in batches of about ``batch_bytes``; smaller ones take less
    memory and meet the same pieces more often.
    """
    kind = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                      ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())])
    if keep_ids:
        kind = kind.append(pa.field("ids", pa.list_(pa.int32())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, met = encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in pieces(gathered(batches, batch_bytes), "text", batch_bytes):
            ids, at = with_end(*encode(batch.column("text")), end_id)
            n = np.diff(at)
            number = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            first = n - (number - 1) * capacity  # what is left over, in the first piece
            start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first[row])
            low = at[:-1][row] + start
            raw = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(low.tolist(), (low + length).tolist())]
            order = np.argsort(length, kind="stable")
            ranked = np.empty(len(row), np.int64)
            runs = length[order]
            begin = np.searchsorted(runs, runs)
            ranked[order] = np.arange(len(row)) - begin + met[runs]
            met += np.bincount(length, minlength=capacity + 1)
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                       pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(row), part, np.int32)), pa.array(ranked)]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(low, at[-1]).astype(np.int32)), pa.array(ids.view(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, schema=kind)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, _PIECE + (", ids array<int>" if keep_ids else ""))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False,
         text: str = "text", doc_id: str = "doc_id", batch_bytes: int = 16 << 20) -> DataFrame:
    """Place every piece of every document in a sequence of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset (and
    ids). A null or empty text is its end id alone; repeated rows are packed as
    often as they occur; a null id is kept; other columns are not read; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    placed = settle(cut(docs, tokenizer, capacity, end_id, keep_ids, text, doc_id, batch_bytes))
    by_task = placed.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    # A pattern's slots for one length, as runs: the r-th of that length, counted
    # over all sequences, lies in sequence first_sequence + (r - low).
    runs, used, sequences = [], defaultdict(int), 0
    for times, lengths in fit(histogram, capacity):
        offset = 0
        for n in lengths:
            runs.append((n, used[n], used[n] + times, sequences - used[n], offset))
            used[n] += times
            offset += n
        sequences += times
    places = spark.createDataFrame(runs, "length bigint, low bigint, high bigint, shift bigint, offset bigint")

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = by_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    ranked = placed.join(begins, ["part", "length"]).withColumn("r", F.col("begin") + F.col("nth"))
    # Bounded by the capacity alone: see fit().
    found = ranked.join(F.broadcast(places), "length").where("r >= low and r < high")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", (F.col("r") + F.col("shift")).alias("sequence_id"), "offset"]
    return found.select(*columns, *(["ids"] if keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ids in order and where each document begins."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.offset").alias("offsets"), F.col("p.doc_id").alias("doc_ids")
    )
