"""Groups of similar texts by min-hashes, in work that grows with the texts and not with pairs of them.

Every text gets 256 min-hashes of its word shingles. Eight in a row make a key;
texts with a key in common are compared with the first and the last text of that
key only. What is compared are two bits of each min-hash, and pairs whose
agreement fits the similarity asked for are links. So a text makes at most 64
pairs, however many texts are like it.

This is an estimate: of two texts at the similarity asked for, alone in the
table, about 997 in 1,000 share a key, and pairs some way below it may link as
well. Use it to count apart what is copied; ``jaccard`` decides exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .graph import components
from .text import buffer_of, grams, mix, per_worker, pieces, words_of

_HASHES, _ROWS = 256, 8
_BITS = [f"b{k}" for k in range(2 * _HASHES // 64)]
_SIGNED = "c1 bigint, keys array<bigint>, " + ", ".join(f"{b} bigint" for b in _BITS)


def _family() -> tuple[np.ndarray, np.ndarray]:
    """One shift and one odd factor for each hash function."""
    drawn = mix(np.arange(1, 2 * _HASHES + 1, dtype=np.uint64)).astype(np.uint32)
    return drawn[:_HASHES], drawn[_HASHES:] | np.uint32(1)


def _shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a batch, text by text, and how many each text has."""
    words = words_of(*buffer_of(column))
    n = np.diff(words.first)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    values = np.zeros(len(words.hashes), np.uint64)
    if len(values) >= size:
        values[: len(values) - size + 1] = grams(words.hashes, size)
    for row in np.flatnonzero((n > 0) & (n < size)):
        values[words.first[row]] = grams(words.of(row), size)[0]
    place = np.arange(len(values)) - np.repeat(words.first[:-1], n)
    return values[place < np.repeat(counts, n)], counts


def _minima(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The 256 min-hashes of every text that has shingles."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    narrow = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), _HASHES), np.uint32)
    for k, (shift, factor) in enumerate(zip(*per_worker("min-hash family", _family))):
        out[:, k] = np.minimum.reduceat((narrow ^ shift) * factor, starts)
    return out


def signed(texts: DataFrame, size: int, wanted: np.ndarray | None = None) -> DataFrame:
    """Keys and bits of every text (c1, text) with words.

    ``wanted`` is a bitmap of hashes as made by ``bitmap``: it passes over texts
    whose c1 is not in it, and may let others through.
    """
    shared = texts.sparkSession.sparkContext.broadcast(wanted)
    places = np.arange(_HASHES // _ROWS, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is not None:
                batch = batch.filter(pa.array(in_bitmap(shared.value, batch.column("c1").to_numpy())))
            for part in pieces(iter([batch]), "text"):
                shingles, counts = _shingles(part.column("text"), size)
                ids = part.column("c1").filter(pa.array(counts > 0))
                if len(ids) == 0:
                    continue
                low = _minima(shingles, counts)
                keys = np.tile(places, (len(ids), 1))
                for row in range(_ROWS):
                    keys = mix(keys * np.uint64(0x100000001B3) + low[:, row::_ROWS])
                spread = mix(low.astype(np.uint64))
                bits = np.concatenate([spread & np.uint64(1), spread >> np.uint64(1) & np.uint64(1)], axis=1).astype(bool)
                packed = np.packbits(bits, axis=1).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([ids, lists, *(pa.array(np.ascontiguousarray(c)) for c in packed.T)], ["c1", "keys", *_BITS])

    return texts.select("c1", "text").mapInArrow(run, _SIGNED)


def bitmap(rows: DataFrame, column: str, bits: int = 22) -> np.ndarray:
    """A bitmap of bounded size of the low bits of a long column."""
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    marks = rows.select(place.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
    out = np.zeros((1 << bits) // 64, np.uint64)
    for row in marks.collect():  # at most 2**16 rows of the default size
        out[row["word"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return out


def in_bitmap(marks: np.ndarray, values: np.ndarray) -> np.ndarray:
    h = values & (len(marks) * 64 - 1)
    return ((marks[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def groups(texts: DataFrame, size: int = 5, percent: int = 80, wanted: DataFrame | None = None) -> DataFrame:
    """Rows (c1, copies) for the texts (c1, text) that are linked to others: one value of copies for a group.

    c1 is a hash of the text; rows that repeat it are one text. ``wanted`` (c1)
    leaves out texts not in it. Texts without words, and null ones, link with
    nothing; no texts give no rows.
    """
    signs = signed(texts, size, None if wanted is None else bitmap(wanted, "c1"))
    signs = settle((signs if wanted is None else signs.join(wanted.select("c1").distinct(), "c1", "left_semi")).distinct())
    spots = signs.select("c1", F.explode("keys").alias("key"))
    ends = spots.groupBy("key").agg(F.min("c1").alias("first"), F.max("c1").alias("last")).where("first <> last")
    met = spots.join(ends, "key").select("c1", F.explode(F.array("first", "last")).alias("other")).where("c1 <> other")
    pairs = settle(met.select(F.least("c1", "other").alias("a"), F.greatest("c1", "other").alias("b")).distinct())
    bits = signs.drop("keys")
    sides = pairs.join(bits.toDF("a", *(f"a{k}" for k in _BITS)), "a").join(bits.toDF("b", *_BITS), "b")
    half = len(_BITS) // 2
    apart = [F.col(f"a{k}").bitwiseXOR(F.col(k)) for k in _BITS]
    differ = sum((F.bit_count(x.bitwiseOR(y)) for x, y in zip(apart[:half], apart[half:])), F.lit(0))
    # Two bits of unequal min-hashes agree by chance one time in four; three standard deviations are allowed for.
    expected = _HASHES * 0.75 * (1 - percent / 100)
    links = sides.where(differ <= expected + 3 * expected**0.5).select("a", "b")
    return components(links).toDF("c1", "copies")
