"""Language of whole texts: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and every run of other characters than letters becomes
one space, so n-grams lie within a word and its two edges. Counts per language
are summed in Spark; the matrix of log-probabilities (buckets x languages, whole
numbers, so that sums do not depend on their order) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .sampling import first_by_hash
from .text import per_worker, pieces

UNKNOWN = "und"
SIZES = (1, 2, 3)
_UNIT = 1 << 16  # log-probabilities are kept in steps of 1/65536
_SEGMENT = 1 << 20
_TOGETHER = 1 << 18  # characters of short texts looked at together


def _letters() -> np.ndarray:
    return per_worker("letters", lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def _segments(text: str) -> Iterator[str]:
    """A long text in parts, cut after a space if there is one near."""
    low = 0
    while len(text) - low > _SEGMENT:
        high = text.rfind(" ", low + _SEGMENT - 1000, low + _SEGMENT) + 1 or low + _SEGMENT
        yield text[low:high]
        low = high
    yield text[low:]


def ngrams(texts: list[str | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and bucket of every n-gram, in parts of bounded size."""
    rows: list[int] = []
    parts: list[str] = []
    held = 0
    for row, text in enumerate(texts):
        for part in _segments(text or ""):
            if held + len(part) > _TOGETHER and parts:
                yield _ngrams(rows, parts, buckets)
                rows, parts, held = [], [], 0
            rows.append(row)
            parts.append(part.lower())
            held += len(part)
    if parts:
        yield _ngrams(rows, parts, buckets)


def _ngrams(rows: list[int], parts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer((" " + " ".join(parts) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.array(rows), [len(p) + 1 for p in parts])
    row = np.append(row, rows[-1])
    solid = _letters()[np.minimum(code, 0x10FFFF)]
    keep = solid.copy()
    keep[0] = True
    keep[1:] |= solid[:-1]  # of a run of other characters only the first, as a space
    code, row, solid = np.where(solid, code, 32)[keep].astype(np.uint32), row[keep], solid[keep]
    found_rows, found = [], []
    for size in SIZES:
        n = len(code) - size + 1
        if n <= 0:
            continue
        good = np.ones(n, bool)
        for k in range(size if size == 1 else size - 1):
            if size == 1 or k > 0:
                good &= solid[k : k + n]
        if size == 2:
            good &= solid[:n] | solid[1 : n + 1]
        value = np.full(n, size, np.uint32)
        for k in range(size):
            value = value * np.uint32(0x01000193) ^ code[k : k + n]
            value ^= value >> np.uint32(15)
        value = value * np.uint32(0x85EBCA6B)
        value ^= value >> np.uint32(13)
        # An n-gram that begins at the space before a text belongs to that text.
        owner = np.where(solid[:n], row[:n], row[1 : n + 1] if size > 1 else row[:n])
        found_rows.append(owner[good])
        found.append(value[good] % np.uint32(buckets))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    return np.concatenate(found_rows), np.concatenate(found)


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # buckets x languages
    prior: np.ndarray


def train(docs: DataFrame, text: str, lang: str, key: str, per_language: int = 3000, buckets: int = 1 << 16, alpha: float = 0.1) -> Model:
    """Learn from at most ``per_language`` whole texts of each language (those whose key hashes lowest).

    Rows without language or key are not learnt from; a null or empty text has
    no n-grams. The priors count all rows given. Without any labelled row the
    model knows no language.
    """
    known = docs.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    sizes = {r["lang"]: r["n"] for r in known.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            names = batch.column("lang").dictionary_encode()
            of = np.asarray(names.indices).astype(np.int64)
            for rows, grams in ngrams(batch.column("text").to_pylist(), buckets):
                cell, n = np.unique(of[rows] * buckets + grams, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [names.dictionary.take(pa.array(cell // buckets)), pa.array((cell % buckets).astype(np.int32)), pa.array(n)],
                    ["lang", "bucket", "n"],
                )

    sample = first_by_hash(known, "lang", "key", per_language)
    counted = sample.select("lang", "text").mapInArrow(count, "lang string, bucket int, n bigint")
    got = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((buckets, len(languages)))
    place = {name: k for k, name in enumerate(languages)}
    counts[got["bucket"].to_numpy(), [place[x] for x in got["lang"].to_pylist()]] = got["n"].to_numpy()
    logs = np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * buckets)
    prior = np.log(np.array([sizes[x] for x in languages], float) / max(sum(sizes.values()), 1))
    return Model(languages, np.round(logs * _UNIT).astype(np.int32), np.round(prior * _UNIT).astype(np.int64))


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Language and its probability for every whole text, beside the columns of ``keep``.

    A null text, one without a letter, and any text under a model without
    languages is ``und`` with score 0. Columns already called as ``names``
    are replaced. Equal probabilities go to the language
    first by code point.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.logs, model.prior))  # plain: workers need no class
    kept = docs.select(*keep).schema
    columns = [F.col(c).alias(f"k{k}") for k, c in enumerate(keep)]
    # A text that is kept goes to the workers once.
    source = next((f"k{k}" for k, c in enumerate(keep) if c.lower() == text.lower() and kept[k].dataType == StringType()), "text")
    rows = docs.select(*columns, *([F.col(text).cast("string").alias("text")] if source == "text" else []))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, logs, prior = shared.value
        buckets, kinds = logs.shape
        for batch in pieces(batches, source):
            total, met = np.zeros((batch.num_rows, kinds), np.int64), np.zeros(batch.num_rows, np.int64)
            if kinds:
                for owner, grams in ngrams(batch.column(source).to_pylist(), buckets):
                    met += np.bincount(owner, minlength=batch.num_rows)
                    for k in range(kinds):
                        # exact: whole numbers far below 2**53
                        total[:, k] += np.bincount(owner, logs[grams, k], batch.num_rows).astype(np.int64)
            found, best = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if kinds:
                total += prior
                first = total.argmax(axis=1)
                top = total[np.arange(batch.num_rows), first]
                share = 1 / np.exp((total - top[:, None]) / _UNIT).sum(axis=1)
                found = [languages[k] if n else UNKNOWN for k, n in zip(first.tolist(), met.tolist())]
                best = np.where(met > 0, share, 0.0)
            columns = batch.columns[: len(keep)] + [pa.array(found, pa.string()), pa.array(best)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *names])

    return rows.mapInArrow(score, kept.add(names[0], "string").add(names[1], "double"))
