"""Quality of whole texts: naive Bayes support vectors over n-gram indicators.

Indicators say which n-grams of words and of word shapes (case, digits and
marks, letters left open) a text holds, and how often in powers of two. Each is
scaled by the log ratio of its counts in the two classes; a linear model with
hinge loss is fitted on these by dual coordinate descent, and its margins are
turned into probabilities on rows that the fit did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import first_by_hash
from .text import buffer_of, grams, mix, per_worker, pieces, words_of


def _kinds() -> np.ndarray:
    """Byte classes: a letter's case, digit, each mark by itself; bytes of other scripts as small letters."""
    kind = np.arange(256, dtype=np.uint8)
    kind[97:123] = 97
    kind[65:91] = 65
    kind[48:58] = 48
    kind[128:] = 97
    kind[[9, 10, 11, 12, 13]] = 32
    return kind


def indicators(column: pa.Array, buckets: int) -> list[np.ndarray]:
    """The distinct hashed indicators of each text, in ascending order."""
    raw, at = buffer_of(column)
    words = words_of(raw, at)
    shapes = _shapes(raw, at, words.starts)
    same = np.zeros(len(words.hashes), bool)
    same[1:] = words.hashes[1:] == words.hashes[:-1]
    out = []
    for row in range(len(at) - 1):
        low, high = words.first[row], words.first[row + 1]
        word, shape = words.hashes[low:high], shapes[low:high]
        again = np.flatnonzero(same[low + 1 : high]) if high > low else word
        found = [word, _tag(grams(word, 2), 1)] + [_tag(grams(shape, k), 10 + k) for k in (1, 2, 3)]
        kinds, n = np.unique(shape, return_counts=True)
        found.append(_tag(kinds, 20, np.log2(n).astype(np.uint64)))
        if len(word):
            share = np.array([len(word), 16 * len(again) // len(word)], np.uint64)
            found.append(_tag(share[1:], 30))
            found.append(_tag(np.log2(share[:1]).astype(np.uint64), 31))
        out.append(np.unique(np.concatenate(found) % np.uint64(buckets)).astype(np.uint32))
    return out


def _tag(values: np.ndarray, kind: int, more: np.ndarray | None = None) -> np.ndarray:
    values = values * np.uint64(0x100000001B3) + np.uint64(kind)
    return mix(values if more is None else values + (more << np.uint64(8)))


def _shapes(raw: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each word's shape: its byte classes, runs of one class taken once."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    kind = per_worker("byte kinds", _kinds)[raw]
    keep = np.ones(len(raw), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[starts] = True
    keep[at[(at > 0) & (at < len(raw))]] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    return words_of(kind[keep], place[at], lower=False).hashes


@dataclass
class Model:
    weights: np.ndarray  # by bucket, whole numbers of 2**-32: sums do not depend on order
    slope: float
    shift: float


_UNIT = float(1 << 32)


def fit(features: list[np.ndarray], labels: np.ndarray, buckets: int, alpha: float = 1.0, cost: float = 1.0, blend: float = 0.5,
        rounds: int = 20, seed: int = 7) -> Model:
    """Fit on indicator lists and labels 0/1; the order of the rows does not matter if they are sorted beforehand.

    With one class only, or no rows, the model gives every text that class's
    smoothed share.
    """
    y = np.where(labels > 0, 1.0, -1.0)
    share = (np.sum(y > 0) + 1) / (len(y) + 2)
    if len(np.unique(y)) < 2:
        return Model(np.zeros(buckets, np.int64), 0.0, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    # Calibration rows of both classes, as even shares of each.
    held = np.zeros(len(y), bool)
    for side in (1.0, -1.0):
        rows = rng.permutation(np.flatnonzero(y == side))
        held[rows[: max(len(rows) // 5, 1)]] = True
    if len(np.unique(y[~held])) < 2:
        held[:] = False
    taken = [k for k in np.flatnonzero(~held)]
    # Naive Bayes: log ratio of the smoothed shares of each indicator in the classes.
    up, down = np.full(buckets, alpha), np.full(buckets, alpha)
    for k in taken:
        (up if y[k] > 0 else down)[features[k]] += 1
    ratio = np.log(up / up.sum()) - np.log(down / down.sum())
    # An indicator met once tells the rows apart without meaning anything.
    ratio[(up + down) < 2 * alpha + 2] = 0.0
    rows = [features[k][ratio[features[k]] != 0] for k in range(len(y))]
    values = [ratio[r] for r in rows]
    scale = [1 / max(np.sqrt(v @ v), 1e-12) for v in values]  # texts of all lengths weigh alike
    values = [v * s for v, s in zip(values, scale)]
    # Hinge loss, dual coordinate descent; the smaller class gets the higher cost.
    w, bias = np.zeros(buckets), 0.0
    dual = np.zeros(len(y))
    cost_of = {s: cost * len(taken) / (2 * np.sum(y[taken] == s)) for s in (1.0, -1.0)}
    norm = np.array([v @ v + 1 for v in values])
    for _ in range(rounds):
        change = 0.0
        for k in rng.permutation(taken):
            step = (1 - y[k] * (w[rows[k]] @ values[k] + bias)) / norm[k]
            new = min(max(dual[k] + step, 0.0), cost_of[y[k]])
            step = (new - dual[k]) * y[k]
            if step:
                w[rows[k]] += step * values[k]
                bias += step
                dual[k] = new
                change = max(change, abs(step))
        if change < 1e-3:
            break
    w = (1 - blend) * np.abs(w).sum() / max(np.count_nonzero(w), 1) * (w != 0) + blend * w if blend < 1 else w
    weights = np.round(w * ratio * _UNIT).astype(np.int64)
    judged = np.flatnonzero(held) if held.any() else np.array(taken)
    margins = np.array([margin(weights, features[k]) for k in judged])
    slope, shift = _logistic(margins, (y[judged] > 0).astype(float))
    return Model(weights, slope, shift)


def margin(weights: np.ndarray, found: np.ndarray) -> float:
    """Weighted sum over the indicators that carry weight, by the root of their number."""
    got = weights[found]
    return got.sum() / _UNIT / np.sqrt(max(np.count_nonzero(got), 1))


def _logistic(x: np.ndarray, t: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of the logistic curve through smoothed targets, by Newton steps."""
    t = np.where(t > 0, (t.sum() + 1) / (t.sum() + 2), 1 / (len(t) - t.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(p - t) @ x + 1e-3 * a, (p - t).sum()])
        v = p * (1 - p)
        h = np.array([[v @ (x * x) + 1e-3, v @ x], [v @ x, v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 0.0), float(b)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", per_class: int = 4000,
          buckets: int = 1 << 18) -> Model:
    """Learn from at most ``per_class`` whole labelled texts of each class (those whose key hashes lowest).

    ``labels`` has ``key`` and ``label`` (0 or 1; rows with a null in either are
    not learnt from; of several labels of one key the highest counts).
    Only the sample's indicator lists reach the driver, so its size is bounded.
    """
    marked = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    sample = first_by_hash(marked, "y", "key", per_class)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(sample), "key")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [f.tobytes() for f in indicators(batch.column("text"), buckets)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.binary())], ["y", "found"])

    got = sorted((r["y"], bytes(r["found"])) for r in rows.select("y", "text").mapInArrow(extract, "y int, found binary").toLocalIterator())
    return fit([np.frombuffer(f, np.uint32) for _, f in got], np.array([y for y, _ in got], int), buckets)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Probability of label 1 for every whole text, beside the columns of ``keep``.

    A null or empty text has no indicators and gets the curve's value at 0. A
    column already called score is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "score"]
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.slope, model.shift))  # plain: workers need no class
    rows = docs.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keep)], F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, slope, shift = shared.value
        for batch in pieces(batches, "text"):
            margins = np.array([margin(weights, f) for f in indicators(batch.column("text"), len(weights))])
            p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], [*keep, "score"])

    return rows.mapInArrow(run, docs.select(*keep).schema.add("score", "double"))
