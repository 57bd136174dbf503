"""Near copies among embeddings, by randomly rotated binary codes.

A unit vector ``x`` is rotated by a random orthogonal matrix and kept as the
signs of its coordinates, ``s / sqrt(d)``, with the correction factor
``f = <s / sqrt(d), x>``. For another rotated unit vector ``y``,
``<s / sqrt(d), y> / f`` is an unbiased estimate of ``<x, y>``, off by more than
``z * sqrt((1 - f^2) / f^2 / (d - 1))`` only with a probability that falls
exponentially in ``z^2``. Pairs whose bound reaches the threshold are computed
again, exactly.

Which pairs are looked at at all: signs of further rotations form the keys of
several hash tables, enough of them for the stated recall at the threshold.
Cells above ``block`` vectors are compared in blocks, so no task holds more
than two blocks. Equal vectors are one class and are compared once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .graph import components


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def tables_for(vectors: int, threshold: float, recall: float, block: int) -> tuple[int, int]:
    """Bits per key, so that a cell of evenly spread vectors fits a block, and the number of tables for the recall."""
    bits = max(2, math.ceil(math.log2(max(vectors, 1) / block))) if vectors > block else 2
    hit = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit)))


def _keys(unit: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Keys of all tables, from the signs under as many rotations as they need."""
    dims, need = unit.shape[1], bits * tables
    signs = [unit @ rotation(dims, seed + 1 + k) > 0 for k in range(-(-need // dims))]
    flat = np.concatenate(signs, axis=1)[:, :need].reshape(len(unit), tables, bits)
    return flat @ (1 << np.arange(bits, dtype=np.int64))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _compare(x: np.ndarray, y: np.ndarray, threshold: float, z: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of x and y with a cosine of at least the threshold."""
    dims = x.shape[1]
    turn = rotation(dims, seed)
    ux, uy = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    rx, ry = ux @ turn, uy @ turn
    code = np.where(rx > 0, 1.0, -1.0).astype(np.float32) / np.float32(math.sqrt(dims))
    factor = (code * rx).sum(axis=1)
    estimate = (code @ ry.astype(np.float32).T) / factor[:, None]
    margin = z * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(dims - 1, 1)) + 1e-5
    i, j = np.nonzero(estimate + margin[:, None] >= threshold)
    good = np.empty(len(i), bool)
    for low in range(0, len(i), 1 << 16):
        part = slice(low, low + (1 << 16))
        dot = np.einsum("ij,ij->i", x[i[part]], y[j[part]])
        norm = np.sqrt(np.einsum("ij,ij->i", x[i[part]], x[i[part]])) * np.sqrt(np.einsum("ij,ij->i", y[j[part]], y[j[part]]))
        good[part] = dot / norm >= threshold
    return i[good], j[good]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_copies(vectors: DataFrame, threshold: float = 0.98, recall: float = 0.999, z: float = 4.0, block: int = 512, seed: int = 5,
                vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """Links between vectors of equal, non-null label whose cosine is at least ``threshold``.

    Returns vec_id, n_links (other vectors linked directly), component_id
    (smallest vec_id reachable) and kept (vec_id = component_id), one row per
    row. A vector that is null, empty, zero, or holds a null or non-finite
    component links with nothing and is kept, as one with a null label; vectors
    of different length do not link. Repeated rows are linked copies. Other
    columns are not read; an empty table gives an empty result.
    """
    v = F.col("v")
    fine = F.col("label").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.select("vec_id", "label", "v", F.coalesce(fine, F.lit(False)).alias("fine"), F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2"))
    same = ["label", "h1", "h2"]
    classes = rows.where("fine").groupBy(*same).agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
    classes = settle(classes.withColumn("class", F.monotonically_increasing_id()))

    most = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    bits, tables = tables_for(most, threshold, recall, block)
    linked = settle(_linked(classes, bits, tables, threshold, z, block, seed))
    counts = linked.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("class").alias("a"), F.col("root").alias("b"))).toDF("class", "root")
    known = classes.drop("v").join(counts, "class", "left").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    known = settle(known.join(known.groupBy("root").agg(F.min("first_id").alias("component_id")), "root"))
    out = rows.drop("v").join(known.select(*same, "copies", "links", "component_id", F.lit(True).alias("fine")), [*same, "fine"], "left")
    component = F.when(F.col("fine"), F.col("component_id")).otherwise(F.col("vec_id"))
    links = F.when(F.col("fine"), F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0))
    return out.select("vec_id", links.cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _linked(classes: DataFrame, bits: int, tables: int, threshold: float, z: float, block: int, seed: int) -> DataFrame:
    """Per class and block it met links in: how many vectors they lead to, and one class it is connected with."""

    def keyed(batches):
        for batch in batches:
            size = np.asarray(batch.column("v").value_lengths())
            keys = np.zeros((batch.num_rows, tables), np.int64)
            for dims in np.unique(size):
                rows = np.flatnonzero(size == dims)
                x = _matrix(batch.column("v").take(pa.array(rows)))
                keys[rows] = _keys(x / np.linalg.norm(x, axis=1, keepdims=True), bits, tables, seed)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * tables), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("class", "copies", "label", "v")), lists], ["class", "copies", "label", "v", "keys"])

    kind = classes.schema["label"].dataType.simpleString()
    coded = classes.select("class", "copies", "label", "v").mapInArrow(keyed, f"class bigint, copies bigint, label {kind}, v array<double>, keys array<bigint>")
    entries = coded.select("class", "copies", "label", "v", "keys", F.size("v").alias("dims"), F.posexplode("keys").alias("t", "key"))
    cell = ["label", "dims", "t", "key"]
    entries = settle(entries)
    sizes = settle(entries.groupBy(*cell).agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    entries = entries.join(sizes, cell).withColumn("parts", F.ceil(F.col("m") / block).cast("int"))
    own = F.pmod(F.xxhash64(F.lit(3), "class"), F.col("parts")).cast("int")
    entries = entries.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    entries = entries.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        own, i, j = group["own"].to_numpy(), group["i"][0].as_py(), group["j"][0].as_py()
        t = group["t"][0].as_py()
        left = np.flatnonzero(own == i)
        right = left if i == j else np.flatnonzero(own == j)
        x, keys = _matrix(group["v"]), _matrix(group["keys"])
        a, b = _compare(x[left], x[right], threshold, z, seed)
        a, b = left[a], right[b]
        if i == j:
            a, b = a[a < b], b[a < b]
        # A pair that an earlier table brings together is counted there.
        new = ~(keys[a, :t] == keys[b, :t]).any(axis=1)
        a, b = a[new], b[new]
        copies, names = group["copies"].to_numpy(), group["class"].to_numpy()
        n = len(names)
        links = np.zeros(n, np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        met = np.flatnonzero(links)
        root = _roots(n, a, b)
        return pa.table({"class": names[met], "links": links[met], "root": names[root[met]]})

    wanted = entries.select("class", "copies", "v", "keys", *cell, "own", "i", "j")
    return wanted.groupBy(*cell, "i", "j").applyInArrow(compare, "class bigint, links bigint, root bigint")
