"""Exact top-k by inner product, reading sorted lists from the top without random access.

Per block of vectors each dimension is a list sorted by its component; a query
reads a list from the end that raises its score. After a depth, what has been
read of a vector counts as it is, and what has not lies between the end of the
list and the last value read: a lower and an upper bound of its score. Vectors
whose upper bound is below the k-th lower bound cannot qualify and go; reading
stops when no more than k are left or a quarter of a list is unread, and the
scores of those left are worked out in full.

Blocks are independent, so any number of vectors is spread over the cluster.
Some blocks are searched first, one in ``sample``: the k-th score there is a
bound that vectors of all other blocks have to reach, so those send almost
nothing on.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

DEPTHS = (0.125, 0.25, 0.5, 0.75)
_EXACT = 1 << 53
_LONG = (1 << 63) - 1
_FOUND = pa.schema([("entry", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("times", pa.int64())])


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """The vectors as rows; missing components at the end are zeros."""
    column = column.combine_chunks()
    sizes, flat = np.asarray(column.value_lengths()), np.asarray(column.flatten(), np.float64)
    if len(flat) == len(sizes) * dims and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def bounds(queries: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, up_to: np.ndarray, down_to: np.ndarray):
    """Lower and upper bounds of all scores, when lists are read down to ``down_to`` from the top and up to ``up_to`` from the bottom."""
    above, below = np.maximum(queries, 0), np.minimum(queries, 0)
    top, bottom = vectors >= down_to, vectors <= up_to
    lower = above @ np.where(top, vectors, low).T + below @ np.where(bottom, vectors, high).T
    upper = above @ np.where(top, vectors, down_to).T + below @ np.where(bottom, vectors, up_to).T
    return lower, upper


def search(queries: np.ndarray, own: np.ndarray, least: np.ndarray, vectors: np.ndarray, lists: np.ndarray, k: int) -> np.ndarray:
    """Of each query's row: which vectors may be among its k best (a mask).

    ``own`` (a mask) takes no part, ``least`` is a score that has to be reached.
    ``lists`` are the components of each dimension in ascending order.
    """
    n = len(vectors)
    low, high = lists[0], lists[-1]
    left, alive = np.arange(n), ~own
    for depth in DEPTHS:
        t = max(int(n * depth), 1)
        lower, upper = bounds(queries, vectors[left], low, high, lists[t - 1], lists[n - t])
        if len(left) >= k:
            lower[~alive[:, left]] = -np.inf
            least = np.maximum(least, np.partition(lower, len(left) - k, axis=1)[:, len(left) - k])
        alive[:, left] &= upper >= least[:, None]
        left = left[alive[:, left].any(axis=0)]
        if len(left) <= k:
            break
    return alive


def exact(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Scores as whole numbers of any size."""
    whole = np.frompyfunc(int, 1, 1)
    return whole(queries) @ whole(vectors).T if queries.shape[1] else np.zeros((len(queries), len(vectors)), object)


def _cell(asked: pa.Table, block: pa.Table, k: int, together: int) -> pa.Table:
    """The k best vectors of a block for each query, ties to smaller ids."""
    dims = max(pc.max(pc.list_value_length(t["v"])).as_py() for t in (asked, block))
    block = block.sort_by([("vec_id", "ascending")])  # nulls last
    q, v = matrix(asked["v"], dims), matrix(block["v"], dims)
    entries, copies, mine = block["entry"].to_numpy(), block["copies"].to_numpy(), asked["entry"].to_numpy()
    least = np.nan_to_num(asked["least"].to_numpy().astype(np.float64), nan=-np.inf)
    # Products of larger components could leave the whole numbers that doubles hold.
    most = math.isqrt(_EXACT // max(dims, 1))
    huge_q, huge_v = np.abs(q).max(axis=1, initial=0) > most, np.abs(v).max(axis=1, initial=0) > most
    small = np.flatnonzero(~huge_v)
    lists = np.sort(v[small], axis=0)
    at, found, score = [], [], []
    for rows in np.split(np.arange(len(q)), range(together, len(q), together)):
        may = ~((mine[rows, None] == entries) & (copies == 1))
        plain = np.flatnonzero(~huge_q[rows])
        if len(small) and len(plain) and dims:
            may[np.ix_(plain, small)] = search(q[rows[plain]], ~may[np.ix_(plain, small)], least[rows[plain]], v[small], lists, k)
        left = np.flatnonzero(may.any(axis=0))
        huge = huge_q[rows].any() or huge_v[left].any()
        full = exact(q[rows], v[left]).clip(-_LONG - 1, _LONG) if huge else q[rows] @ v[left].T
        for row, here, values in zip(rows.tolist(), may[:, left], full):
            cells = np.flatnonzero(here)
            best = cells[np.argsort(-values[cells], kind="stable")[:k]]
            at += [row] * len(best)
            found += left[best].tolist()
            score += map(int, values[best])
    at, found = np.array(at, np.int64), np.array(found, np.int64)
    times = np.minimum(copies[found] - (entries[found] == mine[at]), k)
    columns = [pa.array(mine[at]), block["vec_id"].take(pa.array(found)).combine_chunks(), pa.array(score, pa.int64()), pa.array(times)]
    return pa.Table.from_arrays(columns, schema=_FOUND)


def quantised(vectors: DataFrame, vec_id: str, vector: str, unit: float) -> DataFrame:
    """Rows (entry, vec_id, v, copies): distinct rows with components floor(unit * x), written once.

    Vectors that are null or have null or non-finite components are left out,
    as are those with a component too large for a double after scaling.
    """
    cells = F.transform(F.col(vector), lambda x: x.cast("double") * unit)
    scaled = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), cells.alias("v"))
    fine = scaled.where(F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")), F.lit(False))))
    # Whole numbers of any size, as doubles hold them: beyond 2^53 every double is whole.
    whole = F.transform("v", lambda x: F.when(F.abs(x) < float(_EXACT), F.floor(x).cast("double")).otherwise(x))
    distinct = fine.select("vec_id", whole.alias("v")).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies"))
    return settle(distinct.select(F.monotonically_increasing_id().alias("entry"), "vec_id", "v", "copies"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", unit: float = 1024.0,
          values: int = 1 << 20, asked: int = 8192, sample: int = 32, together: int = 64) -> DataFrame:
    """For each row that ``is_query`` (a condition on ``vec_id``): the k other rows of highest inner product.

    Rows (query_id, rank, vec_id, score), rank from 1, ties to smaller vec_id
    (null last). Components are taken as floor(unit * x); scores are whole and
    exact, those beyond a long count as the nearest long. Vectors that are null or hold null or
    non-finite components take no part. Vectors of unlike length are compared
    as if zeros followed the shorter one. Repeated rows are queries and
    candidates each; a row is not its own candidate, its repetitions are. A query
    alone in its table gets no rows; an empty table gives none. A cell of work
    is a block of about ``values`` components and about ``asked`` queries.
    """
    entries = quantised(vectors, vec_id, vector, unit)
    queries = settle(entries.where(is_query).withColumn("at", F.xxhash64(F.lit(5), "entry")))
    n, dims = entries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    blocks, parts = -(-n * max(dims, 1) // values) or 1, -(-queries.count() // asked) or 1
    placed = entries.withColumn("block", F.pmod(F.xxhash64(F.lit(6), "entry"), F.lit(blocks)).cast("int"))
    queries = queries.withColumn("part", F.pmod("at", F.lit(parts)).cast("int"))

    def found(candidates: DataFrame, asking: DataFrame, numbers: Column) -> DataFrame:
        def cell(left: pa.Table, right: pa.Table) -> pa.Table:
            return _cell(left, right, k, together) if left.num_rows and right.num_rows else _FOUND.empty_table()

        left = asking.select("entry", "v", "least", "part", F.explode(numbers).alias("block"))
        right = candidates.select("entry", "vec_id", "v", "copies", "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        cells = left.groupBy("part", "block").cogroup(right.groupBy("part", "block"))
        return cells.applyInArrow(cell, "entry bigint, vec_id bigint, score bigint, times bigint")

    def best(rows: DataFrame) -> DataFrame:
        single = rows.select("entry", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
        order = Window.partitionBy("entry").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        return single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = F.sequence(F.lit(0), F.lit(blocks - 1), F.lit(sample))
    early = settle(best(found(placed.where(F.col("block") % sample == 0), queries.withColumn("least", F.lit(None).cast("bigint")), first)).drop("rank", "copy"))
    reached = early.groupBy("entry").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    others = F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b % sample != 0)
    late = found(placed.where(F.col("block") % sample != 0), queries.join(reached, "entry", "left"), others)
    ranked = best(late.unionByName(early.withColumn("times", F.lit(1).cast("bigint"))))
    who = queries.select("entry", F.col("vec_id").alias("query_id"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_"))
    return ranked.join(who, "entry").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

