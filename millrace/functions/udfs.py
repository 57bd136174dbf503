"""User functions: scalar, table, aggregate and table-aggregate."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pandas.core.groupby import DataFrameGroupBy
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def register(spark: SparkSession) -> None:
    """Make the functions below callable by name from SQL."""

    @F.pandas_udf("int")
    def str_len(text: pd.Series) -> pd.Series:
        return text.str.len().astype("Int32")

    spark.udf.register("str_len", str_len)
    functions = {"split_words": split_words, "avg_parts": average_parts, "avg_of_parts": average_of_parts, "top2_parts": top2_parts, "top2": top2}
    for name, make in functions.items():
        spark.udtf.register(name, make())


# Table functions take and give whole Arrow batches. An aggregate comes as two of
# them: the first takes any table where its rows lie and gives accumulators, one
# per key and task at best; the second merges those, partitioned by key. So SQL
# hands over all rows, and no key's rows come together.


def split_words():
    """Table function over (text, sep): one row (text, word) per part of each text."""

    @F.arrow_udtf(returnType="text string, word string")
    class SplitWords:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            for sep in batch.column("sep").unique().drop_null().to_pylist():
                text = batch.filter(pc.equal(batch.column("sep"), sep)).column("text")
                parts = pc.split_pattern(text, sep)
                yield pa.table({"text": text.take(pc.list_parent_indices(parts)), "word": pc.list_flatten(parts)})

    return SplitWords


def average_parts(held_keys: int = 100_000):
    """First half of a mean over (key, value): sums and counts of the rows at hand."""

    @F.arrow_udtf(returnType="key string, total double, n bigint")
    class AverageParts:
        def __init__(self):
            self.held = None

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            found = pa.Table.from_batches([batch]).group_by("key").aggregate([("value", "sum"), ("value", "count")])
            part = found.select(["key", "value_sum", "value_count"]).rename_columns(["key", "total", "n"])
            if self.held is not None:
                both = pa.concat_tables([self.held, part]).group_by("key").aggregate([("total", "sum"), ("n", "sum")])
                part = both.select(["key", "total_sum", "n_sum"]).rename_columns(["key", "total", "n"])
            self.held = part
            if part.num_rows > held_keys:
                self.held = None
                yield part

        def terminate(self) -> Iterator[pa.Table]:
            if self.held is not None:
                yield self.held

    return AverageParts


def average_of_parts():
    """Second half: the mean of one key's accumulators; null when nothing was added."""

    @F.arrow_udtf(returnType="key string, average double")
    class AverageOfParts:
        def __init__(self):
            self.key, self.total, self.n = None, 0.0, 0

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            self.key = batch.column("key").slice(0, 1)
            self.total += pc.sum(batch.column("total")).as_py() or 0.0
            self.n += pc.sum(batch.column("n")).as_py() or 0
            return iter(())

        def terminate(self) -> Iterator[pa.Table]:
            if self.key is not None:
                yield pa.table({"key": self.key, "average": pa.array([self.total / self.n if self.n else None], pa.float64())})

    return AverageOfParts


def _largest(rows: pa.Table, most: int) -> tuple[pa.Table, np.ndarray]:
    """Of (user_id, vc) the ``most`` largest vc of each user, and their places from 1; nulls go, NaN is largest."""
    rows = rows.filter(pc.is_valid(rows["vc"])).combine_chunks()
    codes = np.asarray(pc.fill_null(pc.index_in(rows["user_id"], pc.unique(rows["user_id"])), -1))
    vc = rows["vc"].to_numpy()
    order = np.lexsort((-np.nan_to_num(vc, nan=0.0, posinf=np.inf, neginf=-np.inf), ~np.isnan(vc), codes))
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=-2))
    place = np.arange(len(codes)) - np.repeat(first, np.diff(first, append=len(codes)))
    return rows.take(pa.array(order[place < most])), place[place < most] + 1


def top2_parts(held_keys: int = 100_000):
    """First half of a table aggregate over (user_id, vc): each user's two largest vc among the rows at hand."""

    @F.arrow_udtf(returnType="user_id bigint, vc double")
    class Top2Parts:
        def __init__(self):
            self.held = None

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            new = pa.Table.from_batches([batch]).select(["user_id", "vc"])
            self.held = _largest(new if self.held is None else pa.concat_tables([self.held, new]), 2)[0]
            if self.held.num_rows > 2 * held_keys:
                full, self.held = self.held, None
                yield full

        def terminate(self) -> Iterator[pa.Table]:
            if self.held is not None:
                yield self.held

    return Top2Parts


def top2():
    """Second half, over one user's (user_id, vc): the two largest with their ranks."""

    @F.arrow_udtf(returnType="user_id bigint, vc double, rank string")
    class Top2:
        def __init__(self):
            self.held = None

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            new = pa.Table.from_batches([batch]).select(["user_id", "vc"])
            self.held = _largest(new if self.held is None else pa.concat_tables([self.held, new]), 2)[0]
            return iter(())

        def terminate(self) -> Iterator[pa.Table]:
            if self.held is not None:
                best, place = _largest(self.held, 2)
                yield best.append_column("rank", pa.array(place.astype(str), pa.string()))

    return Top2


class UserAggregate:
    """An aggregate a user writes in Python, in parts that Spark can spread.

    ``accumulate`` turns grouped rows into one accumulator per key, ``merge``
    grouped accumulators into one per key, and ``result`` a frame of
    accumulators into values. ``state`` is the accumulator's schema text. All
    three work on whole batches of keys at once.
    """

    state: str
    returns: str

    def accumulate(self, groups: DataFrameGroupBy) -> pd.DataFrame:
        raise NotImplementedError

    def merge(self, groups: DataFrameGroupBy) -> pd.DataFrame:
        raise NotImplementedError

    def result(self, accumulators: pd.DataFrame) -> pd.Series:
        raise NotImplementedError


class Average(UserAggregate):
    """The mean as (sum, count); null when nothing was added."""

    state = "total double, n bigint"
    returns = "double"

    def __init__(self, column: str):
        self.column = column

    def accumulate(self, groups):
        return groups[self.column].agg(total="sum", n="count")

    def merge(self, groups):
        return groups[["total", "n"]].sum()

    def result(self, accumulators):
        return accumulators["total"] / accumulators["n"].where(accumulators["n"] > 0)


def user_aggregate(
    df: DataFrame, keys: Sequence[str], fn: UserAggregate, name: str, columns: Sequence[str],
    held_keys: int = 100_000,
) -> DataFrame:
    """Apply a Python aggregate without bringing a key's rows to one task.

    Rows are folded where they lie, so the shuffle carries about one
    accumulator per key and task. After it, accumulators come sorted by key and
    are merged batch by batch; only the last key of a batch is held over.
    """
    keys = list(keys)
    state = T.StructType.fromDDL(fn.state)
    key_fields = [df.schema[k] for k in keys]
    partial_schema = T.StructType([*key_fields, *state.fields])
    out_schema = T.StructType([*key_fields, T.StructField(name, T._parse_datatype_string(fn.returns))])

    def grouped(pdf: pd.DataFrame) -> DataFrameGroupBy:
        return pdf.groupby(keys, dropna=False, sort=False)

    def merged(parts: list[pd.DataFrame]) -> pd.DataFrame:
        return fn.merge(grouped(pd.concat(parts, ignore_index=True))).reset_index()

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            new = fn.accumulate(grouped(batch)).reset_index()
            held = new if held is None else merged([held, new])
            if len(held) > held_keys:
                yield held
                held = None
        if held is not None:
            yield held

    def finish(accumulators: pd.DataFrame) -> pd.DataFrame:
        return accumulators[keys].assign(**{name: fn.result(accumulators)})

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key = None
        for batch in batches:
            done = merged([batch] if open_key is None else [open_key, batch])
            open_key = done.tail(1)
            yield finish(done.iloc[:-1])
        if open_key is not None:
            yield finish(open_key)

    partial = df.select(*keys, *columns).mapInPandas(fold, partial_schema)
    by_key = partial.repartition(*keys).sortWithinPartitions(*keys)
    return by_key.mapInPandas(join, out_schema)
