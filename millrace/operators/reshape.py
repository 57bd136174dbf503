"""Row-wise operators: map, flat map, filter, side outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_words(df: DataFrame, column: str = "value", sep: str = " ") -> DataFrame:
    """One row per word of ``column``."""
    return df.select(F.explode(F.split(F.col(column), sep)).alias("word"))


def composite_key(*columns: Column | str, sep: str = "-") -> Column:
    """Several columns as one string key, such as ``province-ad``."""
    return F.concat_ws(sep, *[F.col(c) if isinstance(c, str) else c for c in columns])


def tag_rows(df: DataFrame, rules: dict[str, Column], rest: str = "main") -> DataFrame:
    """Name the output each row belongs to: the first rule that holds."""
    tag = F.lit(None).cast("string")
    for name, rule in reversed(rules.items()):
        tag = F.when(rule, F.lit(name)).otherwise(tag)
    return df.withColumn("tag", F.coalesce(tag, F.lit(rest)))


def side_output(tagged: DataFrame, name: str) -> DataFrame:
    """One of the outputs named by ``tag_rows``."""
    return tagged.where(F.col("tag") == name).drop("tag")


def map_with_resource(
    df: DataFrame,
    schema: str,
    open_resource: Callable[[], Any],
    apply: Callable[[Any, pd.DataFrame], pd.DataFrame],
    close_resource: Callable[[Any], None] = lambda _: None,
) -> DataFrame:
    """Map batches of rows with something set up once per task.

    Only for work that needs a client or a model; a plain projection belongs
    in ``select``. Rows arrive as Arrow batches, never as a whole partition.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_resource()
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            close_resource(resource)

    return df.mapInPandas(task, schema)
