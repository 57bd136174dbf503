"""Scalar expressions used by the jobs; all run inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_fields(line: Column | str, schema: str, sep: str = ",") -> Column:
    """A delimited line as a typed struct; a line that does not parse fails the job."""
    return F.from_csv(line, schema, {"sep": sep, "mode": "FAILFAST"})


def parse_json(text: Column | str, schema: str) -> Column:
    return F.from_json(text, schema, {"mode": "FAILFAST"})


def json_of(*columns: str) -> Column:
    """The named columns as one JSON object."""
    return F.to_json(F.struct(*columns))


def truncated_to_seconds(millis: Column | str) -> Column:
    """``to_timestamp(from_unixtime(ms / 1000))``: the time without its milliseconds."""
    return F.to_timestamp(F.from_unixtime(F.floor(F.col(millis) / 1000 if isinstance(millis, str) else millis / 1000)))


def pick(values: Sequence[str], index: Column) -> Column:
    """The value at ``index`` modulo the list's length."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))
