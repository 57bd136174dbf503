"""Text and delimited files, as tables or as file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One row per line. A stream needs a folder or a glob, not a bare file."""
    return (spark.readStream if stream else spark.read).text(path)


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket; for trying things out, since a socket cannot be read again."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ",",
    line_sep: str | None = None, stream: bool = False, files_per_batch: int | None = None,
) -> DataFrame:
    """Typed rows of headerless delimited files; a malformed line fails the job."""
    reader = (spark.readStream if stream else spark.read).schema(schema)
    reader = reader.option("sep", sep).option("mode", "FAILFAST")
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def read_table(
    spark: SparkSession, path: str, schema: str | None = None, stream: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files; a stream needs the schema."""
    if not stream:
        return spark.read.parquet(path)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def declare_file_table(spark: SparkSession, name: str, schema: str, path: str, sep: str = ",") -> None:
    """A temporary SQL table over delimited files."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW `{name}` ({schema}) USING csv "
        f"OPTIONS (path '{path}', sep '{sep}', mode 'FAILFAST')"
    )
