"""Files as message streams, for replay and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def stream_text(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream of ``value`` texts, one per line of the files that appear in ``path``."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """A stream over Parquet files; ``path`` is a folder or a glob, not one file."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
