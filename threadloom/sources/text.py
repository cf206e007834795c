"""Line scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """One row per text line, in a ``value`` column. Large files are split among tasks.

    ``separator`` replaces the line breaks as what ends a record.
    """
    return spark.read.text(path, lineSep=separator)
