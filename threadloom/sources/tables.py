"""Reading stored Parquet back with the fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.schemas import ROW_ID, entity
from threadloom.generations import current_path


def with_row_id(df: DataFrame) -> DataFrame:
    """Number the stored rows of a Parquet scan by file and position."""
    return df.withColumn(ROW_ID, F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def read_table(
    spark: SparkSession,
    base: str | None,
    name: str,
    *,
    database: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """Read a table of entity ``name`` below ``base``, or from the catalog's ``database``."""
    if database is not None:
        return spark.table(f"{database}.{table or name}")
    path = current_path(spark, base, table or name)
    return spark.read.schema(entity(name).schema).parquet(path)
