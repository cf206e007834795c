"""What the operators share: cutting lineage, word rules and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.session import scratch_dir

# Rows turned into Python values at a time: bounds a worker's memory, changes no result.
SLICE_ROWS = 256


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back.

    It cuts the lineage: a lost executor costs a re-read, not another computation. Parquet takes
    less room than the rows ``checkpoint()`` writes and is computed once.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores behind it as no column of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def map_batches(
    df: DataFrame,
    task: Callable[[Iterator[list[list]]], Iterator[tuple]],
    schema: str,
) -> DataFrame:
    """Run ``task`` over the columns of Arrow batches, each as a list of Python values.

    ``task`` sees one iterator for each Spark partition, so it can keep state between batches. It
    yields tuples of equally long columns, in the order of ``schema``.
    """
    names, types = fields(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (
            [c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns]
            for batch in batches
            for at in range(0, batch.num_rows, SLICE_ROWS)
        )
        for out in task(columns):
            arrays = [
                a if isinstance(a, pa.Array) else pa.array(a, t)
                for a, t in zip(out, types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def fields(spark: SparkSession, schema: str) -> tuple[list[str], list[pa.DataType]]:
    """Names and Arrow types of a schema text."""
    from pyspark.sql.pandas.types import to_arrow_type

    parsed = T._parse_datatype_string(schema)
    return parsed.names, [to_arrow_type(f.dataType) for f in parsed.fields]


def words(text: str) -> list[bytes]:
    """Words of a text as UTF-8: only A-Z is lower-cased, only ASCII white space separates."""
    return text.encode().lower().split()


def part_number() -> int:
    """The number of the Spark partition a task works on."""
    from pyspark import TaskContext

    return TaskContext.get().partitionId()
