"""Splitting groups that are too large for one task or one nested row.

A group is measured first, from its key column alone: that aggregation combines before its
shuffle, so one huge key costs no more than any other. Only keys above the limit are split, each
into as many numbered parts as it needs; every other key has the single part 0. Nothing is left
out. Results come in parts only where the caller gave the limit; otherwise parts are put together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.schemas import ROW_ID
from threadloom.session import scratch_dir
from threadloom.sources import with_row_id

# Posts of one thread that a task lists, where the caller gave no limit: changes the plan only.
MAX_GROUP = 10_000

# Key tables within both bounds are broadcast; larger ones are joined through a shuffle.
MAX_BROADCAST_KEYS = 100_000
MAX_BROADCAST_BYTES = 16 * 1024 * 1024


@dataclass(frozen=True)
class Splits:
    """The keys to split: ``table`` has ``split_key``, ``parts`` and the carried columns."""

    table: DataFrame


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it from there, so that plans using it do not
    compute it again."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class KeyTable:
    """A counted key table. ``table`` is marked for broadcast when it is ``small``."""

    table: DataFrame
    n: int
    small: bool


def bounded(keys: DataFrame, *, rare: bool = True) -> KeyTable:
    """Count a key table; store it if it has rows, and mark it for broadcast if it is small.

    A ``rare`` table is usually empty, so that is checked before it is stored. The key is the
    first column; any others are plain numbers.
    """
    if rare and keys.count() == 0:
        return KeyTable(keys, 0, True)
    stored = store(keys, "keys")
    key_bytes = F.sum(F.octet_length(F.col(keys.columns[0]).cast("string")))
    n, nbytes = stored.agg(F.count("*"), key_bytes).first()
    small = n <= MAX_BROADCAST_KEYS and (nbytes or 0) <= MAX_BROADCAST_BYTES
    return KeyTable(F.broadcast(stored) if small else stored, n, small)


def measure(
    weights: DataFrame,
    key: str,
    weight: str,
    max_group: int = MAX_GROUP,
    *,
    rows: str | None = None,
    carry: tuple[str, ...] = (),
) -> Splits | None:
    """Find the keys whose weight is above the limit; None when there are none.

    ``weights`` has one row per key. A key with more than the limit of ``rows`` is in the table
    too, but only the weight decides the number of parts. ``carry`` names further columns to
    keep with each key.
    """
    parts = F.ceil(F.greatest(F.col(weight), F.lit(1)) / max_group).cast("int").alias("parts")
    size = F.greatest(weight, rows) if rows else F.col(weight)
    heavy = weights.where(F.col(key).isNotNull() & (size > max_group))
    found = bounded(heavy.select(F.col(key).alias("split_key"), parts, *carry))
    return Splits(found.table) if found.n else None


def measure_groups(df: DataFrame, key: str, max_group: int = MAX_GROUP) -> Splits | None:
    """:func:`measure` with the number of rows as the weight."""
    return measure(df.groupBy(key).agg(F.count("*").alias("n")), key, "n", max_group)


def with_parts(df: DataFrame, key: str, splits: Splits | None, name: str) -> DataFrame:
    """Add the number of parts of each row's group, 1 for groups that are not split, and the
    carried columns, null for those."""
    if splits is None:
        return df.withColumn(name, F.lit(1))
    table = splits.table.withColumnRenamed("parts", name)
    joined = df.join(table, df[key] == table["split_key"], "left").drop("split_key")
    return joined.withColumn(name, F.coalesce(name, F.lit(1)))


def _has_positions(df: DataFrame) -> bool:
    """Whether the table's rows come from files and have places in them."""
    try:
        return "row_index" in df.select("_metadata.row_index").columns
    except AnalysisException:
        return False


def numbered(df: DataFrame) -> DataFrame:
    """Add what tells the rows of one group apart: each row's place in its Parquet file.

    That depends on stored data alone, so a retried task repeats it, and exact copies of a row
    differ. A table that is not a plain Parquet scan is first stored in the shared folder.
    """
    if ROW_ID in df.columns:
        return df
    if _has_positions(df):
        return with_row_id(df)
    return with_row_id(store(df, "numbered"))


def part_of(parts: Column, *row: Column) -> Column:
    """The part a row goes to."""
    return F.when(parts == 1, 0).otherwise(F.pmod(F.xxhash64(*row), parts).cast("int"))


def divide(df: DataFrame, key: str, splits: Splits | None, name: str) -> tuple[DataFrame, list]:
    """Add each row's part number, and give the columns to group by.

    Without splits the key alone groups, so that the grouped rows can be joined on it where they
    are.
    """
    if splits is None:
        return df.withColumn(name, F.lit(0)), [key]
    sized = with_parts(numbered(df), key, splits, "_parts")
    parted = sized.withColumn(name, part_of(F.col("_parts"), F.col(ROW_ID)))
    return (parted if ROW_ID in df.columns else parted.drop(ROW_ID)), [key, name]


def part_count(splits: Splits | None) -> list[Column]:
    """What to aggregate for :func:`with_part_count`."""
    return [] if splits is None else [F.max("_parts").alias("n_parts")]


def with_part_count(grouped: DataFrame, splits: Splits | None) -> DataFrame:
    """Grouped rows with ``n_parts``, the number of parts of their key."""
    return grouped if splits is not None else grouped.withColumn("n_parts", F.lit(1))


def group_divided(divided: tuple[DataFrame, list], name: str, *aggregates: Column) -> DataFrame:
    """Collect divided rows into lists; the part number is 0 where nothing was split.

    The rows are shuffled as they are: collecting before the shuffle as well would only sort and
    copy them once more, since lists do not shrink.
    """
    df, keys = divided
    grouped = df.repartition(*keys).groupBy(*keys).agg(*aggregates)
    return grouped if name in keys else grouped.withColumn(name, F.lit(0))


def keep_keys(df: DataFrame, key: str, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``key`` is (``left_semi``) or is not (``left_anti``) in the table ``keys``.

    ``keys`` has one column without repeats. A small one is broadcast, so the rows stay where
    they are; otherwise both sides are shuffled and adaptive execution splits a hot key's rows.
    """
    name = keys.columns[0]
    table = bounded(keys.withColumnRenamed(name, "_keep_key"), rare=False).table
    return df.join(table, df[key] == table["_keep_key"], how)
