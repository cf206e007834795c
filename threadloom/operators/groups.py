"""Grouping rows by key, and co-grouping several tables on one key."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import ordered_list
from threadloom.operators.listing import Listed, whole_lists
from threadloom.operators.skew import (
    divide,
    group_divided,
    measure,
    measure_groups,
    numbered,
    part_count,
    with_part_count,
)
from threadloom.schemas import ROW_ID


def group_by_key(
    df: DataFrame, key: str, order: list[Column] | None = None, max_group: int | None = None
) -> DataFrame:
    """All rows of each key as a list of structs: columns ``key``, ``part``, ``n_parts`` and
    ``items``.

    A key is one row, part 0 of 1; a large one is listed by several tasks. With ``max_group``, a key
    with more rows comes in parts.
    """
    kept = df.where(F.col(key).isNotNull())
    values = [c for c in df.columns if c != ROW_ID]
    if max_group is None:
        listed = Listed(F.struct(*values), tuple(order or []))
        whole = whole_lists(kept.select(*values), key, {"items": listed})
        return whole.select(key, F.lit(0).alias("part"), F.lit(1).alias("n_parts"), "items")
    splits = measure_groups(kept, key, max_group)
    divided = divide(kept, key, splits, "part")
    items = ordered_list(F.struct(*values), *(order or []))
    grouped = group_divided(divided, "part", items.alias("items"), *part_count(splits))
    return with_part_count(grouped, splits).select(key, "part", "n_parts", "items")


def co_group(
    tables: Mapping[str, tuple[DataFrame, str]], max_group: int | None = None
) -> DataFrame:
    """Group several tables on a shared key: one list per table for every key of any of them.

    ``tables`` maps an output name to a DataFrame and its key column. The tables are stacked and
    grouped once, so all of them meet in a single shuffle and no join is needed. Columns:
    ``key``, ``part``, ``n_parts`` and one list per table, empty where the table lacks the key. A
    key is one row, part 0 of 1, and a large one is listed by several tasks; with ``max_group``, a
    key with more rows comes in parts.
    """
    kept = {n: (df.where(F.col(k).isNotNull()), k) for n, (df, k) in tables.items()}
    if max_group is None:
        both = _stacked(kept)
        whole = whole_lists(both, "key", {name: Listed(F.col(name)) for name in tables})
        return whole.select("key", F.lit(0).alias("part"), F.lit(1).alias("n_parts"), *tables)
    keys = reduce(DataFrame.union, [df.select(F.col(k).alias("key")) for df, k in kept.values()])
    counts = keys.groupBy("key").agg(F.count("*").alias("n"))
    splits = measure(counts, "key", "n", max_group)
    both = _stacked({n: (numbered(df) if splits else df, k) for n, (df, k) in kept.items()})
    lists = [ordered_list(F.col(name)).alias(name) for name in tables]
    divided = divide(both, "key", splits, "part")
    groups = group_divided(divided, "part", *lists, *part_count(splits))
    return with_part_count(groups, splits).select("key", "part", "n_parts", *tables)


def _stacked(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """All rows with their ``key``, each as a struct in the column named after its table."""
    stacked = []
    for name, (df, key) in tables.items():
        values = [c for c in df.columns if c != ROW_ID]
        row_id = [ROW_ID] if ROW_ID in df.columns else []
        stacked.append(df.select(F.col(key).alias("key"), F.struct(*values).alias(name), *row_id))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
