"""Helpers for nested lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_array(dtype: T.ArrayType) -> Column:
    return F.array().cast(dtype)


def or_empty(value, dtype: T.ArrayType) -> Column:
    """A list column with null replaced by the empty list."""
    items = F.col(value) if isinstance(value, str) else value
    return F.coalesce(items, empty_array(dtype))


def map_array(value, fn: Callable[[Column], Column]) -> Column:
    """Apply a column expression to every element of a list."""
    return F.transform(F.col(value) if isinstance(value, str) else value, fn)


def ordered_list(item: Column, *order: Column) -> Column:
    """Collect ``item`` of each group into a list in a reproducible order.

    The sort keys travel in front of the item, so equal keys fall back to the item itself. Rows
    whose item is null are left out.
    """
    names = [f"k{i}" for i in range(len(order))]
    entry = F.struct(*[key.alias(name) for key, name in zip(order, names)], item.alias("item"))
    return F.sort_array(F.collect_list(F.when(item.isNotNull(), entry)))["item"]
