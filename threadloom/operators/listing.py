"""Whole lists of very large groups, made by many tasks.

A group's list is one value and so ends in one row, but no task has to sort it: a large group is cut
at values of its own order, each stretch is listed by a task of its own, and the lists are put one
after the other. Groups are weighed first, by rows and by bytes. The cuts come from a random sample
and change the plan only: whatever they are, the lists in order make the sorted list.

Exact copies of a row cannot be told apart by order, so in large groups they are counted before they
are shuffled and repeated in the list.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import ordered_list
from threadloom.operators.skew import MAX_GROUP, KeyTable, bounded, store

# A stretch holds about so many bytes at most, or MAX_GROUP rows; a group has so many stretches.
PART_BYTES = 64 * 1024 * 1024
MAX_PARTS = 256
SAMPLES_PER_PART = 32

# Spark's rows hold less than 2 GiB.
ROW_BYTES = 2**31 - 2**27

# A longer text is not used for cuts but for its beginning.
LONG_TEXT = 256


class GroupTooLarge(ValueError):
    """A group that no row can hold."""


def bytes_of(value: Column, dtype: T.DataType) -> Column:
    """About the bytes a value takes: exact for texts, 8 for numbers and dates."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value).cast("long"), F.lit(0).cast("long"))
    if isinstance(dtype, T.StructType):
        fields = [bytes_of(value[f.name], f.dataType) for f in dtype.fields]
        return sum(fields, F.lit(8).cast("long"))
    if isinstance(dtype, T.ArrayType):
        add = lambda n, item: n + bytes_of(item, dtype.elementType)
        return F.coalesce(F.aggregate(value, F.lit(0).cast("long"), add), F.lit(0).cast("long"))
    return F.lit(8).cast("long")


def row_bytes(df: DataFrame) -> Column:
    """:func:`bytes_of` a whole row."""
    fields = [bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return sum(fields, F.lit(0).cast("long"))


def refuse_too_large(sizes: DataFrame, key: str, nbytes: str) -> None:
    """Fail, before Spark does without saying why, when a group is too large for one row."""
    worst = sizes.agg(F.max(F.struct(nbytes, key)).alias("worst")).first()["worst"]
    if worst is not None and (worst[nbytes] or 0) > ROW_BYTES:
        raise GroupTooLarge(
            f"the group of {key} {worst[key]!r} has {worst[nbytes]} bytes, more than one row can hold; "
            "give max_group to get it in parts"
        )


def cuts_of(samples: Column, parts: Column) -> Column:
    """Values that cut a sorted sample into ``parts`` stretches of about equal size."""
    n_cuts = F.least(parts, F.lit(MAX_PARTS)) - 1
    place = lambda j: (F.floor(j * F.size(samples) / (n_cuts + 1)) + 1).cast("int")
    chosen = F.transform(F.sequence(F.lit(1), n_cuts), lambda j: F.get(samples, place(j) - 1))
    return F.when((n_cuts > 0) & (F.size(samples) > 0), F.array_distinct(chosen))


def stretch_of(cuts: Column, value: Column) -> Column:
    """The stretch a value is in: how many cuts are below it."""
    # as a variable the value is made once, not for every cut
    below = F.transform(F.array(value), lambda v: F.size(F.filter(cuts, lambda cut: cut < v)))
    return F.coalesce(F.when(cuts.isNotNull(), below[0]), F.lit(0))


def sampled(df: DataFrame, parts: Column, rows: Column) -> DataFrame:
    """About :data:`SAMPLES_PER_PART` rows for each part of a group of so many rows."""
    return df.where(F.rand(7) * rows < SAMPLES_PER_PART * F.least(parts, F.lit(MAX_PARTS)))


@dataclass(frozen=True)
class Listed:
    """One list to make: ``item`` in the order of ``order``, then of the item itself. A row whose
    item is null is not in it."""

    item: Column
    order: tuple[Column, ...] = ()


def _entry(listed: Listed) -> Column:
    keys = [column.alias(f"k{i}") for i, column in enumerate(listed.order)]
    return F.when(listed.item.isNotNull(), F.struct(*keys, listed.item.alias("item")))


def _leading(entry: Column, dtype: T.StructType, longest: Mapping[str, int]) -> Column:
    """What entries are cut by: their fields in order, up to the first long text, which is cut."""
    taken: list[Column] = []

    def take(value: Column, kind: T.DataType, path: str) -> bool:
        if isinstance(kind, T.StructType):
            return all(take(value[f.name], f.dataType, f"{path}.{f.name}") for f in kind.fields)
        if isinstance(kind, T.StringType):
            short = (longest.get(path) or 0) <= LONG_TEXT
            taken.append(value if short else F.substring(value, 1, LONG_TEXT))
            return short
        if isinstance(kind, (T.ArrayType, T.MapType, T.BinaryType)):
            return False
        taken.append(value)
        return True

    take(entry, dtype, "")
    named = [column.alias(f"c{i}") for i, column in enumerate(taken)]
    return F.struct(*named) if named else F.struct(F.lit(0).alias("c0"))


def _texts(dtype: T.StructType, path: str = "") -> list[str]:
    found = []
    for f in dtype.fields:
        if isinstance(f.dataType, T.StringType):
            found.append(f"{path}.{f.name}")
        elif isinstance(f.dataType, T.StructType):
            found += _texts(f.dataType, f"{path}.{f.name}")
    return found


def heavy_groups(df: DataFrame, key: str) -> KeyTable:
    """Keys with more rows or bytes than one task should list; see :func:`heavy_keys`."""
    sized = df.select(F.col(key), row_bytes(df).alias("nbytes"))
    sizes = sized.groupBy(key).agg(F.count("*").alias("rows"), F.sum("nbytes").alias("nbytes"))
    return heavy_keys(sizes, key)


def heavy_keys(sizes: DataFrame, key: str) -> KeyTable:
    """Of keys with their ``rows`` and ``nbytes``, those that several tasks should list: with
    ``parts``, ``rows`` and ``nbytes``."""
    large = sizes.where(
        F.col(key).isNotNull() & ((F.col("rows") > MAX_GROUP) | (F.col("nbytes") > PART_BYTES))
    )
    parts = F.greatest(F.ceil(F.col("rows") / MAX_GROUP), F.ceil(F.col("nbytes") / PART_BYTES))
    return bounded(
        large.select(F.col(key).alias("split_key"), parts.cast("int").alias("parts"), "rows", "nbytes")
    )


def _list_together(df: DataFrame, keys: list[str], lists: Mapping[str, Listed]) -> DataFrame:
    made = [ordered_list(x.item, *x.order).alias(name) for name, x in lists.items()]
    return df.repartition(*keys).groupBy(*keys).agg(*made)


def stretches(df: DataFrame, key: str, lists: Mapping[str, Listed], heavy: KeyTable) -> DataFrame:
    """The rows of large groups, copies counted, with the stretch they are in: ``split_key``,
    ``stretch``, an entry for each list and ``copies``."""
    entries = {name: f"_entry_{i}" for i, name in enumerate(lists)}
    hot = df.join(heavy.table, df[key] == heavy.table["split_key"]).select(
        "split_key", "parts", "rows", *[_entry(x).alias(entries[n]) for n, x in lists.items()]
    )
    kinds = {e: hot.schema[e].dataType for e in entries.values()}
    sample = store(sampled(hot, F.col("parts"), F.col("rows")), "sample")
    texts = [(e, path) for e, kind in kinds.items() for path in _texts(kind)]
    lengths = [F.max(F.octet_length(e + path)).alias(f"n{i}") for i, (e, path) in enumerate(texts)]
    found = sample.agg(F.lit(0), *lengths).first()
    longest: dict[str, dict[str, int]] = {e: {} for e in kinds}
    for i, (e, path) in enumerate(texts):
        longest[e][path] = found[f"n{i}"]
    leading = {e: _leading(F.col(e), kind, longest[e]) for e, kind in kinds.items()}

    samples = sample.groupBy("split_key", "parts").agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col(e).isNotNull(), leading[e]))).alias(e)
            for e in kinds
        ]
    )
    cuts = store(
        samples.select("split_key", *[cuts_of(F.col(e), F.col("parts")).alias(f"cuts{e}") for e in kinds]),
        "cuts",
    ).withColumnRenamed("split_key", "_cut_key")
    counted = hot.groupBy("split_key", *kinds).agg(F.count("*").alias("copies"))
    # Spark broadcasts the stored cuts if their files are small, else it splits the hot keys
    placed = counted.join(cuts, counted["split_key"] == cuts["_cut_key"], "left")
    # a row has an entry in one list, the others give 0
    places = [F.when(F.col(e).isNotNull(), stretch_of(F.col(f"cuts{e}"), leading[e])) for e in kinds]
    return placed.select("split_key", F.coalesce(*places, F.lit(0)).alias("stretch"), *kinds, "copies")


def whole_lists(
    df: DataFrame, key: str, lists: Mapping[str, Listed], heavy: KeyTable | None = None
) -> DataFrame:
    """``key`` and, for every name, its whole list; empty where the key has no such row.

    The same rows as one aggregation by key gives. Groups of more than ``MAX_GROUP`` rows or
    :data:`PART_BYTES` are listed in stretches; one that no row can hold is an error. A caller that
    has weighed the groups gives the ``heavy`` ones.
    """
    present = df.where(F.col(key).isNotNull())
    if heavy is None:
        heavy = heavy_groups(present, key)
    if heavy.n == 0:
        return _list_together(present, [key], lists)
    refuse_too_large(heavy.table, "split_key", "nbytes")
    cold = present.join(heavy.table, present[key] == heavy.table["split_key"], "left_anti")
    rows = stretches(present, key, lists, heavy)
    columns = rows.columns[2:-1]
    # a struct of an entry and its copies sorts like the entry
    made = [
        F.sort_array(F.collect_list(F.when(F.col(e).isNotNull(), F.struct(e, "copies")))).alias(e)
        for e in columns
    ]
    parts = rows.repartition("split_key", "stretch").groupBy("split_key", "stretch").agg(*made)

    def repeated(entries: Column, e: str) -> Column:
        """The items of a stretch; lists without copies are taken as they are."""
        copied = F.flatten(F.transform(entries, lambda x: F.array_repeat(x[e]["item"], x["copies"].cast("int"))))
        return F.when(F.forall(entries, lambda x: x["copies"] == 1), entries[e]["item"]).otherwise(copied)

    items = [repeated(F.col(e), e).alias(e) for e in columns]
    parts = parts.select("split_key", F.struct("stretch", *items).alias("part"))
    # the numbers of stretches differ, so sorting never looks at the lists
    joined = parts.groupBy("split_key").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    whole = joined.select(
        F.col("split_key").alias(key),
        *[
            F.flatten(F.col("parts")[e]).alias(name) for name, e in zip(lists, columns, strict=True)
        ],
    )
    return _list_together(cold, [key], lists).unionByName(whole)
