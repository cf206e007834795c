"""Replacing a table with fixed schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import format_iso
from threadloom.schemas import entity
from threadloom.generations import Generation, generation


# What is kept of a piece that is no good row.
ASIDE = T.StructType([T.StructField(c, T.StringType()) for c in ("line", "reason", "file")])


def conform(df: DataFrame, name: str, among: Column | None = None) -> DataFrame:
    """The entity's columns in table order and type; a null in a required one fails the write, of
    rows that ``among`` tells, of all by default."""
    return df.select(*_conformed(name, among))


def _conformed(name: str, among: Column | None = None) -> list[Column]:
    spec = entity(name)
    columns = []
    for field in spec.schema.fields:
        value = F.col(field.name)
        if field.name in spec.required:
            complaint = F.raise_error(F.lit(f"{name}.{field.name} is required"))
            lacking = value.isNull() if among is None else among & value.isNull()
            value = F.when(lacking, complaint).otherwise(value)
        columns.append(value.cast(field.dataType).alias(field.name))
    return columns


def missing_required(df: DataFrame, name: str) -> DataFrame:
    """The rows that :func:`conform` would refuse."""
    return df.where(reduce(or_, [F.col(f).isNull() for f in entity(name).required], F.lit(False)))


def write_table(
    df: DataFrame,
    name: str,
    base: str | None = None,
    *,
    database: str | None = None,
    table: str | None = None,
    check: Callable[[], None] | None = None,
) -> None:
    """Replace a table with rows of entity ``name``: Parquet below ``base``, or a catalog table of
    ``database``. It is called like the entity unless ``table`` names it.

    The old table stays readable until the new one is complete and ``check``, if given, has not
    raised; the change to the new one is a single step, see :mod:`threadloom.generations`.
    """
    with generation(df.sparkSession, base, database=database) as new:
        stage_table(new, df, name, table=table, check=check)


def stage_table(
    new: Generation,
    df: DataFrame,
    name: str,
    *,
    table: str | None = None,
    check: Callable[[], None] | None = None,
) -> None:
    """:func:`write_table` into a generation, to be shown with its other tables."""
    new.stage(conform(df, name), table or name, name, check)


def stage_scan(
    new: Generation, typed: DataFrame, name: str, *, check: Callable[[], None] | None = None
) -> None:
    """:func:`stage_table` for the good rows of a typed scan. All other pieces are put aside by the
    same write, as ``line``, ``reason`` and ``file``, so that no file is parsed again for them."""
    good = F.col("reason").isNull()
    kept = [F.when(~good, F.col(c)).alias(c) for c in ASIDE.names]
    rows = typed.select(*_conformed(name, good), *kept)
    new.stage(rows, name, name, check, aside=ASIDE)


def stage_rejects(new: Generation, rejected: DataFrame, name: str) -> None:
    """Put the entity's table of rejected lines into a generation. Below a path it is copied to the
    plain folder ``<name>_rejects`` as well, for reading without this package."""
    new.stage(rejected, f"{name}_rejects")
    new.publish(f"{name}_rejects")


def write_rejects(
    rejected: DataFrame, name: str, base: str | None = None, *, database: str | None = None
) -> None:
    """Replace the entity's table of rejected lines."""
    with generation(rejected.sparkSession, base, database=database) as new:
        stage_rejects(new, rejected, name)


def _with_text_dates(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return format_iso(value)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: _with_text_dates(item, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [_with_text_dates(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def export_json(df: DataFrame, name: str, path: str) -> None:
    """Write table rows as JSON lines with ISO date texts and explicit nulls."""
    spec = entity(name)
    fields = [_with_text_dates(F.col(f.name), f.dataType).alias(f.name) for f in spec.schema.fields]
    writer = conform(df, name).select(*fields).write.mode("overwrite")
    writer.option("ignoreNullFields", "false").json(path)
