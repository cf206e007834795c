"""Text to integer. Bad text is null, or an error when ``strict``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _integer(value, dtype: str, strict: bool) -> Column:
    text = F.col(value) if isinstance(value, str) else value
    parsed = text.try_cast(dtype)
    if not strict:
        return parsed
    complaint = F.raise_error(F.concat(F.lit(f"not a valid {dtype}: "), text))
    return F.when(text.isNotNull() & parsed.isNull(), complaint).otherwise(parsed)


def to_int(value, strict: bool = False) -> Column:
    return _integer(value, "int", strict)


def to_bigint(value, strict: bool = False) -> Column:
    return _integer(value, "bigint", strict)
