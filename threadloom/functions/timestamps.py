"""Zone-less date-times: ISO text in, wall clock (TIMESTAMP_NTZ) inside, ISO text out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed format: local date-time with optional seconds and fraction, optionally closed by Z.
# Other offsets are refused; a bare cast would accept them and silently drop the offset.
ISO_PATTERN = r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{1,9})?)?Z?$"


def parse_iso(value, strict: bool = False) -> Column:
    """ISO date-time text to TIMESTAMP_NTZ. Bad text is null, or an error when ``strict``."""
    text = F.col(value) if isinstance(value, str) else value
    parsed = F.when(text.rlike(ISO_PATTERN), F.rtrim(text, F.lit("Z")).try_cast("timestamp_ntz"))
    if not strict:
        return parsed
    complaint = F.raise_error(F.concat(F.lit("not an ISO date-time: "), text))
    return F.when(text.isNotNull() & parsed.isNull(), complaint).otherwise(parsed)


def format_iso(value) -> Column:
    """TIMESTAMP_NTZ to ISO local date-time text with the shortest fraction; null stays null."""
    text = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
