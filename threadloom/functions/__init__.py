"""Column expressions."""

from threadloom.functions.arrays import empty_array, map_array, ordered_list, or_empty
from threadloom.functions.casts import to_bigint, to_int
from threadloom.functions.hashing import string_hash
from threadloom.functions.timestamps import format_iso, parse_iso

__all__ = [
    "empty_array",
    "format_iso",
    "map_array",
    "or_empty",
    "ordered_list",
    "parse_iso",
    "string_hash",
    "to_bigint",
    "to_int",
]
