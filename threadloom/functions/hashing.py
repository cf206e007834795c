"""The 32-bit polynomial string hash: h = 31 * h + unit over UTF-16 units, signed wrap-around.

Spark has no built-in for it. Folding over ``split(text, '')`` gives the same numbers but boxes
every character; measured on 25 MB of text it was several times slower than one Arrow batch pass.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Send the code of this module along with the function, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Inverse of 31 modulo 2**32: lets one running sum serve every string of a batch.
_INVERSE_31 = pow(31, -1, 2**32)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, dtype=np.uint32)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint32)


def hash_batch(strings: pa.Array) -> pa.Array:
    """Hash every string of an Arrow array; null stays null."""
    text = strings.cast(pa.large_string()).fill_null("")
    _, offsets, data = text.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    utf8 = np.frombuffer(data or b"", dtype=np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    if utf8.size and utf8.max() > 0x7F:
        units = np.frombuffer(utf8.tobytes().decode("utf-8").encode("utf-16-le"), dtype=np.uint16)
        # one unit for each character start, one more for each character beyond U+FFFF
        widths = ((utf8 & 0xC0) != 0x80).astype(np.int64) + (utf8 >= 0xF0)
        ends = np.concatenate(([0], np.cumsum(widths)))[ends]
    else:
        units = utf8
    weighted = units.astype(np.uint32) * _powers(_INVERSE_31, units.size)[:-1]
    running = np.concatenate((np.zeros(1, np.uint32), np.cumsum(weighted, dtype=np.uint32)))
    sums = running[ends[1:]] - running[ends[:-1]]
    hashes = sums * _powers(31, units.size)[np.maximum(ends[1:] - 1, 0)]
    return pa.array(hashes.view(np.int32), mask=np.asarray(strings.is_null()))


def string_hash(value):
    """The signed 32-bit hash of a string column."""

    def hash_strings(strings: pa.Array) -> pa.Array:
        return hash_batch(strings)

    return F.arrow_udf(hash_strings, IntegerType())(value)
