"""XML record scan: ``<row .../>`` elements whose attributes are the fields.

The scan splits a file at ``<row`` and parses each piece on its own, so several tasks share a file
and its layout does not matter; the built-in XML file reader would give a whole file to one task.
A parser given text that is not exactly one row can return part of it without complaint, so its
shape is checked first: a raw ``<`` cannot occur inside an attribute, hence a pattern decides.
Files known to hold one row per line can be split at line breaks instead.

The text before a file's first ``<row`` is its head. It is legal once per file; a further piece
that looks like one is what is left of a broken row, and counts as rejected.

Attributes are read as text and converted afterwards: typed attributes would let one bad value
fail the whole scan.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import empty_array, parse_iso, to_bigint, to_int
from threadloom.schemas import COMMENT_LIST, entity
from threadloom.sources.text import read_lines

# The dumps' own names: the elements around the rows, and the rows.
ROOTS = "posts|comments"
RECORD = "row"


def _patterns(root: str, record: str) -> dict[str, str]:
    """Text that is one whole row; lines around rows; the same for text between two ``<row``."""
    xml = r"<\?xml[^<]*\?>"
    return {
        "row": rf"^\s*<{record}(\s[^<]*)?(/>|></{record}>)\s*$",
        "wrapper": rf"^\uFEFF?\s*({xml}|</?(?:{root})(\s[^<>]*)?>)?\s*$",
        "head": rf"^\uFEFF?\s*({xml})?\s*(<(?:{root})(\s[^<>]*)?>)?\s*$",
        "root": rf"^<(?:{root})(\s[^<>]*)?>\s*$",
        "tail": rf"\s*</(?:{root})>\s*$",
    }


CORRUPT = "_corrupt_record"
XML_OPTIONS = {
    "attributePrefix": "",
    "ignoreSurroundingSpaces": "false",
    "columnNameOfCorruptRecord": CORRUPT,
}


def _attribute_schema(name: str, alias_editor: bool) -> T.StructType:
    attributes = dict.fromkeys(a for _, a in _bindings(name, alias_editor))
    return T.StructType([T.StructField(a, T.StringType()) for a in (*attributes, CORRUPT)])


def _bindings(name: str, alias_editor: bool) -> list[tuple[str, str]]:
    """Column and attribute pairs; with ``alias_editor`` the editor's id also fills the owner's
    display name."""
    return [
        (column, "LastEditorUserId" if alias_editor and column == "owner_display_name" else attr)
        for column, attr, _ in entity(name).fields
    ]


def _lines(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    lines = read_lines(spark, path).where(~F.col("value").rlike(patterns["wrapper"]))
    return lines.select("value", F.lit(False).alias("is_head"), F.lit("").alias("file"))


def _elements(
    spark: SparkSession, path: str, patterns: dict[str, str], root: str, record: str
) -> DataFrame:
    between = read_lines(spark, path, separator=f"<{record}")
    value = F.col("value")
    # plain searches spare most pieces the patterns: a head has a tag or is blank, a tail is a tag
    is_head = (value.contains("<") | ~value.contains("=")) & value.rlike(patterns["head"])
    body = F.when(value.contains("</"), F.regexp_replace("value", patterns["tail"], "")).otherwise(value)
    pieces = between.select(
        F.concat(F.lit(f"<{record}"), body).alias("value"),
        is_head.alias("is_head"),
        F.col("_metadata.file_path").alias("file"),
    )
    if re.fullmatch(r"[\w|]+", root) and not any(n.startswith(record) for n in root.split("|")):
        return pieces
    # a root whose name begins like a row's
    return pieces.where(~F.col("value").rlike(patterns["root"]))


def scan_rows(
    spark: SparkSession,
    path: str,
    name: str,
    *,
    one_row_per_line: bool = False,
    root: str = ROOTS,
    record: str = RECORD,
    strict: bool = False,
    alias_editor: bool = False,
) -> DataFrame:
    """Scan XML files of posts or comments.

    Returns ``line``, ``reason`` (null for a good row, else ``layout``, ``corrupt`` or ``head``),
    ``file`` and ``record``, a struct of attribute texts. A ``head`` is no row: one of each file is
    legal, see :func:`rejects`. Several rows may share a line and a row may span lines, unless
    ``one_row_per_line``. ``root`` and ``record`` name the elements. With ``strict`` a bad row
    fails the scan.
    """
    value, patterns = F.col("value"), _patterns(root, record)
    if one_row_per_line:
        lines = _lines(spark, path, patterns)
    else:
        lines = _elements(spark, path, patterns, root, record)
    is_row = value.rlike(patterns["row"])
    bad_line = F.raise_error(F.concat(F.lit("not one XML row: "), value)) if strict else F.lit(None)
    options = {**XML_OPTIONS, "rowTag": record, "mode": "FAILFAST" if strict else "PERMISSIVE"}
    schema = _attribute_schema(name, alias_editor)
    text = F.when(is_row, value).when(~F.col("is_head"), bad_line.cast("string"))
    parsed = F.from_xml(text, schema, options)
    # stack() keeps the parser to one call per line: a filter on its result stays above it
    once = lines.select(
        value.alias("line"),
        "file",
        "is_head",
        is_row.alias("is_row"),
        F.stack(F.lit(1), parsed).alias("record"),
    )
    reason = (
        F.when(F.col("is_head"), "head")
        .when(~F.col("is_row"), "layout")
        .when(F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull(), "corrupt")
    )
    return once.select("line", reason.alias("reason"), "file", "record")


def is_rejected() -> Column:
    return F.col("reason").isin("layout", "corrupt")


def head_counts() -> list[Column]:
    """For ``DataFrame.observe`` on a scan: heads, and files that have one."""
    is_head = F.col("reason") == "head"
    files = F.collect_set(F.when(is_head, F.col("file")))
    return [F.count_if(is_head).alias("heads"), F.size(files).alias("headed_files")]


def rejects(scan: DataFrame) -> DataFrame:
    """The lines of a scan that are not good rows, with the reason; of the heads of one file, all
    but one. What a job put aside (``sinks.stage_scan``) does for the scan."""
    bad = scan.where(is_rejected()).select("line", "reason")
    heads = scan.where("reason = 'head'").groupBy("file").agg(
        F.min("line").alias("line"), (F.count("*") - 1).cast("int").alias("extra")
    )
    broken = heads.where("extra > 0").select(
        F.explode(F.array_repeat(F.regexp_replace("line", r"\s+$", ""), F.col("extra"))).alias("line"),
        F.lit("layout").alias("reason"),
    )
    return bad.unionByName(broken)


def _convert(text: Column, dtype: T.DataType, strict: bool) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return parse_iso(text, strict)
    if isinstance(dtype, T.IntegerType):
        return to_int(text, strict)
    if isinstance(dtype, T.LongType):
        return to_bigint(text, strict)
    return text


def type_records(
    scan: DataFrame, name: str, *, strict: bool = False, alias_editor: bool = False
) -> DataFrame:
    """Convert a scan's attribute texts to the entity's columns.

    Adds ``bad_values``, the number of texts that could not be converted and became null, and
    keeps ``line``, ``reason`` and ``file``.
    """
    types = {column: dtype for column, _, dtype in entity(name).fields}
    texts, columns = [], []
    for column, attribute in _bindings(name, alias_editor):
        text = F.col(f"record.{attribute}")
        texts.append((text, column))
        columns.append(_convert(text, types[column], strict).alias(column))
    if name == "post":
        columns.append(empty_array(COMMENT_LIST).alias("comments"))
    typed = scan.select("line", "reason", "file", "record", *columns)
    lost = [
        (text.isNotNull() & F.col(column).isNull()).cast("int")
        for text, column in texts
        if not isinstance(types[column], T.StringType)
    ]
    kept = [column for column in typed.columns if column != "record"]
    return typed.select(*kept, reduce(add, lost).alias("bad_values"))


def accepted(typed: DataFrame) -> DataFrame:
    """The good rows of typed records, without the bookkeeping columns."""
    return typed.where(F.col("reason").isNull()).drop("line", "reason", "file", "bad_values")
