"""Dropping lines that many pages of one site share.

A line is boilerplate on a host when at least ``min_pages`` of its pages, and more than ``ratio``
of them, contain it. Pages are counted for each host and line key, which spreads a large host over
all tasks. A host has at most (its mean number of lines) / ``ratio`` such lines, because each is on
more than ``ratio`` of the pages; so one short list for each host goes back to the pages.

With ``distinct_pages`` copies of one page are one page, in the number of a host's pages and of those
with a line, so that a page's own lines don't become boilerplate by being copied. The query op7
counts every row, as its SQL does; the pipeline, which keeps one of the copies later, counts
distinct pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import cut, free_name, text_of

RATIO = 0.08
MIN_PAGES = 5


def line_key(line: Column) -> Column:
    """128 bits of the trimmed line."""
    trimmed = F.trim(line)
    return F.struct(
        F.xxhash64(trimmed).alias("a"), F.xxhash64(F.lit("line"), trimmed).alias("b")
    )


def page_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def is_line(line: Column) -> Column:
    """Blank lines are layout, not content: they are neither counted nor dropped."""
    return F.trim(line) != ""


def boilerplate(
    df: DataFrame,
    host: str,
    text: str,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct_pages: bool = False,
) -> DataFrame:
    """``host`` and ``keys``, the keys of the lines to drop there."""
    whole = text_of(text)
    keys = F.array_distinct(F.transform(F.filter(page_lines(whole), is_line), line_key))
    pages = df.select(F.col(host).alias("host"), keys.alias("keys"), line_key(whole).alias("page"))
    if distinct_pages:
        # the lines' keys are shuffled, not the texts
        pages = cut(pages.groupBy("host", "page").agg(F.first("keys").alias("keys")), "pages")
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = (
        pages.select("host", F.explode("keys").alias("key"))
        .groupBy("host", "key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages)
    )
    shared = counts.join(totals, counts["host"].eqNullSafe(totals["host"])).where(
        F.col("n") > F.lit(ratio) * F.col("pages")
    )
    return shared.groupBy(counts["host"]).agg(F.collect_list("key").alias("keys"))


def drop_lines(
    df: DataFrame,
    *,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct_pages: bool = False,
) -> DataFrame:
    """The rows with boilerplate lines taken out of ``text``; adds ``_dropped``, their number.

    Blank lines stay, and so do lines of hosts with fewer than ``min_pages`` pages. A null text
    stays null; a null host is a host of its own; a repeated row is a page of its own, or with
    ``distinct_pages`` the same page, whatever spaces are at the text's ends. Lines are compared
    without spaces at their ends. Other columns pass through; where one is called ``_dropped``
    itself, the number is ``_dropped_`` (``common.free_name``).
    """
    dropped_name, host_name, keys_name, kept_name = (
        free_name(n, df.columns) for n in ("_dropped", "_host", "_keys", "_kept")
    )
    # written first: Spark then knows its size, broadcasts it if small, else splits a hot host
    found = cut(boilerplate(df, host, text, ratio, min_pages, distinct_pages), "boilerplate").select(
        F.col("host").alias(host_name), F.col("keys").alias(keys_name)
    )
    joined = df.join(found, df[host].eqNullSafe(found[host_name]), "left")
    lines, keys = page_lines(F.col(text)), F.col(keys_name)

    def stays(line: Column) -> Column:
        return ~(is_line(line) & F.array_contains(keys, line_key(line)))

    kept = F.when(keys.isNull(), lines).otherwise(F.filter(lines, stays))
    out = joined.withColumn(kept_name, kept)
    dropped = F.coalesce(F.size(lines) - F.size(kept_name), F.lit(0)).cast("long")
    return out.withColumns(
        {dropped_name: dropped, text: F.array_join(kept_name, "\n")}
    ).drop(host_name, keys_name, kept_name)
