"""Projections to table rows, in the tables' column order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import empty_array, or_empty
from threadloom.schemas import (
    COMMENT_COLUMNS,
    COMMENT_LIST,
    POST_LIST,
    POST_SCALARS,
)


def post_row(posts: DataFrame) -> DataFrame:
    """The 23 columns of the ``post`` table; posts that were never joined have no comments."""
    has_list = "comments" in posts.columns
    comments = or_empty("comments", COMMENT_LIST) if has_list else empty_array(COMMENT_LIST)
    return posts.select(*POST_SCALARS, comments.alias("comments"))


def comment_row(comments: DataFrame) -> DataFrame:
    """The 7 columns of the ``comment`` table."""
    return comments.select(*COMMENT_COLUMNS)


def thread_row(threads: DataFrame) -> DataFrame:
    """The 2 columns of the ``thread`` table."""
    return threads.select("question", or_empty("answers", POST_LIST).alias("answers"))


def comment_struct() -> Column:
    return F.struct(*COMMENT_COLUMNS)


def post_struct(comments: Column) -> Column:
    return F.struct(*POST_SCALARS, comments.alias("comments"))
