"""Filters and keys: sampling lines, keeping thread posts, finding a post's thread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import string_hash
from threadloom.schemas import ANSWER, QUESTION


def sample_lines(lines: DataFrame, modulus: int = 100, column: str = "value") -> DataFrame:
    """The repeatable sample of lines whose hash is a multiple of ``modulus``."""
    return lines.where(string_hash(column) % modulus == 0)


def is_question() -> Column:
    return F.col("pos_type_id") == QUESTION


def is_answer() -> Column:
    return F.col("pos_type_id") == ANSWER


def thread_posts(posts: DataFrame) -> DataFrame:
    """Keep questions and answers."""
    return posts.where(F.col("pos_type_id").isin(QUESTION, ANSWER))


def thread_key() -> Column:
    """A question's own id, an answer's parent; null for other posts."""
    return F.when(is_question(), F.col("id")).when(is_answer(), F.col("parent_id"))


def with_thread_key(posts: DataFrame, key: Column | None = None) -> DataFrame:
    """Thread posts with their ``thread_key``; posts without one are left to the quality
    channels, which keeps a null key from forming one huge group."""
    routed = thread_posts(posts)
    keyed = routed.withColumn("thread_key", thread_key() if key is None else key)
    return keyed.where(F.col("thread_key").isNotNull())
