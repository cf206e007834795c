"""Data-quality channels: what a run drops or overrides, as tables and as counts.

Counting reads keys, types and what orders the copies of a post, never a body, except that copies
of a post with equal dates are told apart by a hash of the whole row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.comments import missing_post_keys
from threadloom.operators.duplicates import first_posts, repeated_ids
from threadloom.operators.routing import is_question, thread_key, with_thread_key
from threadloom.operators.threads import missing_question_keys
from threadloom.schemas import ANSWER, QUESTION


ROUTING_COUNTS = ["unsupported_type", "null_key_posts"]


def _in_threads() -> Column:
    return F.coalesce(F.col("pos_type_id").isin(QUESTION, ANSWER), F.lit(False))


def _among(condition: Column, among: Column | None) -> Column:
    return condition if among is None else among & condition


def unsupported_posts(posts: DataFrame) -> DataFrame:
    """Posts of a type, or without a type, that no thread takes in."""
    return posts.where(~_in_threads())


def null_key_posts(posts: DataFrame) -> DataFrame:
    """Posts that cannot be keyed: no id, no type, or an answer without a parent."""
    return posts.where(_null_key())


def _null_key() -> Column:
    keyless = _in_threads() & thread_key().isNull()
    return F.col("id").isNull() | F.col("pos_type_id").isNull() | keyless


def null_key_comments(comments: DataFrame) -> DataFrame:
    """Comments that name no post."""
    return comments.where(F.col("post_id").isNull())


def require_keys(posts: DataFrame, among: Column | None = None) -> DataFrame:
    """Strict mode: the posts unchanged, but a post that cannot be keyed fails the job. ``among``
    tells the rows to look at, all by default."""
    which = F.coalesce("id", F.lit("no id"))
    complaint = F.raise_error(F.concat(F.lit("post without key or type: "), which))
    return posts.where(F.when(_among(_null_key(), among), complaint.cast("boolean")).otherwise(True))


def require_comment_keys(comments: DataFrame, among: Column | None = None) -> DataFrame:
    """Strict mode: the comments unchanged, but a comment that names no post fails the job; see
    :func:`require_keys`."""
    which = F.coalesce("id", F.lit("no id"))
    complaint = F.raise_error(F.concat(F.lit("comment without post: "), which))
    no_post = _among(F.col("post_id").isNull(), among)
    return comments.where(F.when(no_post, complaint.cast("boolean")).otherwise(True))


def multi_question_keys(posts: DataFrame, key: Column | None = None) -> DataFrame:
    """Thread keys with more than one question, with the number of questions."""
    questions = with_thread_key(posts, key).where(is_question())
    counts = questions.groupBy("thread_key").agg(F.count("*").alias("n_questions"))
    return counts.where("n_questions > 1")


def routing_counts(among: Column | None = None) -> list[Column]:
    """Row-level counts for ``DataFrame.observe`` on posts, of those that ``among`` tells."""
    return [
        F.count_if(_among(~_in_threads(), among)).alias("unsupported_type"),
        F.count_if(_among(_null_key(), among)).alias("null_key_posts"),
    ]


def quality_counts(
    posts: DataFrame, comments: DataFrame | None = None, *, dedupe: bool = True
) -> DataFrame:
    """All channels counted: columns ``channel`` and ``n``. ``dedupe`` counts threads after the
    first post of each id was chosen, as the job with comments does."""
    keys = ["id", "pos_type_id", "parent_id"]
    # kept, since two channels use it
    threaded = first_posts(posts, columns=keys, keep=True) if dedupe else posts
    channels = {
        "duplicate_post": repeated_ids(posts),
        "multi_question": multi_question_keys(threaded),
        "missing_question": missing_question_keys(threaded),
    }
    if comments is not None:
        channels["missing_post"] = missing_post_keys(posts, comments)
        channels["null_key_comments"] = null_key_comments(comments)
    counts = [posts.agg(*routing_counts()).unpivot([], ROUTING_COUNTS, "channel", "n")]
    for channel, table in channels.items():
        counts.append(table.agg(F.lit(channel).alias("channel"), F.count("*").alias("n")))
    return reduce(DataFrame.unionByName, counts)
