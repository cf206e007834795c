"""Joining comments to their posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions import or_empty, ordered_list
from threadloom.operators.listing import Listed, whole_lists
from threadloom.operators.rows import comment_struct
from threadloom.operators.skew import (
    KeyTable,
    Splits,
    divide,
    group_divided,
    keep_keys,
    measure,
    with_parts,
)
from threadloom.schemas import COMMENT_COLUMNS, COMMENT_LIST


# What a comment takes beside its text.
COMMENT_BYTES = 128


def comments_per_post(comments: DataFrame, *, weigh: bool = False) -> DataFrame:
    """``post_id`` and ``n_comments``, from the key column alone; with ``weigh``, which reads the
    texts but shuffles none, their ``comment_bytes`` too."""
    keyed = comments.where(F.col("post_id").isNotNull())
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + COMMENT_BYTES
    weights = [F.sum(size).alias("comment_bytes")] if weigh else []
    return keyed.groupBy("post_id").agg(F.count("*").alias("n_comments"), *weights)


def comment_lists(
    comments: DataFrame, splits: Splits | None, heavy: KeyTable | None = None
) -> DataFrame:
    """``post_id``, ``slice`` and the list of the slice's comments, oldest first.

    Without ``splits`` a post has one slice, which several tasks list if it is large; ``heavy`` are
    such posts, where they are known.
    """
    keyed = comments.where(F.col("post_id").isNotNull())
    order = F.col("creation_date"), F.col("id")
    if splits is None:
        slim = keyed.select(*COMMENT_COLUMNS)
        whole = whole_lists(slim, "post_id", {"comments": Listed(comment_struct(), order)}, heavy)
        return whole.withColumn("slice", F.lit(0))
    items = ordered_list(comment_struct(), *order)
    divided = divide(keyed, "post_id", splits, "slice")
    return group_divided(divided, "slice", items.alias("comments"))


def nest_comments(
    posts: DataFrame, comments: DataFrame, max_group: int | None = None
) -> DataFrame:
    """Posts with their comments as a list, empty when there are none.

    Ids must be unique (see ``first_posts``). Comments whose post is missing drop out. A post is
    one row. Adds ``slice`` and ``n_slices``, 0 and 1, except that with ``max_group`` a post with
    more comments comes as several rows, each with its slice of the comments.
    """
    counts = comments_per_post(comments)
    splits = None if max_group is None else measure(counts, "post_id", "n_comments", max_group)
    lists = comment_lists(comments, splits).withColumnRenamed("slice", "_slice")
    parents = posts.drop("comments").withColumns({"slice": F.lit(0), "_slices": F.lit(1)})
    match = parents["id"] == lists["post_id"]
    if splits is not None:
        sized = with_parts(posts.drop("comments"), "id", splits, "_slices")
        parents = sized.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
        match = (parents["id"] == lists["post_id"]) & (parents["slice"] == lists["_slice"])
    joined = parents.join(lists, match, "left")
    nested = joined.withColumn("comments", or_empty("comments", COMMENT_LIST))
    return nested.withColumnRenamed("_slices", "n_slices").drop("_slice", "post_id")


def missing_post_keys(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Distinct ``post_id`` values of comments without a post."""
    ids = posts.where(F.col("id").isNotNull()).select("id").distinct()
    keys = comments.where(F.col("post_id").isNotNull()).select("post_id").distinct()
    return keys.join(ids, keys["post_id"] == ids["id"], "left_anti")


def orphan_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Comments whose post is missing."""
    return keep_keys(comments, "post_id", missing_post_keys(posts, comments))
