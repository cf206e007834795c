"""Posts that share an id: the first one counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.skew import bounded, store
from threadloom.schemas import ROW_ID


def post_order(posts: DataFrame) -> Column:
    """The order that stands for arrival order: creation time, then a hash of the whole row."""
    values = [c for c in posts.columns if c != ROW_ID]
    return F.struct("creation_date", F.xxhash64(*values))


def repeated_ids(posts: DataFrame, key: str = "id") -> DataFrame:
    """Ids held by more than one post, with the number of posts."""
    counts = posts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_posts"))
    return counts.where("n_posts > 1")


def first_posts(
    posts: DataFrame,
    order: Column | None = None,
    *,
    keep: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """One post per id, the first by ``order``; posts without an id are left out.

    Ids are counted first, from their column alone. Without repeats, the usual case, the posts
    pass through unshuffled. A few repeated ids are broadcast, so that only their posts are
    shuffled; beyond that all posts are reduced in one shuffle. The reduction keeps one row per id
    and task before it shuffles. ``columns`` are the ones wanted, all by default; no other is
    shuffled. With ``keep``, what was reduced is stored for repeated use: the few copies, or all
    posts if many ids repeat.
    """
    wanted = columns or posts.columns
    present = posts.where(F.col("id").isNotNull())
    repeated = bounded(repeated_ids(posts).select(F.col("id").alias("_repeated")))
    if repeated.n == 0:
        return present.select(*wanted)
    rank = post_order(posts) if order is None else order

    def reduce_copies(df: DataFrame) -> DataFrame:
        ranked = df.select("id", F.struct(*wanted).alias("_post"), rank.alias("_rank"))
        first = F.min_by("_post", "_rank").alias("_first")
        reduced = ranked.groupBy("id").agg(first).select("_first.*")
        return store(reduced, "first-posts") if keep else reduced

    if not repeated.small:
        return reduce_copies(present)
    match = present["id"] == repeated.table["_repeated"]
    copies = present.join(repeated.table, match, "left_semi")
    once = present.join(repeated.table, match, "left_anti")
    return once.select(*wanted).unionByName(reduce_copies(copies))
