"""Lists of large groups are the lists one aggregation gives, and no task makes much of them."""

import random

import pytest
from pyspark.sql import functions as F

from tests.archive import comment, comments_frame, post, posts_frame
from threadloom.operators import listing
from threadloom.operators.comments import nest_comments
from threadloom.operators.groups import co_group, group_by_key
from threadloom.operators.listing import GroupTooLarge, Listed, whole_lists


@pytest.fixture
def small_groups(monkeypatch):
    """Everything above five rows is a large group."""
    monkeypatch.setattr(listing, "MAX_GROUP", 5)


def hot_comments(n=400):
    rng = random.Random(5)
    rows = [comment(f"c{i}", "hot" if rng.random() < 0.4 else f"p{i % 40}", day=rng.randrange(7)) for i in range(n)]
    rows += [comment("same", "hot", day=3)] * 60 + [comment("same", "p1", day=3)] * 9
    rows += [comment(None, "hot", day=2), comment("none", None), comment("x", "hot", creation_date=None)]
    rows += [comment(f"l{i}", "hot", day=3, text="x" * 2000 + str(i % 3)) for i in range(12)]
    return rows


def groups(df, key, name):
    rows = df.select(key, name).collect()
    found = {r[key]: r[name] for r in rows}
    assert len(found) == len(rows)
    return found


def test_lists_are_as_from_one_task(spark, monkeypatch):
    comments = comments_frame(spark, hot_comments())
    posts = posts_frame(spark, [post(f"p{i}", "1", day=i) for i in range(40)] + [post("hot", "1")] + [post("hot", "2", "p1")] * 8)
    once = posts.where("pos_type_id = '1'")

    def results():
        return [
            groups(group_by_key(comments, "post_id"), "post_id", "items"),
            groups(group_by_key(comments, "post_id", [F.col("creation_date"), F.col("score")]), "post_id", "items"),
            groups(nest_comments(once, comments), "id", "comments"),
            groups(co_group({"posts": (posts, "id"), "comments": (comments, "post_id")}), "key", "posts"),
            groups(co_group({"posts": (posts, "id"), "comments": (comments, "post_id")}), "key", "comments"),
        ]

    want = results()
    monkeypatch.setattr(listing, "MAX_GROUP", 5)
    assert results() == want
    assert len(want[0]["hot"]) > 200 and len(want[2]["hot"]) == len(want[0]["hot"])
    # so do cuts by bytes alone, and by the beginnings of texts
    monkeypatch.setattr(listing, "MAX_GROUP", 10_000)
    monkeypatch.setattr(listing, "PART_BYTES", 300)
    monkeypatch.setattr(listing, "LONG_TEXT", 1)
    assert results() == want


def test_no_task_lists_a_third_of_the_rows(spark, small_groups):
    """A third of all rows on one key: what a task lists is at most three times the median."""
    rows = [comment(f"c{i}", "hot" if i % 3 == 0 else f"p{i % 500}", day=i % 17) for i in range(6000)]
    df = comments_frame(spark, rows)
    lists = {"items": Listed(F.struct(*df.columns), (F.col("creation_date"), F.col("id")))}
    heavy = listing.heavy_groups(df, "post_id")
    sizes = [r["n"] for r in listing.stretches(df, "post_id", lists, heavy)
             .groupBy("split_key", "stretch").agg(F.sum("copies").alias("n")).collect()]
    assert sum(sizes) > 2000
    hot = [r["n"] for r in listing.stretches(df, "post_id", lists, heavy).where("split_key = 'hot'")
           .groupBy("stretch").agg(F.sum("copies").alias("n")).collect()]
    assert len(hot) > 100 and max(hot) <= 3 * sorted(hot)[len(hot) // 2]


def test_copies_are_counted_before_the_shuffle(spark, small_groups):
    df = comments_frame(spark, [comment("same", "hot")] * 3000 + [comment(f"c{i}", "p") for i in range(9)])
    lists = {"items": Listed(F.struct(*df.columns))}
    rows = listing.stretches(df, "post_id", lists, listing.heavy_groups(df, "post_id"))
    assert sorted(r["copies"] for r in rows.collect()) == [1] * 9 + [3000]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Python" not in plan
    (hot,) = [r for r in whole_lists(df, "post_id", lists).collect() if r["post_id"] == "hot"]
    assert len(hot["items"]) == 3000


def test_a_group_that_no_row_can_hold_is_named(spark, monkeypatch):
    monkeypatch.setattr(listing, "MAX_GROUP", 5)
    monkeypatch.setattr(listing, "ROW_BYTES", 1000)
    df = comments_frame(spark, [comment(f"c{i}", "hot", text="y" * 200) for i in range(20)])
    with pytest.raises(GroupTooLarge, match="'hot'.*max_group"):
        group_by_key(df, "post_id")
    assert group_by_key(df, "post_id", max_group=5).count() > 1


def test_bytes(spark):
    df = spark.createDataFrame([("é", [("ab", 1), (None, 2)], 5), (None, None, None)], "s string, l array<struct<t string, n int>>, i int")
    assert [r[0] for r in df.select(listing.row_bytes(df)).collect()] == [2 + (8 + 2 + 8) + (8 + 8) + 8, 8]


def test_empty_tables(spark, small_groups):
    df = comments_frame(spark, [])
    assert group_by_key(df, "post_id").count() == 0
    assert co_group({"a": (df, "post_id"), "b": (df, "id")}).count() == 0
