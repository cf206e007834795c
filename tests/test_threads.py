import pytest
from pyspark.sql import functions as F

from tests.archive import (
    collected_threads,
    comments_frame,
    comment,
    expected_threads,
    post,
    posts_frame,
    random_archive,
)
from threadloom.operators.comments import nest_comments, orphan_comments
from threadloom.operators.duplicates import first_posts
from threadloom.operators.groups import co_group, group_by_key
from threadloom.operators.routing import with_thread_key
from threadloom.operators.threads import build_threads, flatten_threads, orphan_answers
from threadloom.schemas import POST_SCHEMA


def stored(spark, df, tmp_path, name):
    """Parquet-backed, so that rows have places in files."""
    df.write.parquet(str(tmp_path / name))
    return spark.read.schema(df.schema).parquet(str(tmp_path / name))


@pytest.mark.parametrize("max_group", [3, 10, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_threads_with_comments_match_brute_force(spark, tmp_path, seed, max_group):
    posts, comments = random_archive(seed)
    p = stored(spark, posts_frame(spark, posts), tmp_path, "p")
    c = stored(spark, comments_frame(spark, comments), tmp_path, "c")
    threads = build_threads(p, c, max_group=max_group).cache()
    got = collected_threads(threads)
    want = expected_threads(posts, comments)
    for key, (question, q_comments, answers, _) in want.items():
        assert got[key][:3] == (question, q_comments, answers), key
    assert got.keys() == want.keys()
    if max_group == 10_000:
        assert got == want
        assert threads.where("part > 0").count() == 0
    else:
        assert threads.where("part > 0").count() > 0
    threads.unpersist()


def test_parts_stay_near_the_limit(spark, tmp_path):
    posts = [post("q", "1")] + [post(f"a{i}", "2", "q") for i in range(2000)]
    comments = [comment("same", "a0") for _ in range(3000)]
    p = stored(spark, posts_frame(spark, posts), tmp_path, "p")
    c = stored(spark, comments_frame(spark, comments), tmp_path, "c")
    threads = build_threads(p, c, max_group=500)
    sizes = threads.select(
        (
            F.size("answers")
            + F.aggregate("answers", F.lit(0), lambda n, a: n + F.size(a["comments"]))
        ).alias("n")
    )
    # exact copies of one comment are spread too
    assert 0 < sizes.agg(F.max("n")).first()[0] < 2500
    assert sizes.agg(F.sum("n")).first()[0] >= 5000
    (answered,) = collected_threads(threads).values()
    assert answered[2]["a0"] == ["same"] * 3000
    assert threads.select("n_answers").distinct().collect() == [(2000,)]


def test_copies_in_a_table_without_files_are_spread(spark):
    posts = posts_frame(spark, [post("q", "1")])
    same = comments_frame(spark, [comment("same", "q") for _ in range(1000)])
    sizes = nest_comments(posts, same.union(same), max_group=100).select(F.size("comments"))
    sizes = [r[0] for r in sizes.collect()]
    assert sum(sizes) == 2000 and len(sizes) == 20 and max(sizes) < 200
    answers = posts_frame(spark, [post("q", "1")] + [post("a", "2", "q")] * 1000)
    sizes = build_threads(answers, max_group=100).select(F.size("answers")).collect()
    assert sum(r[0] for r in sizes) == 1000 and max(r[0] for r in sizes) < 200


@pytest.mark.parametrize("max_group", [2, 10_000])
def test_without_comments_every_copy_counts(spark, tmp_path, max_group):
    posts = [
        post("q1", "1", day=0, title="old"),
        post("q1", "1", day=2, title="new"),
        post("a1", "2", "q1"),
        post("a1", "2", "q1", day=1),
        post("a2", "2", "q1"),
        post("a2", "2", "q1"),
        post("q2", "1"),
        post("a3", "2", "nowhere"),
        post("a4", "2", "a1"),
        post("w", "5"),
    ]
    p = stored(spark, posts_frame(spark, posts), tmp_path, "p")
    threads = build_threads(p, max_group=max_group).cache()
    got = collected_threads(threads)
    assert got.keys() == {"q1", "q2"}
    assert got["q1"][3] == ["a1", "a1", "a2", "a2"]
    assert got["q2"][3] == []
    titles = threads.where("thread_key = 'q1'").select("question.title").distinct().collect()
    assert titles == [("new",)]
    flat = flatten_threads(threads).select("thread_key", "answer.id").collect()
    assert sorted(flat, key=str) == sorted(
        [("q1", "a1"), ("q1", "a1"), ("q1", "a2"), ("q1", "a2"), ("q2", None)], key=str
    )
    threads.unpersist()


def test_many_questions_with_one_key_are_reduced_before_they_are_repeated(spark):
    posts = [post(f"q{i}", "1", day=i, owner_user_id="t") for i in range(50)]
    posts += [post(f"a{i}", "2", owner_user_id="t") for i in range(20)]
    df = posts_frame(spark, posts)
    threads = build_threads(df, key=F.col("owner_user_id"), max_group=5).collect()
    assert {t["question"]["id"] for t in threads} == {"q49"}
    assert sorted(a["id"] for t in threads for a in t["answers"]) == sorted(
        f"a{i}" for i in range(20)
    )
    assert len(threads) == 4


def test_with_comments_the_first_copy_stands(spark):
    posts = [
        post("q", "1"),
        post("a", "2", "q", day=3, body="later"),
        post("a", "2", "q", day=1, body="first"),
        # the first of these is no thread post, so the id takes no part
        post("x", "5", day=0),
        post("x", "2", "q", day=1),
    ]
    comments = [comment("c1", "a"), comment("c2", "a"), comment("c3", None)]
    p, c = posts_frame(spark, posts), comments_frame(spark, comments)
    (thread,) = build_threads(p, c).collect()
    assert [(a["id"], a["body"], [x["id"] for x in a["comments"]]) for a in thread["answers"]] == [
        ("a", "first", ["c1", "c2"])
    ]
    # choosing first and filtering afterwards is not the other way round
    assert build_threads(p).first()["n_answers"] == 3


def test_arrays_are_never_null_and_in_order(spark):
    posts = [post("q", "1"), post("b", "2", "q", day=1), post("a", "2", "q", day=1)]
    posts += [post("c", "2", "q", day=0), post("r", "1")]
    comments = [comment("2", "q", day=1), comment("1", "q", day=1), comment("0", "q", day=2)]
    threads = build_threads(posts_frame(spark, posts), comments_frame(spark, comments))
    rows = {r["thread_key"]: r for r in threads.collect()}
    assert [a["id"] for a in rows["q"]["answers"]] == ["c", "a", "b"]
    assert [c["id"] for c in rows["q"]["question"]["comments"]] == ["1", "2", "0"]
    assert rows["r"]["answers"] == [] and rows["r"]["question"]["comments"] == []
    assert all(a["comments"] == [] for a in rows["q"]["answers"])


def test_both_routes_to_threads_agree(spark):
    posts, comments = random_archive(5, hot=False)
    p, c = posts_frame(spark, posts), comments_frame(spark, comments)
    direct = build_threads(p, c)
    stepwise = build_threads(nest_comments(first_posts(p), c).drop("slice"))
    assert collected_threads(direct) == collected_threads(stepwise)


@pytest.mark.parametrize("max_group", [7, 10_000])
def test_nest_comments(spark, tmp_path, max_group):
    posts, comments = random_archive(3)
    p = posts_frame(spark, posts)
    c = stored(spark, comments_frame(spark, comments), tmp_path, "c")
    nested = nest_comments(p, c, max_group=max_group).collect()
    got = {}
    for row in nested:
        got.setdefault(row["id"], []).extend(x["id"] for x in row["comments"])
    for item in posts:
        want = sorted(x["id"] for x in comments if x["post_id"] == item["id"])
        assert sorted(got[item["id"]]) == want
    assert len(got) == len(posts)
    assert (len(nested) > len(posts)) == (max_group == 7)


@pytest.mark.parametrize("max_group", [5, 10_000])
def test_groups_keep_every_row(spark, tmp_path, max_group):
    posts, comments = random_archive(4)
    posts = posts + [post("a0", "2", "q0", day=9)]
    p = stored(spark, posts_frame(spark, posts), tmp_path, "p")
    c = stored(spark, comments_frame(spark, comments), tmp_path, "c")
    groups = group_by_key(with_thread_key(p), "thread_key", max_group=max_group).collect()
    got = sorted((g["thread_key"], i["id"]) for g in groups for i in g["items"])
    want = sorted(
        (x["id"] if x["pos_type_id"] == "1" else x["parent_id"], x["id"])
        for x in posts
        if x["pos_type_id"] in "12"
    )
    assert got == want

    both = co_group({"posts": (p, "id"), "comments": (c, "post_id")}, max_group=max_group).collect()
    assert sorted((g["key"], i["id"]) for g in both for i in g["posts"]) == sorted(
        (x["id"], x["id"]) for x in posts
    )
    assert sorted((g["key"], i["id"]) for g in both for i in g["comments"]) == sorted(
        (x["post_id"], x["id"]) for x in comments
    )
    assert any(g["part"] > 0 for g in both) == (max_group == 5)
    assert "missing" in {g["key"] for g in both}


def test_first_posts_and_orphans(spark):
    posts, comments = random_archive(6)
    extra = [post("a1", "2", "q0", day=-5, body="earliest"), post(None, "1")]
    p, c = posts_frame(spark, posts + extra), comments_frame(spark, comments)
    first = first_posts(p)
    assert first.schema.names == POST_SCHEMA.names
    assert first.count() == len(posts)
    assert first.where("id = 'a1'").first()["body"] == "earliest"

    known = {x["id"] for x in posts}
    assert sorted(r["id"] for r in orphan_comments(p, c).collect()) == sorted(
        x["id"] for x in comments if x["post_id"] not in known
    )
    questions = {x["id"] for x in posts if x["pos_type_id"] == "1"}
    assert sorted(r["id"] for r in orphan_answers(p).collect()) == sorted(
        x["id"] for x in posts if x["pos_type_id"] == "2" and x["parent_id"] not in questions
    )


@pytest.mark.parametrize("max_group", [3, 10_000])
def test_large_groups_without_a_question(spark, max_group):
    posts = [post("q", "1"), post("a", "2", "q")] + [post(f"o{i}", "2", "gone") for i in range(30)]
    p = posts_frame(spark, posts)
    (thread,) = build_threads(p, max_group=max_group).collect()
    assert (thread["thread_key"], thread["n_answers"]) == ("q", 1)
    groups = build_threads(p, keep_questionless=True, max_group=max_group)
    gone = groups.where("question IS NULL").select(F.explode("answers.id")).collect()
    assert sorted(r[0] for r in gone) == sorted(f"o{i}" for i in range(30))


def test_large_key_tables_are_not_broadcast(spark, monkeypatch):
    from threadloom.operators import skew

    posts, comments = random_archive(7)
    want = expected_threads(posts, comments)
    posts.append(post("a1", "2", "q0", day=30))
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", 0)
    p, c = posts_frame(spark, posts), comments_frame(spark, comments)
    got = collected_threads(build_threads(p, c, max_group=4))
    assert {k: v[:3] for k, v in got.items()} == {k: v[:3] for k, v in want.items()}


@pytest.mark.parametrize("with_comments", [True, False])
def test_a_thread_is_one_row_at_every_size(spark, tmp_path, monkeypatch, with_comments):
    from threadloom.operators import threads as building

    posts, comments = random_archive(8)
    p = stored(spark, posts_frame(spark, posts), tmp_path, "p")
    c = stored(spark, comments_frame(spark, comments), tmp_path, "c") if with_comments else None
    columns = ["thread_key", "part", "n_parts", "n_answers", "question", "answers"]
    want = {r["thread_key"]: r for r in build_threads(p, c).collect()}
    monkeypatch.setattr(building, "MAX_GROUP", 3)
    got = build_threads(p, c)
    assert got.columns == columns
    assert {r["thread_key"]: r for r in got.collect()} == want
    kept = build_threads(p, c, keep_questionless=True).collect()
    assert len({r["thread_key"] for r in kept}) == len(kept) > len(want)


def test_more_answers_and_comments_than_a_task_lists(spark):
    posts = spark.range(10_001).select(F.concat(F.lit("a"), "id").alias("id"), F.lit("2").alias("pos_type_id"), F.lit("q").alias("parent_id"))
    known = posts_frame(spark, [post("q", "1"), post("r", "1"), post("only", "2", "r")])
    p = known.unionByName(posts, allowMissingColumns=True)
    c = comments_frame(spark, []).unionByName(
        spark.range(10_001).select(F.col("id").cast("string"), F.lit("only").alias("post_id")), allowMissingColumns=True
    )
    rows = {r["thread_key"]: r for r in build_threads(p, c).select(
        "thread_key", "n_parts", "n_answers", F.size("answers").alias("listed"),
        F.size(F.array_distinct(F.transform("answers", lambda a: a["id"]))).alias("different"),
        F.size(F.flatten("answers.comments")).alias("comments"),
    ).collect()}
    assert tuple(rows["q"]) == ("q", 1, 10_001, 10_001, 10_001, 0)
    assert tuple(rows["r"]) == ("r", 1, 1, 1, 1, 10_001)
    (nested,) = nest_comments(p.where("id = 'only'"), c).collect()
    assert len(nested["comments"]) == 10_001 and nested["n_slices"] == 1
    (group,) = group_by_key(posts, "parent_id").collect()
    assert len(group["items"]) == 10_001 and group["n_parts"] == 1


def test_flat_relations(spark):
    from threadloom.operators.threads import answers_of_questions, comments_of_posts

    posts, comments = random_archive(9)
    p, c = posts_frame(spark, posts), comments_frame(spark, comments)
    asked = {x["id"] for x in posts if x["pos_type_id"] == "1"}
    got = answers_of_questions(p).select("question.id", F.col("answer.id").alias("a")).collect()
    assert sorted(map(tuple, got)) == sorted(
        (x["parent_id"], x["id"]) for x in posts if x["pos_type_id"] == "2" and x["parent_id"] in asked
    )
    known = {x["id"] for x in posts}
    got = comments_of_posts(p, c).select("post.id", F.col("comment.id").alias("c")).collect()
    assert sorted(map(tuple, got)) == sorted((x["post_id"], x["id"]) for x in comments if x["post_id"] in known)
