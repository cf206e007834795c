from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.archive import comments_frame, comment, post, posts_frame
from threadloom.adapters import xml_lines
from threadloom.operators.quality import (
    multi_question_keys,
    null_key_comments,
    null_key_posts,
    quality_counts,
    require_keys,
    unsupported_posts,
)
from threadloom.plans import (
    load_both,
    load_posts,
    sample_log,
    threads_with_comments,
    threads_without_comments,
)
from threadloom.plans.catalog import _stored_flat
from threadloom.session import scratch_dir, sized_shuffle, stored_bytes
from threadloom.sources import read_table

# Six questions and eighteen answers, two of them to a question that is present; the others ask
# for thirteen absent ones.
QUESTIONS = [post(str(i), "1", day=i, title=f"t{i} <&>") for i in range(6)]
ANSWERS = [post("20", "2", "2"), post("21", "2", "4", body="line\nbreak \"quoted\"")]
ANSWERS += [post(str(30 + i), "2", str(100 + i % 13)) for i in range(16)]
COMMENTS = [comment("c0", "20"), comment("c1", "20", score=3), comment("c2", "2")]
COMMENTS += [comment("c3", "999"), comment("c4", "999")]


def dump(spark, tmp_path, name, df, extra=()):
    lines = [r["value"] for r in xml_lines(df, name).collect()]
    wrapped = ['<?xml version="1.0" encoding="utf-8"?>', f"<{name}s>", *lines, *extra, f"</{name}s>"]
    path = tmp_path / f"{name}s.xml"
    path.write_text("\n".join(wrapped), encoding="utf-8")
    return str(path)


@pytest.fixture
def dumps(spark, tmp_path):
    posts = dump(spark, tmp_path, "post", posts_frame(spark, QUESTIONS + ANSWERS))
    comments = dump(spark, tmp_path, "comment", comments_frame(spark, COMMENTS))
    return posts, comments, str(tmp_path / "tables")


def test_threads_without_comments(spark, dumps):
    posts, comments, base = dumps
    for _ in range(2):
        report = threads_without_comments(spark, posts, comments, base)
    threads = read_table(spark, base, "thread").collect()
    assert sorted(t["question"]["id"] for t in threads) == list("012345")
    assert {t["question"]["id"]: [a["id"] for a in t["answers"]] for t in threads if t["answers"]} == {
        "2": ["20"],
        "4": ["21"],
    }
    assert all(t["question"]["comments"] == [] for t in threads)
    assert all(a["comments"] == [] for t in threads for a in t["answers"])
    assert report.scans["post"] == {"lines": 24, "rejected": 0, "rows_with_bad_values": 0}
    assert report.quality == {
        "unsupported_type": 0,
        "null_key_posts": 0,
        "duplicate_post": 0,
        "multi_question": 0,
        "missing_question": 13,
        "missing_post": 1,
        "null_key_comments": 0,
    }


def test_threads_with_comments(spark, dumps):
    posts, comments, base = dumps
    threads_with_comments(spark, posts, comments, base, count_quality=False)
    threads = {t["question"]["id"]: t for t in read_table(spark, base, "thread").collect()}
    assert len(threads) == 6
    assert [c["id"] for c in threads["2"]["question"]["comments"]] == ["c2"]
    (answer,) = threads["2"]["answers"]
    assert [(c["id"], c["score"]) for c in answer["comments"]] == [("c0", None), ("c1", 3)]
    assert threads["4"]["answers"][0]["body"] == 'line\nbreak "quoted"'
    # the post table is written before comments join, the comment table keeps orphans
    stored = read_table(spark, base, "post")
    assert stored.where(F.size("comments") > 0).count() == 0 and stored.count() == 24
    assert read_table(spark, base, "comment").count() == 5


@pytest.mark.parametrize("max_group", [1, None])
def test_stored_threads_flatten_whether_split_or_not(spark, dumps, max_group):
    posts, comments, base = dumps
    threads_with_comments(
        spark, posts, comments, base, count_quality=False, max_group=max_group
    )
    split = read_table(spark, base, "thread").count() > 6
    assert split == (max_group == 1)
    if split:
        parts = read_table(spark, base, "thread_part", table="thread").groupBy("thread_key", "n_parts")
        assert all(r["n_parts"] == r["count"] for r in parts.count().collect())
    flat = _stored_flat(spark, base)
    pairs = flat.select("question.id", F.col("answer.id").alias("a")).distinct().collect()
    assert sorted(pairs, key=str) == sorted(
        [("0", None), ("1", None), ("2", "20"), ("3", None), ("4", "21"), ("5", None)], key=str
    )
    comments_seen = flat.select(F.explode("answer.comments.id")).collect()
    assert sorted(r[0] for r in comments_seen) == ["c0", "c1"]


def test_load_reports_and_rejects(spark, tmp_path):
    rows = [post("1", "1"), post("2", None), post("3", "5"), post("4", "2"), post(None, "1")]
    bad = ['<row Id="5" PostTypeId="1" Score="x"/>', '<row Id="6"/><row Id="7"/>', '<row Id="8"']
    path = dump(spark, tmp_path, "post", posts_frame(spark, rows), bad)
    base = str(tmp_path / "tables")
    report = load_posts(spark, path, base)
    # two rows on one line are two good rows
    assert report.scans == {"post": {"lines": 9, "rejected": 1, "rows_with_bad_values": 1}}
    assert report.quality == {"unsupported_type": 4, "null_key_posts": 5}
    assert read_table(spark, base, "post").count() == 8
    rejected = spark.read.parquet(f"{base}/post_rejects").collect()
    # the row that was cut off took the closing tag in
    assert len(rejected) == 1 and rejected[0]["line"].startswith(bad[2])
    by_line = str(tmp_path / "by-line")
    report = load_posts(spark, path, by_line, one_row_per_line=True)
    assert report.scans == {"post": {"lines": 8, "rejected": 2, "rows_with_bad_values": 1}}
    assert report.quality == {"unsupported_type": 2, "null_key_posts": 3}
    rejected = spark.read.parquet(f"{by_line}/post_rejects").collect()
    assert sorted(r["line"] for r in rejected) == sorted(bad[1:])
    with pytest.raises(PySparkException):
        load_posts(spark, path, base, strict=True)
    # the failed run left the old rows, the clean one empties the rejects
    assert read_table(spark, base, "post").count() == 8
    load_posts(spark, dump(spark, tmp_path, "post", posts_frame(spark, rows)), base)
    assert read_table(spark, base, "post").count() == 5
    assert spark.read.parquet(f"{base}/post_rejects").count() == 0


def test_a_broken_row_without_content_is_no_head(spark, tmp_path):
    path, base = tmp_path / "posts.xml", str(tmp_path / "tables")
    path.write_text('<?xml version="1.0"?>\n<posts count="2">\n<row\n<row Id="2" PostTypeId="1"/><row Id="3" PostTypeId="1"/></posts>')
    report = load_posts(spark, str(path), base)
    assert report.scans["post"] == {"lines": 3, "rejected": 1, "rows_with_bad_values": 0}
    assert spark.read.parquet(f"{base}/post_rejects").collect() == [("<row", "layout")]
    assert read_table(spark, base, "post").count() == 2
    with pytest.raises(ValueError, match="broken rows"):
        load_posts(spark, str(path), base, strict=True)
    path.write_text('<rows>\n<item Id="2" PostTypeId="1"/><item\nId="3" PostTypeId="1"/></rows>')
    report = load_posts(spark, str(path), base, root="rows", record="item", strict=True)
    assert report.scans["post"]["lines"] == 2 and read_table(spark, base, "post").count() == 2


def test_catalog_jobs_and_strict_comments(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS jobs")
    posts = dump(spark, tmp_path, "post", posts_frame(spark, QUESTIONS + ANSWERS))
    comments = dump(spark, tmp_path, "comment", comments_frame(spark, COMMENTS))
    threads_with_comments(spark, posts, comments, database="jobs", strict=True)
    assert spark.table("jobs.thread").count() == 6 and spark.table("jobs.post_rejects").count() == 0
    keyless = dump(spark, tmp_path, "comment", comments_frame(spark, [comment("c", None)]))
    with pytest.raises(PySparkException, match="comment without post"):
        threads_with_comments(spark, posts, keyless, database="jobs", strict=True)
    assert spark.table("jobs.comment").count() == 5


def test_jobs_leave_no_intermediates(spark, tmp_path, dumps):
    shared = Path(spark.conf.get("spark.checkpoint.dir"), "threadloom")
    posts, comments, base = dumps
    twice = posts_frame(spark, QUESTIONS + ANSWERS + [post("20", "2", "2", day=3)])
    threads_with_comments(spark, dump(spark, tmp_path, "post", twice), comments, base)
    assert not [d for d in shared.glob("job-*")] if shared.exists() else True


def test_strict_refuses_posts_without_key_or_type(spark, tmp_path):
    for i, row in enumerate([post("1", None), post(None, "1"), post("1", "2")]):
        with pytest.raises(PySparkException, match="post without key or type"):
            require_keys(posts_frame(spark, [row])).collect()
    fine = posts_frame(spark, [post("1", "1"), post("2", "2", "1"), post("3", "5")])
    assert require_keys(fine).count() == 3


def test_any_layout_and_alias(spark, tmp_path):
    posts = dump(spark, tmp_path, "post", posts_frame(spark, [post("1", "1", last_editor_user_id="9")]))
    comments = dump(spark, tmp_path, "comment", comments_frame(spark, COMMENTS))
    base = str(tmp_path / "tables")
    load_both(spark, posts, comments, base, alias_editor=True, one_row_per_line=False)
    assert read_table(spark, base, "post").first()["owner_display_name"] == "9"
    assert read_table(spark, base, "comment").count() == 5


def test_quality_channels(spark):
    posts = [post("1", "1"), post("1", "1", day=1), post("2", "2", "1"), post("3", "2", "x")]
    posts += [post("4", "5"), post("5", None), post("6", "2"), post(None, "1")]
    comments = [comment("a", "1"), comment("b", None), comment("c", "gone"), comment("d", "gone")]
    p, c = posts_frame(spark, posts), comments_frame(spark, comments)
    assert sorted(r["id"] for r in unsupported_posts(p).collect()) == ["4", "5"]
    assert sorted(str(r["id"]) for r in null_key_posts(p).collect()) == ["5", "6", "None"]
    assert [r["id"] for r in null_key_comments(c).collect()] == ["b"]
    assert multi_question_keys(p).collect() == [("1", 2)]

    def counted(**options):
        return {r["channel"]: r["n"] for r in quality_counts(p, c, **options).collect()}

    want = {
        "unsupported_type": 2,
        "null_key_posts": 3,
        "duplicate_post": 1,
        "multi_question": 0,
        "missing_question": 1,
        "missing_post": 1,
        "null_key_comments": 1,
    }
    assert counted() == want
    assert counted(dedupe=False) == {**want, "multi_question": 1}


def test_sample_log(spark, dumps):
    assert sample_log(spark, dumps[0], modulus=1).count() == 27


def test_session_helpers(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(shared)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f").write_bytes(b"12345")
    assert stored_bytes(spark, str(tmp_path / "d")) == 5
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sized_shuffle(spark, 10 * 2**30):
        assert spark.conf.get(key) == "10"
    with sized_shuffle(spark, 90 * 2**40):
        assert spark.conf.get(key) == "20000"
    with sized_shuffle(spark, 10):
        assert spark.conf.get(key) == before
    assert spark.conf.get(key) == before
