"""The physical plans are the ones meant: few shuffles, narrow scans, no Python, no cross join."""

import re

import pytest
from pyspark.sql import functions as F

from tests.archive import comments_frame, posts_frame, random_archive
from threadloom.operators.comments import comments_per_post, nest_comments, orphan_comments
from threadloom.operators.duplicates import first_posts, repeated_ids
from threadloom.operators.quality import quality_counts
from threadloom.operators.threads import build_threads
from threadloom.sinks import write_table
from threadloom.sources import accepted, read_table, scan_rows, type_records


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("plans"))
    posts, comments = random_archive(1, hot=False)
    write_table(posts_frame(spark, posts), "post", base)
    write_table(comments_frame(spark, comments), "comment", base)
    return read_table(spark, base, "post").drop("comments"), read_table(spark, base, "comment")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+)\(([^)]*)\)", text)


def test_threads_with_comments_shuffle_three_times(tables, no_broadcast):
    text = plan(build_threads(*tables))
    keys = [re.sub(r"#\d+|, \d+$", "", k) for _, k in exchanges(text)]
    assert sorted(keys) == ["id", "post_id", "thread_key"]
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text
    # the scan that takes comments to their threads reads keys only
    assert "ReadSchema: struct<id:string,pos_type_id:string,parent_id:string>" in text


def test_threads_without_comments_shuffle_once(tables):
    text = plan(build_threads(tables[0]))
    assert len(exchanges(text)) == 1 and "Join" not in text
    assert "In(pos_type_id, [1,2])" in text


def test_posts_with_unique_ids_are_not_shuffled(tables):
    assert exchanges(plan(first_posts(tables[0]))) == []


def test_measuring_reads_keys_only(tables):
    for df, column in ((comments_per_post(tables[1]), "post_id"), (repeated_ids(tables[0]), "id")):
        text = plan(df)
        assert f"ReadSchema: struct<{column}:string>" in text
        assert "partial_count" in text
    bodies = plan(quality_counts(*tables))
    assert "body" not in bodies and "text#" not in bodies and "Cartesian" not in bodies


def test_nesting_shuffles_each_side_once(tables, no_broadcast):
    assert len(exchanges(plan(nest_comments(*tables)))) == 2


def test_few_missing_keys_are_broadcast(tables):
    text = plan(orphan_comments(*tables))
    assert "BroadcastHashJoin" in text


def test_scan_parses_each_line_once_without_shuffle(spark, tmp_path):
    (tmp_path / "p.xml").write_text('<row Id="1"/>\n')
    text = plan(accepted(type_records(scan_rows(spark, str(tmp_path), "post"), "post")))
    assert text.count("from_xml") == 1
    assert exchanges(text) == []


def test_row_numbers_cost_nothing_unless_needed(tables):
    assert "row_index" not in plan(build_threads(*tables))
    assert "row_index" in plan(nest_comments(*tables, max_group=2))
    assert "row_index" in plan(build_threads(tables[0], max_group=2).where(F.col("part") > 0))
