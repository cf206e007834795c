"""What scans and thread builds leave out of their plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from threadloom.adapters import xml_lines
from threadloom.operators.threads import build_threads
from threadloom.schemas import entity
from threadloom.sources import rejects, scan_rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("root, looked_for", [("posts|comments", 0), ("rows", 1)])
def test_pieces_meet_the_patterns_they_need(spark, tmp_path, root, looked_for):
    first = root.split("|")[0]
    (tmp_path / "a.xml").write_text(
        f'﻿<?xml version="1.0"?>\n<{first} a="=">\n  <row Id="1" Body="a = b"/>\n<row Id="2"></row>\n</{first}>\n'
    )
    (tmp_path / "b.xml").write_text('<row Id="3"/>\n<row\n')
    scan = scan_rows(spark, str(tmp_path), "post", root=root)
    assert plan_of(scan).count(rf"^<(?:{root})") == looked_for
    good = scan.where("reason is null").select("record.Id")
    assert sorted(r.Id for r in good.collect()) == ["1", "2", "3"]
    assert rejects(scan).count() == 1


def test_numbers_of_answers_need_no_lists(spark):
    fields = [F.lit(None).cast(f.dataType).alias(f.name) for f in entity("post").schema.fields]
    posts = spark.range(2).select(*fields).withColumns(
        {"id": F.lit("q"), "pos_type_id": F.lit("1"), "body": F.lit("text")}
    )
    counts = build_threads(posts.limit(1)).select("thread_key", "n_answers")
    assert plan_of(counts).count("collect_list") == 0
    assert [tuple(r) for r in counts.collect()] == [("q", 0)]


def test_texts_are_escaped(spark):
    fields = [F.lit(None).cast(f.dataType).alias(f.name) for f in entity("post").schema.fields]
    made = xml_lines(spark.range(1).select(*fields).withColumns({"id": F.lit('"<&'), "score": F.lit(3)}), "post")
    assert made.first()["value"] == '<row Id="&quot;&lt;&amp;" Score="3" />'
