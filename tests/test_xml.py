import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from threadloom.sources import accepted, read_lines, rejects, scan_rows, type_records

GOOD = [
    '<row Id="1" PostTypeId="1" CreationDate="2011-01-02T03:04:05.006" Score="5" Title="  padded "'
    ' Tags="&lt;a&gt;&lt;b&gt;" Body="&lt;row Id=&quot;9&quot;/&gt;&#xA;é 😀 /> raw &amp; &#228;"'
    ' OwnerDisplayName="Ann" LastEditorUserId="44" Unknown="ignored" />',
    '<row Id="2" PostTypeId="2" ParentId="1" CreationDate="2011-01-02T03:04:05Z" Title=""></row>',
    '  <row Id="3" PostTypeId="2" CreationDate="2011-01-02T03:04:05+02:00" Score="" ViewCount="x"'
    ' AnswerCount="99999999999"/>',
]
BAD = {
    '<row Id="10"': "layout",
    '<row Id="11"/><row Id="12"/>': "layout",
    '<row Id="13"/> junk': "layout",
    '<rows Id="14"/>': "layout",
    '<row Id="15"><b>child</b></row>': "layout",
    "junk": "layout",
    '<row Id="16" Id="17"/>': "corrupt",
    '<row Id="18" Body="&nowhere;"/>': "corrupt",
    "<row Id=19/>": "corrupt",
}
SILENT = ["﻿<?xml version=\"1.0\" encoding=\"utf-8\"?>", "<posts>", "", "   ", "</posts>"]


def write(tmp_path, lines, name="posts.xml", newline="\n"):
    path = tmp_path / name
    path.write_text(newline.join(lines), encoding="utf-8", newline="")
    return str(path)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_rows_and_rejects(spark, tmp_path, newline):
    lines = SILENT[:2] + GOOD + SILENT[2:4] + list(BAD) + SILENT[4:]
    scan = scan_rows(spark, write(tmp_path, lines, newline=newline), "post", one_row_per_line=True)
    assert {r["line"]: r["reason"] for r in rejects(scan).collect()} == BAD

    typed = type_records(scan, "post")
    rows = {r["id"]: r for r in accepted(typed).collect()}
    assert rows.keys() == {"1", "2", "3"}
    one, two, three = rows["1"], rows["2"], rows["3"]
    assert one["body"] == '<row Id="9"/>\né 😀 /> raw & ä'
    assert one["title"] == "  padded " and one["tags"] == "<a><b>" and one["score"] == 5
    assert one["creation_date"] == dt.datetime(2011, 1, 2, 3, 4, 5, 6000)
    assert one["comments"] == []
    assert (one["owner_display_name"], one["last_editor_user_id"]) == ("Ann", "44")
    assert two["creation_date"] == dt.datetime(2011, 1, 2, 3, 4, 5)
    assert (two["title"], one["parent_id"], two["parent_id"]) == ("", None, "1")
    assert (three["creation_date"], three["score"], three["view_count"]) == (None, None, None)
    lost = {r["id"]: r["bad_values"] for r in typed.where("reason is null").collect()}
    assert lost == {"1": 0, "2": 0, "3": 4}


def test_editor_alias(spark, tmp_path):
    path = write(tmp_path, GOOD)
    scan = scan_rows(spark, path, "post", alias_editor=True)
    row = accepted(type_records(scan, "post", alias_editor=True)).where("id = '1'").first()
    assert (row["owner_display_name"], row["last_editor_user_id"]) == ("44", "44")


def test_strict(spark, tmp_path):
    path = write(tmp_path, SILENT[:2] + GOOD[:2] + SILENT[4:])
    scan = scan_rows(spark, path, "post", strict=True, one_row_per_line=True)
    assert accepted(type_records(scan, "post", strict=True)).count() == 2
    for i, bad in enumerate([*BAD, GOOD[2]]):
        path = write(tmp_path, [GOOD[0], bad], f"bad{i}.xml")
        scan = scan_rows(spark, path, "post", strict=True, one_row_per_line=True)
        with pytest.raises((PySparkException, Py4JJavaError)):
            accepted(type_records(scan, "post", strict=True)).collect()


def test_comments(spark, tmp_path):
    lines = [
        "<comments>",
        '<row Id="1" PostId="7" Score="3" Text="a &lt; b" CreationDate="2011-01-02T03:04:05.5"'
        ' UserDisplayName="Bo" UserId="8"/>',
        '<row Id="2" Score="many"/>',
        "</comments>",
    ]
    scan = scan_rows(spark, write(tmp_path, lines), "comment")
    one, two = accepted(type_records(scan, "comment")).orderBy("id").collect()
    assert one.asDict() == {
        "id": "1",
        "post_id": "7",
        "score": 3,
        "text": "a < b",
        "creation_date": dt.datetime(2011, 1, 2, 3, 4, 5, 500000),
        "user_display_name": "Bo",
        "user_id": "8",
    }
    assert (two["post_id"], two["score"], two["text"]) == (None, None, None)


def test_rows_in_any_layout(spark, tmp_path):
    rows = [f'<row Id="{i}"\n  PostTypeId="1" Title="t\t{i}"\n/>' for i in range(50)]
    head = '<?xml version="1.0" encoding="utf-8"?>\n<posts>\n'
    (tmp_path / "a.xml").write_text(head + "".join(rows) + "\n</posts>\n", encoding="utf-8")
    (tmp_path / "b.xml").write_text(
        '<posts><row Id="50"></row> <row Id="51"/>junk<row Id="52"/><rows/></posts>', encoding="utf-8"
    )
    scan = scan_rows(spark, str(tmp_path), "post", one_row_per_line=False)
    rows = accepted(type_records(scan, "post")).collect()
    assert sorted(int(r["id"]) for r in rows) == [*range(51), 52]
    assert sorted(r["line"] for r in rejects(scan).collect()) == [
        '<row Id="51"/>junk',
        "<rows/>",
    ]


def test_one_file_is_split_among_tasks(spark, tmp_path):
    lines = ["<posts>"] + [f'<row Id="{i}" Body="{"x" * 300}"/>' for i in range(5000)] + ["</posts>"]
    path = write(tmp_path, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        for one_row_per_line in (True, False):
            scan = scan_rows(spark, path, "post", one_row_per_line=one_row_per_line)
            assert scan.rdd.getNumPartitions() > 4
            ids = accepted(type_records(scan, "post")).select("id").distinct().count()
            assert ids == 5000
            assert rejects(scan).count() == 0
        assert read_lines(spark, path).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
