"""What a job takes of the disk: dumps it makes itself are packed and go, shuffles go with their action."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from tests.archive import comments_frame, posts_frame, random_archive
from threadloom import adapters
from threadloom.plans import catalog, jobs, threads_with_comments
from threadloom.session import freed_shuffles, scratch_dir
from threadloom.sources import accepted, scan_rows, type_records

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def size(folder):
    return sum(f.stat().st_size for f in Path(folder.removeprefix("file:")).rglob("part-*"))


def star(spark, folder, n=4):
    """Tables of ``n`` customers, each with two orders of three items."""
    tables = {
        "customer": "id AS c_custkey, 'name' AS c_name, CAST(3 AS INT) AS c_nationkey, 'M' AS c_mktsegment",
        "orders": f"id AS o_orderkey, id % {n} AS o_custkey, 'O' AS o_orderstatus, 2500.0D AS o_totalprice, "
        "TIMESTAMP_NTZ '2001-02-03 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority",
        "supplier": "id AS s_suppkey, 'supplier' AS s_name",
        "lineitem": f"id % {2 * n} AS l_orderkey, id AS l_partkey, id AS l_suppkey, "
        f"CAST(id / {2 * n} AS INT) + 1 AS l_linenumber, 'A' AS l_returnflag, 'F' AS l_linestatus, "
        "TIMESTAMP_NTZ '2001-02-04 00:00:00' AS l_shipdate",
    }
    rows = {"customer": n, "orders": 2 * n, "supplier": 2, "lineitem": 6 * n}
    for name, columns in tables.items():
        spark.range(rows[name]).selectExpr(*columns.split(", ")).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_job_query_packs_its_dumps_and_removes_them(spark, tmp_path, monkeypatch):
    made, real = [], catalog.A.write_xml

    def noted(df, name, path, **options):
        real(df, name, path, **options)
        made.append((path, size(path), len("".join(r[0] for r in adapters.xml_lines(df, name).collect()))))
        return path

    monkeypatch.setattr(catalog.A, "write_xml", noted)
    rows = catalog.QUERIES["i4_threads_with_comments"](spark, star(spark, tmp_path, 400))
    assert len(made) == 2
    for path, nbytes, length in made:
        assert 0 < nbytes < length / 3
        assert not Path(path.removeprefix("file:")).exists()
    # customers 0, 5, … have no answer under their name, 0, 7, … are no question
    questions = [c for c in range(400) if c % 7]
    answered = [c for c in questions if c % 5]
    assert rows.count() == len(answered) * 6 + len(questions) - len(answered)


def test_packed_dump_gives_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapters, "PACKED_ROWS", 7)
    posts, comments = random_archive(3, hot=False)
    for name, df in (("post", posts_frame(spark, posts)), ("comment", comments_frame(spark, comments))):
        plain = adapters.write_xml(df, name, str(tmp_path / name))
        packed = adapters.write_xml(df, name, str(tmp_path / f"{name}-packed"), packed=True)
        files = list(Path(packed).glob("part-*.gz"))
        assert len(files) >= df.count() / 7
        scans = [accepted(type_records(scan_rows(spark, p, name), name)) for p in (plain, packed)]
        assert scans[0].count() == df.count()
        assert scans[0].exceptAll(scans[1]).count() == scans[1].exceptAll(scans[0]).count() == 0


def shuffles(spark):
    """Numbers of the shuffles that have files."""
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def test_thread_build_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    posts, comments = random_archive(4, hot=False)
    dumps = [
        adapters.write_xml(posts_frame(spark, posts), "post", str(tmp_path / "p")),
        adapters.write_xml(comments_frame(spark, comments), "comment", str(tmp_path / "c")),
    ]
    before, real = set(), jobs._stage_threads

    def noted(*args, **options):
        before.update(shuffles(spark))
        real(*args, **options)

    monkeypatch.setattr(jobs, "_stage_threads", noted)
    threads_with_comments(spark, *dumps, scratch_dir(spark, "tables"))
    # Spark removes them in the background; one sum of file sizes is outside
    for _ in range(50):
        left = shuffles(spark) - before
        if len(left) <= 1:
            break
        time.sleep(0.1)
    assert len(left) <= 1


def test_shuffle_setting_is_put_back(spark):
    was = spark.conf.get(CLEANUP, None)
    with freed_shuffles(spark):
        assert spark.conf.get(CLEANUP) == "true"
        assert spark.range(9).groupBy((F.col("id") % 3).alias("k")).count().count() == 3
    assert spark.conf.get(CLEANUP, None) == was
