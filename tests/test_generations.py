"""Replacing tables as one generation: whatever step a run breaks off at, readers see all old tables
or all new ones, and the next run removes what is left."""

from pathlib import Path

import pytest

from tests.archive import comment, comments_frame, post, posts_frame
from tests.test_jobs import ANSWERS, COMMENTS, QUESTIONS, dump
from threadloom import generations
from threadloom.generations import POINTERS, VERSIONS, generation
from threadloom.plans import load_posts, threads_with_comments
from threadloom.sinks import stage_table, write_table
from threadloom.sources import read_table

TABLES = ("post", "comment", "thread")


class Killed(BaseException):
    """The process ends here: nothing after it runs, no cleaning up either."""


def first_tables(spark, tmp_path):
    posts = dump(spark, tmp_path, "post", posts_frame(spark, QUESTIONS + ANSWERS))
    comments = dump(spark, tmp_path, "comment", comments_frame(spark, COMMENTS))
    return posts, comments


def second_tables(spark, tmp_path):
    folder = tmp_path / "second"
    folder.mkdir(exist_ok=True)
    posts = dump(spark, folder, "post", posts_frame(spark, [post("n1", "1"), post("n2", "2", "n1")]))
    comments = dump(spark, folder, "comment", comments_frame(spark, [comment("k", "n2")]))
    return posts, comments


def counts(spark, **where):
    return tuple(read_table(spark, where.get("base"), t, database=where.get("database")).count() for t in TABLES)


OLD, NEW = (24, 5, 6), (2, 1, 1)


def kill_at(monkeypatch, kind, step, after):
    """Make the run end at its ``step``-th call of a writing method, before or after it."""
    calls = [0]

    def killing(method):
        real = getattr(kind, method)

        def run(self, *args, **options):
            calls[0] += 1
            if calls[0] == step and not after:
                raise Killed
            out = real(self, *args, **options)
            if calls[0] == step and after:
                calls[0] += 1
                raise Killed
            return out

        monkeypatch.setattr(kind, method, run)

    for method in ("stage", "_point"):
        killing(method)
    monkeypatch.setattr(kind, "give_up", lambda self: None)
    return calls


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", range(1, 7))
def test_broken_off_at_any_step(spark, tmp_path, step, after):
    base = str(tmp_path / "tables")
    with generation(spark, base) as new:
        stage_table(new, posts_frame(spark, QUESTIONS + ANSWERS), "post")
        stage_table(new, comments_frame(spark, COMMENTS), "comment")
    before = read_table(spark, base, "post").count(), read_table(spark, base, "comment").count()
    assert before == (24, 5)
    patch = pytest.MonkeyPatch()
    kill_at(patch, generations.PathGeneration, step, after)
    killed = False
    try:
        with generation(spark, base) as new:
            stage_table(new, posts_frame(spark, [post("n1", "1")]), "post")
            stage_table(new, comments_frame(spark, [comment("k", "n1")]), "comment")
    except Killed:
        killed = True
    finally:
        patch.undo()
    seen = read_table(spark, base, "post").count(), read_table(spark, base, "comment").count()
    # two tables and the pointer make three steps
    assert killed == (step <= 3)
    assert seen == ((24, 5) if step < 3 or (step == 3 and not after) else (1, 1))
    write_table(comments_frame(spark, COMMENTS[:2]), "comment", base)
    assert read_table(spark, base, "post").count() == seen[0] and read_table(spark, base, "comment").count() == 2
    # the next start removes what nobody names: two tables, and the comments just replaced
    assert len(list(Path(base, VERSIONS).iterdir())) <= 3
    with generation(spark, base):
        pass
    assert len(list(Path(base, VERSIONS).glob("[!.]*"))) == 2 and not list(Path(base, POINTERS).glob("*.draft"))


def test_half_written_pointer(spark, tmp_path):
    """The process ends between writing the pointer and making it visible."""
    base = str(tmp_path / "tables")
    write_table(posts_frame(spark, [post("q", "1")]), "post", base)
    Path(base, POINTERS, "abc.draft").write_text('{"tab')
    assert read_table(spark, base, "post").count() == 1
    write_table(posts_frame(spark, []), "post", base)
    assert read_table(spark, base, "post").count() == 0
    assert not Path(base, POINTERS, "abc.draft").exists()


@pytest.mark.parametrize("catalog", [False, True])
def test_jobs_change_all_tables_or_none(spark, tmp_path, catalog):
    if catalog:
        spark.sql("CREATE DATABASE IF NOT EXISTS generations")
    where = {"database": "generations"} if catalog else {"base": str(tmp_path / "tables")}
    kind = generations.CatalogGeneration if catalog else generations.PathGeneration
    threads_with_comments(spark, *first_tables(spark, tmp_path), count_quality=False, **where)
    assert counts(spark, **where) == OLD
    second = second_tables(spark, tmp_path)
    # posts, rejects, comments, rejects, threads, pointer
    for step in (3, 5, 6):
        patch = pytest.MonkeyPatch()
        kill_at(patch, kind, step, after=False)
        with pytest.raises(Killed):
            threads_with_comments(spark, *second, count_quality=False, **where)
        patch.undo()
        assert counts(spark, **where) == OLD
    threads_with_comments(spark, *second, count_quality=False, **where)
    assert counts(spark, **where) == NEW
    if catalog:
        held = {r[0] for r in spark.table("generations.post_versions").select("version").distinct().collect()}
        assert len(held) == 2  # the one of before goes at the next start
        threads_with_comments(spark, *second, count_quality=False, **where)
        assert len({r[0] for r in spark.table("generations.post_versions").select("version").distinct().collect()}) == 2


def test_an_error_leaves_nothing(spark, tmp_path):
    base = str(tmp_path / "tables")
    write_table(posts_frame(spark, [post("q", "1")]), "post", base)
    with pytest.raises(ValueError, match="stop"), generation(spark, base) as new:
        stage_table(new, posts_frame(spark, []), "post")
        raise ValueError("stop")
    assert read_table(spark, base, "post").count() == 1
    assert len(list(Path(base, VERSIONS).iterdir())) == 1


def test_readers_of_the_run_before_finish(spark, tmp_path):
    base = str(tmp_path / "tables")
    write_table(posts_frame(spark, [post("q", "1")]), "post", base)
    began = read_table(spark, base, "post")
    write_table(posts_frame(spark, [post("q", "1"), post("r", "1")]), "post", base)
    assert began.count() == 1 and read_table(spark, base, "post").count() == 2
    # a table may be made from itself
    write_table(read_table(spark, base, "post").where("id = 'r'"), "post", base)
    assert [r["id"] for r in read_table(spark, base, "post").collect()] == ["r"]


def test_plain_tables_of_the_layout_before(spark, tmp_path):
    base = str(tmp_path / "tables")
    posts_frame(spark, [post("old", "1")]).write.parquet(f"{base}/post")
    assert read_table(spark, base, "post").first()["id"] == "old"
    load_posts(spark, first_tables(spark, tmp_path)[0], base)
    assert read_table(spark, base, "post").count() == 24
    spark.sql("CREATE DATABASE IF NOT EXISTS former")
    comments_frame(spark, COMMENTS).write.saveAsTable("former.comment")
    write_table(comments_frame(spark, COMMENTS[:1]), "comment", database="former")
    assert spark.table("former.comment").count() == 1
    write_table(comments_frame(spark, COMMENTS[:2]), "comment", database="former")
    assert spark.table("former.comment").count() == 2
    assert not spark.catalog.tableExists("former.comment_former")


def test_a_database_table_reads_one_version_only(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS pruned")
    for n in (1, 2):
        write_table(comments_frame(spark, COMMENTS[:n]), "comment", database="pruned")
    plan = spark.table("pruned.comment")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_layout_of_threads_may_change(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS layouts")
    files = first_tables(spark, tmp_path)
    for max_group in (None, 1, None):
        threads_with_comments(spark, *files, database="layouts", count_quality=False, max_group=max_group)
        has_parts = "n_parts" in spark.table("layouts.thread").columns
        assert has_parts == (max_group == 1) and spark.table("layouts.thread").count() >= 6
