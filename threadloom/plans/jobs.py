"""The jobs, from XML files to replaced tables.

Each scan is landed as a typed table first and read back for the thread build: the XML is parsed
once, and everything downstream reads only the columns it needs. A job's tables are one generation:
readers see all of them change in one step at its end, or none.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.generations import Generation, generation
from threadloom.operators.quality import (
    quality_counts,
    require_comment_keys,
    require_keys,
    routing_counts,
)
from threadloom.operators.routing import sample_lines
from threadloom.operators.threads import build_threads
from threadloom.schemas import entity
from threadloom.session import freed_shuffles, job_folder, sized_shuffle, stored_bytes
from threadloom.sinks import stage_rejects, stage_scan, stage_table
from threadloom.sinks.tables import ASIDE
from threadloom.sources import (
    head_counts,
    is_rejected,
    read_lines,
    rejects,
    scan_rows,
    type_records,
)

# Typed rows stay compressed in the tables; a shuffle moves them at about this multiple.
SHUFFLE_EXPANSION = 3


@dataclass
class Report:
    """Counts of one run, by table for the scans and by channel for data quality."""

    scans: dict[str, dict[str, int]] = field(default_factory=dict)
    quality: dict[str, int] = field(default_factory=dict)


def sample_log(spark: SparkSession, path: str, modulus: int = 100) -> DataFrame:
    """The repeatable line sample of a text file, for a first look at it."""
    return sample_lines(read_lines(spark, path), modulus)


def _load(
    spark: SparkSession,
    report: Report,
    name: str,
    path: str,
    new: Generation,
    *,
    strict: bool = False,
    alias_editor: bool = False,
    **layout,
) -> None:
    """Stage one typed table and its rejects. One pass over the file writes the table, counts, and
    puts aside the lines that are no good rows, of which the rejects are made."""
    scan = scan_rows(spark, path, name, strict=strict, alias_editor=alias_editor, **layout)
    typed = type_records(scan, name, strict=strict, alias_editor=alias_editor)
    seen, good = Observation(), F.col("reason").isNull()
    typed = typed.observe(
        seen,
        F.count("*").alias("pieces"),
        F.count_if(is_rejected()).alias("rejected"),
        *head_counts(),
        F.count_if(good & (F.col("bad_values") > 0)).alias("rows_with_bad_values"),
    )
    routed = None
    if strict:
        typed = (require_keys if name == "post" else require_comment_keys)(typed, good)
    if name == "post":
        routed = Observation()
        typed = typed.observe(routed, *routing_counts(good))

    def broken_heads() -> int:
        return seen.get["heads"] - seen.get["headed_files"]

    def check() -> None:
        if strict and broken_heads():
            raise ValueError(f"{path}: {broken_heads()} broken rows without content")

    stage_scan(new, typed, name, check=check)
    counts = seen.get
    report.scans[name] = {
        "lines": counts["pieces"] - counts["headed_files"],
        "rejected": counts["rejected"] + broken_heads(),
        "rows_with_bad_values": counts["rows_with_bad_values"],
    }
    if routed is not None:
        report.quality.update(routed.get)
    stage_rejects(new, rejects(new.read_aside(name, ASIDE)), name)
    new.drop_aside(name)


def load_posts(
    spark: SparkSession,
    posts_path: str,
    base: str | None = None,
    *,
    database: str | None = None,
    **options,
) -> Report:
    """Posts XML to the ``post`` table.

    Options of all jobs: ``database`` writes catalog tables instead of Parquet below ``base``;
    ``strict`` fails on a bad row, value or key; ``alias_editor`` gives the editor's id as the
    owner's display name; ``one_row_per_line``, ``root`` and ``record`` describe the files.
    """
    report = Report()
    with job_folder(spark), generation(spark, base, database=database) as new:
        _load(spark, report, "post", posts_path, new, **options)
    return report


def load_both(
    spark: SparkSession,
    posts_path: str,
    comments_path: str,
    base: str | None = None,
    *,
    database: str | None = None,
    **options,
) -> Report:
    """Posts and comments XML to the ``post`` and ``comment`` tables."""
    report = Report()
    with job_folder(spark), generation(spark, base, database=database) as new:
        _load_both(spark, report, posts_path, comments_path, new, **options)
    return report


def _load_both(
    spark: SparkSession,
    report: Report,
    posts_path: str,
    comments_path: str,
    new: Generation,
    **options,
) -> None:
    _load(spark, report, "post", posts_path, new, **options)
    _load(spark, report, "comment", comments_path, new, **options)


def _stage_threads(
    spark: SparkSession,
    report: Report,
    new: Generation,
    *,
    with_comments: bool,
    count_quality: bool,
    max_group: int | None,
) -> None:
    posts, comments = (new.read(t, entity(t).schema) for t in ("post", "comment"))
    shuffled = ["post", "comment"] if with_comments else ["post"]
    # a catalog table's files are not listed
    paths = [new.path(t) for t in shuffled] if hasattr(new, "path") else []
    stored = stored_bytes(spark, *paths) if paths else 0
    with freed_shuffles(spark), sized_shuffle(spark, SHUFFLE_EXPANSION * stored):
        threads = build_threads(
            posts.drop("comments"), comments if with_comments else None, max_group=max_group
        )
        kind = "thread" if max_group is None else "thread_part"
        stage_table(new, threads, kind, table="thread")
        if count_quality:
            counts = quality_counts(posts, comments, dedupe=with_comments)
            # one row per channel, a fixed handful
            report.quality.update({r["channel"]: r["n"] for r in counts.collect()})


def threads_without_comments(
    spark: SparkSession,
    posts_path: str,
    comments_path: str,
    base: str | None = None,
    *,
    database: str | None = None,
    count_quality: bool = True,
    max_group: int | None = None,
    **options,
) -> Report:
    """Replace ``post``, ``comment`` and ``thread``; every post counts and comments stay empty.

    A thread is one row. With ``max_group``, larger ones come in parts, and all rows of the table
    have ``thread_key``, ``part`` and ``n_parts`` in front.
    """
    report = Report()
    with job_folder(spark), generation(spark, base, database=database) as new:
        _load_both(spark, report, posts_path, comments_path, new, **options)
        _stage_threads(
            spark,
            report,
            new,
            with_comments=False,
            count_quality=count_quality,
            max_group=max_group,
        )
    return report


def threads_with_comments(
    spark: SparkSession,
    posts_path: str,
    comments_path: str,
    base: str | None = None,
    *,
    database: str | None = None,
    count_quality: bool = True,
    max_group: int | None = None,
    **options,
) -> Report:
    """Replace ``post``, ``comment`` and ``thread``, whose posts carry their comments; see
    :func:`threads_without_comments`."""
    report = Report()
    with job_folder(spark), generation(spark, base, database=database) as new:
        _load_both(spark, report, posts_path, comments_path, new, **options)
        _stage_threads(
            spark,
            report,
            new,
            with_comments=True,
            count_quality=count_quality,
            max_group=max_group,
        )
    return report
