"""Wall seconds of the headline jobs and operators; prints one JSON line.

Inputs come from BENCH_SF_DIR, cores from BENCH_CPUS. XML dumps and typed tables are prepared
outside the timed part. Each entry has one warm-up and is the median of five further runs; quality
counts are on, as by default.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom import adapters as A
from threadloom import plans, sinks, sources
from threadloom.functions import string_hash
from threadloom.operators.comments import nest_comments
from threadloom.operators.duplicates import first_posts
from threadloom.operators.groups import co_group
from threadloom.operators.quality import quality_counts
from threadloom.operators.threads import build_threads
from threadloom.plans.catalog import QUERIES
from threadloom.session import scratch_dir, session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def drain(df: DataFrame) -> None:
    """Compute every column of every row and throw the rows away."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    star = A.star_posts(spark, SF_DIR)
    star_comments = A.star_comments(spark, SF_DIR)
    posts_xml = A.write_xml(star, "post", scratch_dir(spark, "bench-posts"))
    comments_xml = A.write_xml(star_comments, "comment", scratch_dir(spark, "bench-comments"))
    copies = A.star_posts_with_copies(spark, SF_DIR)
    copies_xml = A.write_xml(copies, "post", scratch_dir(spark, "bench-copies"))
    base = scratch_dir(spark, "bench-tables")
    sinks.write_table(star, "post", base)
    sinks.write_table(star_comments, "comment", base)
    posts = sources.read_table(spark, base, "post").drop("comments")
    comments = sources.read_table(spark, base, "comment")
    documents = A.source_table(spark, SF_DIR, "documents")

    def scan(path: str, name: str, **options) -> DataFrame:
        rows = sources.scan_rows(spark, path, name, **options)
        return sources.accepted(sources.type_records(rows, name))

    def job(run, *paths: str, **options) -> None:
        run(spark, *paths, scratch_dir(spark, "bench-job"), **options)

    entries = {
        "a2_scan_posts": lambda: drain(scan(posts_xml, "post", one_row_per_line=True)),
        "a2_scan_posts_any_layout": lambda: drain(scan(posts_xml, "post")),
        "a3_scan_comments": lambda: drain(scan(comments_xml, "comment")),
        "b11_hash_documents": lambda: drain(documents.select(string_hash("text").alias("h"))),
        "e1_cogroup": lambda: drain(
            co_group({"posts": (posts, "id"), "comments": (comments, "post_id")})
        ),
        "e2_nest_comments": lambda: drain(nest_comments(posts, comments)),
        "e4_threads": lambda: drain(build_threads(posts)),
        "e4_threads_with_comments": lambda: drain(build_threads(posts, comments)),
        "f4_first_posts": lambda: drain(first_posts(A.star_posts_with_copies(spark, SF_DIR))),
        "g_quality_counts": lambda: quality_counts(posts, comments).agg(F.sum("n")).collect(),
        "i1_load_posts": lambda: job(plans.load_posts, posts_xml),
        "i2_load_both": lambda: job(plans.load_both, posts_xml, comments_xml),
        "i3_threads": lambda: job(plans.threads_without_comments, posts_xml, comments_xml),
        "i4_threads_with_comments": lambda: job(
            plans.threads_with_comments, posts_xml, comments_xml
        ),
        "i4_repeated_ids": lambda: job(plans.threads_with_comments, copies_xml, comments_xml),
        "e4_hot_thread": lambda: drain(QUERIES["e4_hot_thread"](spark, SF_DIR)),
    }
    seconds = {}
    for name, run in entries.items():
        run()
        times = []
        for _ in range(5):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(median(times), 3)
    report = {
        "metric": "total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "rows": {"posts": posts.count(), "comments": comments.count()},
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
