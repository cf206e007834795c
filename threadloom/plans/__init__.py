"""Whole jobs."""

from threadloom.plans.jobs import (
    load_both,
    load_posts,
    sample_log,
    threads_with_comments,
    threads_without_comments,
)

__all__ = [
    "load_both",
    "load_posts",
    "sample_log",
    "threads_with_comments",
    "threads_without_comments",
]
