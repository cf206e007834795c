"""Document fingerprints from closed syncmers.

A stretch of ``K`` characters is an anchor when the least of its inner stretches of ``S``
characters is its first or its last. Whether it is depends on those ``K`` characters alone, so
text that is moved or edited elsewhere keeps its anchors, at shifted places. About two in
``K - S + 2`` places are anchors.

A fingerprint is the sketch of a text's anchors: the least :data:`SKETCH` of their hashes. The
likeness of two fingerprints estimates the share of anchors in common, and is exact for texts with
no more anchors than a sketch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import map_batches, text_of, width

K, S = 24, 8
SKETCH = 64
BASE = 0x9E3779B97F4A7C15
WORD = (1 << 64) - 1
NULL_KEY = -(1 << 63)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def anchors_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a text's anchors.

    A text without any, such as one shorter than ``K``, has itself as its only anchor; an empty
    text has none.
    """
    letters = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    n = len(letters)
    if n >= K:
        hashes, span, power = letters, 1, BASE
        while span < S:  # stretches of 1, 2, 4, ... S characters
            hashes = hashes[:-span] * np.uint64(power) + hashes[span:]
            span, power = 2 * span, power * power & WORD
        inner = mixed(hashes)
        least, held = inner, 1
        while 2 * held <= K - S:
            least, held = np.minimum(least[:-held], least[held:]), 2 * held
        rest = K - S + 1 - held
        least = np.minimum(least[: len(least) - rest], least[rest:])
        edge = (inner[: len(least)] == least) | (inner[K - S :] == least)
        places = np.flatnonzero(edge)
        if len(places):
            whole = np.zeros(len(places), np.uint64)
            for at in range(0, K, S):
                whole = whole * np.uint64(BASE) + inner[places + at]
            return places, mixed(whole)
    if not n:
        return np.zeros(0, np.int64), letters
    powers = np.cumprod(np.full(n, BASE, np.uint64))
    return np.zeros(1, np.int64), mixed(np.sum(letters * powers, keepdims=True, dtype=np.uint64))


def sketch_of(text: str) -> np.ndarray:
    """A text's fingerprint as numbers."""
    _, hashes = anchors_of(text)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 4 * SKETCH:
        # repeats may crowd the least ones out, so look further only if they do
        least = np.unique(np.partition(short, 2 * SKETCH)[: 2 * SKETCH])
        if len(least) >= SKETCH:
            return least[:SKETCH]
    return np.unique(short)[:SKETCH]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Of the least anchors in either sketch, the share that both have; 1 for two empty ones."""
    union = np.union1d(a, b)[:SKETCH]
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both).sum() / len(union))


def written(sketch: np.ndarray) -> str:
    """A fingerprint as text: eight hex digits for each anchor, in ascending order."""
    return sketch.astype(">u4").tobytes().hex()


def anchors(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per anchor: ``key``, ``place`` in characters and ``hash``, for matching by place.

    Texts that are null or empty have none. Repeated rows give their anchors each.
    """

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for keys, texts in batches:
            for name, body in zip(keys, texts, strict=True):
                places, hashes = anchors_of(body)
                yield [name] * len(places), places.tolist(), hashes.view(np.int64).tolist()

    kind = df.schema[key].dataType.simpleString()
    docs = df.select(key, text_of(text).alias("text"))
    return map_batches(docs, task, f"{key} {kind}, place long, hash long")


def beside_next(df: DataFrame, text: str, key: str) -> DataFrame:
    """Texts dealt out and sorted so that every document is followed by its successor.

    Columns ``key``, ``text``, ``bucket`` and ``extra``. Buckets are ranges of keys. A bucket's
    last row, marked ``extra``, is a copy of the first document of the next one; the last bucket's
    is the very first document. Only the buckets' bounds and least keys, whose number the session's
    shuffle width sets, reach the driver.
    """
    buckets = 4 * width(df.sparkSession)
    docs = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)).alias("key"),
        F.col(key).isNull().alias("keyless"),
        text_of(text).alias("text"),
    )
    chances = [i / buckets for i in range(1, buckets)]
    found = docs.stat.approxQuantile("key", chances, 0.5 / buckets)
    bounds = sorted({int(b) for b in found})
    if bounds:
        all_bounds = F.array(*[F.lit(b).cast("long") for b in bounds])
        bucket = F.size(F.filter(all_bounds, lambda b: b <= F.col("key")))
    else:
        bucket = F.lit(0)
    docs = docs.withColumn("bucket", bucket)
    least = {
        r["bucket"]: r["least"]
        for r in docs.groupBy("bucket").agg(F.min("key").alias("least")).collect()
    }
    if not least:
        return docs.withColumn("extra", F.lit(False))
    order = sorted(least)
    goes_to = [
        (least[own], before) for before, own in zip([order[-1], *order[:-1]], order, strict=True)
    ]
    homes = F.create_map(*[F.lit(x).cast("long") for pair in goes_to for x in pair])
    # several documents may share a bucket's least key: the one with the least text comes first
    extra = (
        docs.where(F.col("key").isin([k for k, _ in goes_to]))
        .groupBy("key")
        .agg(F.min("text").alias("text"))
        .select("key", F.lit(False).alias("keyless"), "text", homes[F.col("key")].cast("int").alias("bucket"), F.lit(True).alias("extra"))
    )
    dealt = docs.withColumn("extra", F.lit(False)).unionByName(extra)
    return dealt.repartition(width(df.sparkSession), "bucket").sortWithinPartitions(
        "bucket", "extra", "key", "text"
    )


def edits(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every document's fingerprint beside that of its edited text.

    The edited text has its second half, ``floor(n / 2)`` characters, replaced by as many from the
    start of the next document by ascending key, the first one following the last. Returns ``key``,
    ``n_chars``, ``edited``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``. Null texts are empty, null keys come first, rows with equal keys go by text.
    """

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        last = None
        for columns in batches:
            out = []
            for name, keyless, body, bucket, extra in zip(*columns, strict=True):
                sketch = sketch_of(body)
                if last and last[2] == bucket:
                    out.append(compared(last, body, sketch))
                last = None if extra else (None if keyless else name, body, bucket, sketch)
            if out:
                yield tuple(zip(*out, strict=True))

    def compared(own: tuple, after: str, after_sketch: np.ndarray) -> tuple:
        name, body, _, sketch = own
        half = len(body) // 2
        edited = body[: len(body) - half] + after[:half]
        other = sketch if edited == body else sketch_of(edited)
        return (
            name, len(body), edited, written(sketch), written(other),
            likeness(sketch, other), likeness(sketch, after_sketch),
        )

    schema = (
        f"{key} long, n_chars long, edited string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    rows = beside_next(df, text, key).select("key", "keyless", "text", "bucket", "extra")
    return map_batches(rows, task, schema)
