"""Removing passages that stand elsewhere already, by sliding runs of sentences.

A run starts at every sentence and takes the fewest consecutive sentences, two at least, that
together have ``min_words`` words; short sentences that recur by chance are thus never a run of
their own, and a passage gives the same runs wherever it stands. Runs are hashed to 128 bits and
counted over the whole corpus. A run's first occurrence, by document, stays; every sentence
covered by another occurrence goes.

A sentence of more than ``LONG`` words would hide a passage inside it, so it is cut into clauses,
which count as sentences. The cuts depend on the words near them alone: before the word pair with
the least hash of every ``WINDOW`` neighbours. Within a sentence, a passage of over 50 words has the
same cuts wherever it stands, except for its first and last ``WINDOW`` words, and two clauses with
``MIN_WORDS`` words between them. In scripts without blanks between words every character counts as
a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import SLICE_ROWS, cut, free_name, map_batches, text_of, words

MIN_SENTENCES = 2
MIN_WORDS = 20

# A sentence ends at its mark before white space, at a full-width or other mark that needs none
# after it, or at the end of its line.
SENTENCE_END = re.compile(
    r"(?<=[.!?\u2026\u061F\u06D4\u0589])(?=[ \t])"
    r"|(?<=[\u3002\uFF01\uFF0E\uFF1F\uFF61\u0964\u0965\u104B\u17D4\u1362])"
    r"(?![\u3002\uFF01\uFF0E\uFF1F\uFF61\u0964\u0965\u104B\u17D4\u1362\n\u300D\u300F\u201D\u2019)])"
    r"|(?<=\n)(?=[^\n])"
)
# Scripts written without blanks: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
UNSPACED = (
    r"\u0E01-\u0EFF\u0F00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3041-\u30FF\u3400-\u4DBF"
    r"\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF"
)
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
WORD = re.compile(rf"[{UNSPACED}]|[^ \t-\r{UNSPACED}]+")

# Longer sentences, in words, are cut into clauses of at most ``WINDOW`` words.
LONG, WINDOW = 48, 6

# Stands for a null key, which counts as the smallest.
NULL_KEY = -(1 << 63)


def word_count(sentence: str, split: list[bytes]) -> int:
    """The number of words, ``split`` at blanks, or of characters in scripts without blanks."""
    if sentence.isascii() or not HAS_UNSPACED.search(sentence):
        return len(split)
    return sum(1 for _ in WORD.finditer(sentence))


def clauses_of(sentence: str) -> list[str]:
    """A long sentence cut before the least pair of words of every ``WINDOW``; others as they are."""
    # fewer characters cannot hold more words
    if len(sentence) <= LONG:
        return [sentence]
    found = list(WORD.finditer(sentence))
    if len(found) <= LONG:
        return [sentence]
    plain = [m.group().encode().lower() for m in found]
    pairs = [b" ".join(p) for p in zip(plain, plain[1:], strict=False)]
    hashes = np.array([xxhash.xxh64_intdigest(p) for p in pairs], np.uint64)
    least = sliding_window_view(hashes, WINDOW).argmin(axis=1) + np.arange(len(hashes) - WINDOW + 1)
    ends = [found[i].start() for i in np.unique(least).tolist() if i]
    return [sentence[x:y] for x, y in zip([0, *ends], [*ends, len(sentence)], strict=True)]


def sentences_of(text: str) -> list[str]:
    """The sentences of a text, long ones as clauses, with the white space around them; joined
    they are the text."""
    return [c for s in SENTENCE_END.split(text) for c in clauses_of(s)] if text else []


def runs_of(
    sentences: list[str], min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS
) -> list[tuple[int, int, int]]:
    """``(first sentence, end, 128-bit hash)`` of every run."""
    split = [words(s) for s in sentences]
    joined = [b" ".join(w) for w in split]
    sizes = [word_count(s, w) for s, w in zip(sentences, split, strict=True)]
    found, end, held = [], 0, 0
    for first in range(len(split)):
        while end < len(split) and (end - first < min_sentences or held < min_words):
            held += sizes[end]
            end += 1
        if end - first < min_sentences or held < min_words:
            break
        found.append((first, end, xxhash.xxh3_128_intdigest(b"\n".join(joined[first:end]))))
        held -= sizes[first]
    return found


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _cleaned(text: str, repeated: set[int], options: dict) -> tuple[str, int, int]:
    """The text without covered sentences, their number, and the number there was."""
    sentences = sentences_of(text)
    gone, seen = set(), set()
    for first, end, digest in runs_of(sentences, **options):
        if signed(digest >> 64) in repeated or digest in seen:
            gone.update(range(first, end))
        seen.add(digest)
    if not gone:
        return text, 0, len(sentences)
    kept = "".join(s for i, s in enumerate(sentences) if i not in gone)
    return kept, len(gone), len(sentences)


def repeated_runs(df: DataFrame, key: str, text: str, options: dict) -> DataFrame:
    """``_key`` and ``_runs``: for each document the runs that an earlier document has."""

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for keys, texts in batches:
            owners, high, low = [], [], []
            for name, body in zip(keys, texts, strict=True):
                for digest in {d for _, _, d in runs_of(sentences_of(body), **options)}:
                    owners.append(name)
                    high.append(signed(digest >> 64))
                    low.append(signed(digest & (1 << 64) - 1))
            yield owners, high, low

    keyed = df.select(F.coalesce(key, F.lit(NULL_KEY)).alias("key"), text_of(text).alias("text"))
    # written, since counting and looking up both read them: runs are hashed once
    runs = cut(map_batches(keyed, task, "key long, high long, low long"), "runs")
    counted = runs.groupBy("high", "low").agg(
        F.count("*").alias("n"), F.min("key").alias("first_key")
    )
    shared = counted.where("n > 1").select(
        F.col("high").alias("_high"), F.col("low").alias("_low"), "first_key"
    )
    later = runs.join(
        shared,
        (F.col("high") == F.col("_high"))
        & (F.col("low") == F.col("_low"))
        & (F.col("key") > F.col("first_key")),
    )
    # a document's own runs: no more than it has sentences
    return later.groupBy(F.col("key").alias("_key")).agg(F.collect_set("high").alias("_runs"))


def drop_repeats(
    df: DataFrame,
    *,
    min_sentences: int = MIN_SENTENCES,
    min_words: int = MIN_WORDS,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """The rows with repeated passages taken out of ``text``.

    Adds ``_removed`` and ``_sentences``, the numbers of sentences removed and seen. ``key`` is an
    integer that identifies a document and orders occurrences; rows that share it are one document
    and lose nothing to each other. A null key counts as the smallest. A null text stays null and
    has no sentences. Other columns pass through; where one has the name of an added column, that
    one gets an underscore more (``common.free_name``).
    """
    options = {"min_sentences": min_sentences, "min_words": min_words}
    # written first: Spark then knows its size and moves the texts only if it is large
    repeated = cut(repeated_runs(df, key, text, options), "repeated-runs")
    key_name, runs_name, removed, seen = (
        free_name(n, df.columns) for n in ("_key", "_runs", "_removed", "_sentences")
    )
    repeated = repeated.toDF(key_name, runs_name)
    own_key = F.coalesce(df[key], F.lit(NULL_KEY))
    joined = df.join(repeated, own_key == repeated[key_name], "left").drop(key_name)
    place, names = df.columns.index(text), [*df.columns, removed, seen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                texts, runs = batch.column(place).to_pylist(), batch.columns[-1].to_pylist()
                found = [
                    (None, 0, 0) if t is None else _cleaned(t, set(r or ()), options)
                    for t, r in zip(texts, runs, strict=True)
                ]
                columns = batch.columns[:-1]
                columns[place] = pa.array([t for t, _, _ in found], columns[place].type)
                columns.append(pa.array([n for _, n, _ in found], pa.int64()))
                columns.append(pa.array([n for _, _, n in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    number = F.lit(0).cast("long")
    schema = df.select(*df.columns, number.alias(removed), number.alias(seen)).schema
    for field in schema:
        field.nullable = True
    return joined.mapInArrow(run, schema)
