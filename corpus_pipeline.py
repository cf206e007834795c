"""Cleaning and packing a corpus: documents in, training sequences out.

Every stage takes ``(spark, docs, sf_dir)``. All but the last keep the columns of ``docs``, with
``n_chars`` brought up to date where a text was cut. A document of which nothing is left goes.
Null texts and texts without letters go in the first stage. Columns beside ``doc_id``, ``text``,
``lang``, ``source`` and ``n_chars`` pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import bpe, language, lines, packing, simhash, substring
from threadloom.llm.common import cut, free_name
from threadloom.llm.queries import WORD_VOCABULARY, with_crc

# A text whose likeliest language has a smaller share of its words is rejected.
MIN_SCORE = 0.4
# Near duplicates: words of a shingle, and bits in which linked fingerprints may differ.
SHINGLE, RADIUS = 3, 2


def _tidied(cleaned: DataFrame, added: str, columns: list[str]) -> DataFrame:
    """The original columns, without documents that lost everything; ``added`` is the operator's
    count of what it took."""
    removed = free_name(added, columns)
    left = (F.col(removed) == 0) | (F.trim("text") != "")
    kept = cleaned.where(F.coalesce(left, F.lit(True)))
    if "n_chars" in columns:
        size = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", size.cast(kept.schema["n_chars"].dataType))
    return kept.select(*columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognised language, learnt from the labelled documents."""
    return language.keep(docs, language.fit(docs), MIN_SCORE)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines that a source repeats on many of its pages; copies of a page are one page."""
    cleaned = lines.drop_lines(docs, host="source", distinct_pages=True)
    return _tidied(cleaned, "_dropped", docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each SimHash group the document with the least id, a null id before all others.

    Rows with equal ids and different texts are different documents, of which the one with the
    least hash stands first; so it is with rows that differ in another column only. Of rows that
    are equal throughout one stays.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(*others)) if others else F.lit("")
    mark = F.xxhash64("doc_id", "text").alias("mark")
    whole = F.xxhash64(F.lit("row"), "doc_id", "text", rest).alias("whole")
    keyed = docs.select(F.struct("doc_id", mark, whole).alias("own"), "text")
    found = simhash.near_duplicates(keyed, shingle=SHINGLE, radius=RADIUS, key="own")
    first = found.where("own = component").select("own.mark", "own.whole").distinct()
    first = cut(first, "first-of-group")
    # the caller's columns lie in a struct, where no name can clash
    rows = docs.select(F.struct("*").alias("row"), mark, whole)
    kept = rows.join(first, ["mark", "whole"], "left_semi").dropDuplicates(["mark", "whole"])
    return kept.select("row.*")


def new_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop passages that an earlier document has."""
    return _tidied(substring.drop_repeats(docs), "_removed", docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokens of all documents into sequences of 2048."""
    return with_crc(packing.pack(docs, bpe.default_path(WORD_VOCABULARY)))


STAGES = [
    ("language", known_language),
    ("lines", own_lines),
    ("near duplicates", distinct_documents),
    ("passages", new_passages),
    ("packing", sequences),
]

# Fingerprints, the random field and the tokenizer are beyond SQL; tests compare the stages with
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
