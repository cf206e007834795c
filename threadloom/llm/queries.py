"""The operators as queries over whole tables, with SQL checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import (
    alignment,
    best_position,
    bpe,
    interleave,
    language,
    lines,
    mixing,
    packing,
    search,
    simhash,
    substring,
    syncmers,
    token_files,
)
from threadloom.llm.common import free_name
from threadloom.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages that an earlier one has."""
    docs = table(spark, sf_dir, "documents")
    cleaned = substring.drop_repeats(docs)
    return cleaned.select(
        "doc_id",
        "text",
        F.col(free_name("_sentences", docs.columns)).alias("n_sentences"),
        F.col(free_name("_removed", docs.columns)).alias("n_removed"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside its edited text's and the next document's."""
    found = syncmers.edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learnt from three of four folds."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, ~language.in_fold())
    return language.identify(docs, model).select(
        "doc_id", language.in_fold().alias("held_out"), "lang_pred", "score"
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode_decode(docs, bpe.default_path(WORD_VOCABULARY))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash and its group."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(
        "doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id")
    )


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's scores, learnt from six of seven folds."""
    docs = table(spark, sf_dir, "documents")
    allowed = ~language.in_fold(folds=7)
    found = mixing.score(docs, mixing.fit(docs, allowed), allowed)
    return found.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that its source repeats."""
    docs = table(spark, sf_dir, "documents")
    cleaned = lines.drop_lines(docs, host="source")
    n_dropped = F.col(free_name("_dropped", docs.columns)).alias("n_dropped")
    return cleaned.select("doc_id", "source", "text", n_dropped)


OP7_SQL = f"""
WITH pages AS (
    SELECT source, list_distinct(string_split(text, chr(10))) AS lines FROM documents
), totals AS (
    SELECT source, count(*) AS pages FROM pages GROUP BY source
), contained AS (
    SELECT DISTINCT source, page, trim(line) AS line
    FROM (SELECT source, row_number() OVER () AS page, unnest(lines) AS line FROM pages)
), shared AS (
    SELECT source, line, count(*) AS n FROM contained WHERE line <> ''
    GROUP BY source, line HAVING count(*) >= {lines.MIN_PAGES}
), dropped AS (
    SELECT t.source, list(line) AS keys
    FROM shared s JOIN totals t ON s.source IS NOT DISTINCT FROM t.source
    WHERE n > {lines.RATIO}::DOUBLE * pages GROUP BY t.source
), cut AS (
    SELECT doc_id, d.source, text, string_split(text, chr(10)) AS lines,
        coalesce(keys, []) AS keys
    FROM documents d LEFT JOIN dropped x ON d.source IS NOT DISTINCT FROM x.source
), kept AS (
    SELECT *, list_filter(lines, lambda l: NOT list_contains(keys, trim(l))) AS kept FROM cut
)
SELECT doc_id, source,
    CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(kept, chr(10)), '') END AS text,
    coalesce(len(lines) - len(kept), 0) AS n_dropped
FROM kept
"""


def op8_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark text whose id is divisible by 20."""
    queries = table(spark, sf_dir, "benchmark").where("item_id % 20 = 0")
    found = search.top_k(
        table(spark, sf_dir, "documents"), queries, 10, query_key="item_id", query_text="text"
    )
    return found.withColumn("score", F.round("score", 6))


OP8_SQL = f"""
WITH letters AS (
    SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower
), docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), upper, lower),
        '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS terms FROM documents, letters
), stats AS (
    SELECT count(*) AS n, avg(len(terms)) AS average FROM docs
), tf AS (
    SELECT doc_id, any_value(len(terms)) AS length, term, count(*) AS times
    FROM (SELECT doc_id, terms, unnest(terms) AS term FROM docs) GROUP BY doc_id, term
), df AS (
    SELECT term, count(*) AS df FROM tf GROUP BY term
), asked AS (
    SELECT query_id, term, count(*) AS times FROM (
        SELECT item_id AS query_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), upper, lower), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term
        FROM benchmark, letters WHERE item_id % 20 = 0) GROUP BY query_id, term
), scores AS (
    SELECT query_id, doc_id, sum(a.times * ln(1 + (n - df + 0.5) / (df + 0.5)) * t.times
        * ({search.K1} + 1) / (t.times + {search.K1} * (1 - {search.B} + {search.B} * length / average))) AS score
    FROM asked a JOIN tf t USING (term) JOIN df USING (term), stats GROUP BY query_id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scores
)
SELECT query_id, rank::INTEGER AS rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10
"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of 2048."""
    docs = table(spark, sf_dir, "documents")
    return with_crc(packing.pack(docs, bpe.default_path(WORD_VOCABULARY)))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens written to files and read back."""
    folder = scratch_dir(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write_tokens(docs, bpe.default_path(BYTE_VOCABULARY), folder)
    found = token_files.read_tokens(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in two vocabularies aligned, with corpus-wide counts of its links."""
    paths = map(bpe.default_path, (BYTE_VOCABULARY, PIECE_VOCABULARY))
    aligned = alignment.align(table(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    found = alignment.score(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return found.withColumnRenamed("key", "doc_id")


SHARDS = 24


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in shards that all have the mixture of sources."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + F.lit(8)).cast("long")
    slim = docs.select("doc_id", "source", size.alias("size"), F.crc32(text).alias("text_crc32"))
    placed = interleave.interleave(slim, SHARDS, tokens=["doc_id", "size", "text_crc32"])
    return placed.select(
        "row.doc_id",
        "row.size",
        "row.text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _crc32_entry(n: int) -> int:
    """What a byte does to the reflected CRC-32."""
    for _ in range(8):
        n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
    return n


CRC32_SQL = f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda c, b: xor(c >> 8, ({[_crc32_entry(n) for n in range(256)]}::BIGINT[])[1 + (xor(c, b) & 255)])))"""


def _number_sql(digest: str) -> str:
    digits = interleave.DIGITS
    return f"('0x' || {digest}[1:{digits}])::BIGINT / {float(16**digits)}::DOUBLE"


OP12_SQL = f"""
WITH slim AS (
    SELECT doc_id, coalesce('=' || source, 'null') AS source,
        strlen(coalesce(text, '')) + 8 AS size, {CRC32_SQL} AS text_crc32 FROM documents
), copies AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, source, size, text_crc32) - 1 AS copy FROM slim
), keyed AS (
    SELECT *, md5('{interleave.SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || size || '|' || text_crc32
        || '|' || copy) AS token FROM copies
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source
        ORDER BY token, doc_id NULLS FIRST, size, text_crc32, copy) - 1 AS rank,
        count(*) OVER (PARTITION BY source) AS n FROM keyed
), fractions AS (
    SELECT *, (rank + {_number_sql(f"md5('{interleave.SEED}|' || source)")}) / n AS fraction FROM ranked
), placed AS (
    SELECT *, row_number() OVER (ORDER BY fraction, source, rank) - 1 AS position,
        count(*) OVER () AS total FROM fractions
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (position * {SHARDS} // total)::INTEGER AS shard,
    position - ((position * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS} AS slot,
    NULL::INTEGER AS grown_shard
FROM placed
"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    found = best_position.top_k(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "benchmark"),
        10,
        query_key="item_id",
        query_text="text",
    )
    return found.withColumnRenamed("query_id", "item_id")


TERM_SQL = r"[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+"


def _terms_sql(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{best_position.UPPER}', '{best_position.LOWER}')"
    return f"regexp_extract_all({lowered}, '{TERM_SQL}')"


OP13_SQL = f"""
WITH docs AS (
    SELECT doc_id, {_terms_sql('text')} AS terms FROM documents
), stats AS (
    SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0
), tf AS (
    SELECT doc_id, any_value(len(terms)) AS length, term, count(*) AS times
    FROM (SELECT doc_id, terms, unnest(terms) AS term FROM docs) GROUP BY doc_id, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight
    FROM tf, stats GROUP BY term
), asked AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest({_terms_sql('text')}) AS term FROM benchmark) GROUP BY item_id, term
), scores AS (
    SELECT item_id, doc_id, sum(a.times * weight * ((1000000000 * t.times)
        // (1000 * t.times + 8 * (100 - 75 + (75 * length * n_docs) // n_terms))))::BIGINT AS score
    FROM asked a JOIN tf t USING (term) JOIN weights USING (term), stats GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def with_crc(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_substring_dedup,
        op3_fingerprints,
        op4_language,
        op5_bpe,
        op6_lm_scores,
        op7_line_dedup,
        op8_search,
        op9_packing,
        op10_token_files,
        op11_alignment,
        op12_sharding,
        op13_ranked_search,
    )
}
ORACLES: dict[str, str] = {
    "op7_line_dedup": OP7_SQL,
    "op8_search": OP8_SQL,
    "op12_sharding": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
