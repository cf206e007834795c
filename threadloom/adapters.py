"""Question-and-answer archives derived from the generic test tables.

``star``: customers ask, orders answer them, suppliers are posts of another type and line items
are comments on the orders, some on customers. Some customers are of another type and some orders go by another
name, on both ends, so that answers and comments without their post occur, and threads without
answers. ``conversation``: a conversation is a thread whose user turns are
questions, so most threads have several. Stacked posts keep the row numbers of their files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import empty_array, format_iso
from threadloom.schemas import COMMENT_FIELDS, COMMENT_LIST, POST_FIELDS, ROW_ID, entity
from threadloom.sources import with_row_id

# Rows of a compressed XML file, at most.
PACKED_ROWS = 50_000


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _as_posts(df: DataFrame, **columns: Column) -> DataFrame:
    typed = [
        columns.get(name, F.lit(None)).cast(dtype).alias(name) for name, _, dtype in POST_FIELDS
    ]
    numbered = with_row_id(df)
    return numbered.select(*typed, empty_array(COMMENT_LIST).alias("comments"), ROW_ID)


def _prefixed(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _day_after_2000(column: str) -> Column:
    start = F.lit("2000-01-01").cast("date")
    return F.date_add(start, F.col(column).cast("int") % 9000).cast("timestamp_ntz")


def star_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = _as_posts(
        source_table(spark, sf_dir, "customer"),
        id=_prefixed("c", "c_custkey"),
        pos_type_id=F.when(F.col("c_custkey") % 7 == 0, "4").otherwise("1"),
        title=F.col("c_name"),
        tags=F.concat(F.lit("<"), F.col("c_mktsegment"), F.lit(">")),
        view_count=F.col("c_nationkey"),
        accepted_answer_id=_prefixed("o", "c_custkey"),
        owner_display_name=F.concat(F.lit("owner "), F.col("c_mktsegment")),
        answer_count=F.col("c_custkey") % 11,
        comment_count=F.col("c_custkey") % 13,
        favorite_count=F.col("c_custkey") % 17,
        closed_date=F.when(F.col("c_custkey") % 3 == 0, _day_after_2000("c_custkey")),
        community_owned_date=F.when(F.col("c_custkey") % 4 == 0, _day_after_2000("c_nationkey")),
    )
    renamed = F.col("o_custkey") % 5 == 0
    answers = _as_posts(
        source_table(spark, sf_dir, "orders"),
        id=F.concat(F.when(renamed, "x").otherwise("o"), F.col("o_orderkey").cast("string")),
        pos_type_id=F.lit("2"),
        parent_id=F.concat(F.when(renamed, "n").otherwise("c"), F.col("o_custkey").cast("string")),
        creation_date=F.col("o_orderdate"),
        score=F.floor(F.col("o_totalprice") / 1000),
        title=F.col("o_orderpriority"),
        body=F.concat(F.lit("<p>"), F.col("o_orderstatus"), F.lit("</p>\n")),
        owner_user_id=F.col("o_custkey"),
        last_editor_user_id=F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")),
        last_editor_display_name=F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")),
        last_edit_date=F.when(F.col("o_orderkey") % 3 == 0, _day_after_2000("o_custkey")),
        last_activity_date=F.col("o_orderdate"),
        deletion_date=F.when(F.col("o_orderkey") % 5 == 0, _day_after_2000("o_custkey")),
    )
    other = _as_posts(
        source_table(spark, sf_dir, "supplier"),
        id=_prefixed("s", "s_suppkey"),
        pos_type_id=F.lit("5"),
        title=F.col("s_name"),
    )
    return reduce(DataFrame.unionByName, [questions, answers, other])


def star_posts_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star posts, with a second post for every answer's id, a day later."""
    posts = star_posts(spark, sf_dir)
    again = posts.where("pos_type_id = '2'").withColumns(
        {
            "title": F.concat("title", F.lit(" again")),
            "creation_date": F.col("creation_date") + F.expr("interval 1 day"),
            ROW_ID: F.xxhash64(ROW_ID, F.lit("again")),
        }
    )
    return posts.unionByName(again)


def star_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = source_table(spark, sf_dir, "lineitem")
    return items.select(
        F.concat_ws(
            "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")]
        ).alias("id"),
        F.when(F.col("l_linenumber") == 7, _prefixed("c", "l_suppkey"))
        .otherwise(_prefixed("o", "l_orderkey"))
        .alias("post_id"),
        F.col("l_linenumber").cast("bigint").alias("score"),
        F.concat("l_returnflag", F.lit(" & "), "l_linestatus").alias("text"),
        F.col("l_shipdate").alias("creation_date"),
        F.concat(F.lit("user "), F.col("l_linestatus")).alias("user_display_name"),
        F.col("l_suppkey").cast("string").alias("user_id"),
    )


def conversation_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as posts; ``thread_id`` and ``turn`` give the thread and its order."""
    turns = source_table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "1").when(F.col("role") == "assistant", "2")
    posts = turns.withColumns(
        {
            "_id": F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")),
            "_kind": kind.otherwise("4"),
        }
    )
    typed = [
        {"id": F.col("_id"), "pos_type_id": F.col("_kind"), "body": F.col("text")}
        .get(name, F.lit(None))
        .cast(dtype)
        .alias(name)
        for name, _, dtype in POST_FIELDS
    ]
    thread = F.col("conv_id").cast("string").alias("thread_id")
    return posts.select(*typed, thread, F.col("turn"))


def _escaped(text: Column) -> Column:
    # The characters an attribute must escape.
    pairs = (
        ("&", "&amp;"),
        ("<", "&lt;"),
        (">", "&gt;"),
        ('"', "&quot;"),
        ("\n", "&#xA;"),
        ("\r", "&#xD;"),
        ("\t", "&#x9;"),
    )
    return reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), pairs, text)


def xml_lines(df: DataFrame, name: str) -> DataFrame:
    """Each row as one ``<row .../>`` line; null columns have no attribute."""
    kinds = {f.name: f.dataType.typeName() for f in entity(name).schema.fields}
    fields = POST_FIELDS if name == "post" else COMMENT_FIELDS
    attributes = []
    for column, attribute, _ in fields:
        is_date = kinds[column] == "timestamp_ntz"
        text = format_iso(column) if is_date else F.col(column).cast("string")
        # numbers and dates have nothing to escape
        text = _escaped(text) if kinds[column] == "string" else text
        attributes.append(F.concat(F.lit(f'{attribute}="'), text, F.lit('"')))
    return df.select(F.concat_ws(" ", F.lit("<row"), *attributes, F.lit("/>")).alias("value"))


def write_xml(df: DataFrame, name: str, path: str, *, packed: bool = False) -> str:
    """Write rows as XML lines, one part file per task, and return the path. ``packed`` compresses
    them; a compressed file is read by one task, so a task then writes several."""
    writer = xml_lines(df, name).write
    if packed:
        # the quick level takes no longer than plain text
        gzip = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
        writer = writer.options(**gzip, maxRecordsPerFile=PACKED_ROWS)
    writer.text(path)
    return path
