"""Every operator and job as a query over the generic test tables, with its check in SQL.

Nested results are flattened so that both engines return plain rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import adapters as A
from threadloom import plans, sinks, sources
from threadloom.functions import (
    format_iso,
    map_array,
    or_empty,
    parse_iso,
    string_hash,
    to_bigint,
    to_int,
)
from threadloom.operators import comments as nesting
from threadloom.operators import quality, routing
from threadloom.operators.duplicates import first_posts, repeated_ids
from threadloom.operators.groups import co_group, group_by_key
from threadloom.operators.rows import comment_row, post_row, thread_row
from threadloom.operators.skew import MAX_GROUP
from threadloom.operators.threads import (
    build_threads,
    flatten_threads,
    missing_question_keys,
    orphan_answers,
)
from threadloom.schemas import COMMENT_LIST, ROW_ID
from threadloom.session import job_folder, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str, *ctes: str) -> Callable[[Query], Query]:
    """Register a query with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLES[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + " ".join(oracle.split())
        return fn

    return register


# --- the adapters of threadloom.adapters, in SQL ------------------------------------------------

def _day_sql(column: str) -> str:
    return f"(DATE '2000-01-01' + CAST({column} % 9000 AS INTEGER))::TIMESTAMP"


POSTS_SELECT = f"""
  SELECT 'c' || c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN '4' ELSE '1' END AS pos_type_id,
    CAST(NULL AS VARCHAR) AS parent_id, CAST(NULL AS TIMESTAMP) AS creation_date,
    CAST(NULL AS INTEGER) AS score, c_nationkey AS view_count, CAST(NULL AS VARCHAR) AS body,
    CAST(NULL AS VARCHAR) AS owner_user_id, CAST(NULL AS VARCHAR) AS last_editor_user_id,
    c_name AS title, '<' || c_mktsegment || '>' AS tags,
    'o' || c_custkey AS accepted_answer_id, 'owner ' || c_mktsegment AS owner_display_name,
    CAST(c_custkey % 11 AS INTEGER) AS answer_count,
    CAST(c_custkey % 13 AS INTEGER) AS comment_count,
    CAST(c_custkey % 17 AS INTEGER) AS favorite_count,
    CASE WHEN c_custkey % 3 = 0 THEN {_day_sql('c_custkey')} END AS closed_date,
    CASE WHEN c_custkey % 4 = 0 THEN {_day_sql('c_nationkey')} END AS community_owned_date,
    CAST(NULL AS VARCHAR) AS last_editor_display_name, CAST(NULL AS TIMESTAMP) AS last_edit_date,
    CAST(NULL AS TIMESTAMP) AS last_activity_date, CAST(NULL AS TIMESTAMP) AS deletion_date
  FROM customer
  UNION ALL
  SELECT CASE WHEN o_custkey % 5 = 0 THEN 'x' ELSE 'o' END || o_orderkey, '2',
    CASE WHEN o_custkey % 5 = 0 THEN 'n' ELSE 'c' END || o_custkey, o_orderdate,
    CAST(floor(o_totalprice / 1000) AS INTEGER), NULL, '<p>' || o_orderstatus || '</p>' || chr(10),
    CAST(o_custkey AS VARCHAR), CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END,
    o_orderpriority, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END,
    CASE WHEN o_orderkey % 3 = 0 THEN {_day_sql('o_custkey')} END, o_orderdate,
    CASE WHEN o_orderkey % 5 = 0 THEN {_day_sql('o_custkey')} END
  FROM orders
  UNION ALL
  SELECT 's' || s_suppkey, '5', NULL, NULL, NULL, NULL, NULL, NULL, NULL, s_name, NULL, NULL, NULL,
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM supplier"""
COPIES_SELECT = """
  SELECT * FROM posts
  UNION ALL
  SELECT * REPLACE (creation_date + INTERVAL 1 DAY AS creation_date, title || ' again' AS title)
  FROM posts WHERE pos_type_id = '2'"""


def _one_line(sql: str) -> str:
    return " ".join(sql.split())


POSTS = _one_line(f"posts AS ({POSTS_SELECT})")
COPIES = _one_line(f"copies AS ({COPIES_SELECT})")
COMMENTS = _one_line(
    """comments AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id,
    CASE l_linenumber WHEN 7 THEN 'c' || l_suppkey ELSE 'o' || l_orderkey END AS post_id,
    CAST(l_linenumber AS BIGINT) AS score, 'user ' || l_linestatus AS user_display_name,
    l_returnflag || ' & ' || l_linestatus AS text, l_shipdate AS creation_date,
    CAST(l_suppkey AS VARCHAR) AS user_id FROM lineitem)"""
)
QUESTIONS = "questions AS (SELECT * FROM posts WHERE pos_type_id = '1')"
ANSWERS = "answers AS (SELECT * FROM posts WHERE pos_type_id = '2')"
TURNS = _one_line(
    """turns AS (SELECT conv_id || '-' || turn AS id, CAST(conv_id AS VARCHAR) AS thread_id, turn,
    text, CASE role WHEN 'user' THEN '1' WHEN 'assistant' THEN '2' ELSE '4' END AS kind
    FROM conversations)"""
)


def _iso_sql(column: str) -> str:
    return f"rtrim(rtrim(strftime({column}, '%Y-%m-%dT%H:%M:%S.%f'), '0'), '.')"


def _hash_sql(column: str) -> str:
    folded = (
        f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({column}, ''), "
        "lambda x: unicode(x)::BIGINT)), lambda a, b: (a * 31 + b) % 4294967296)"
    )
    return f"CASE WHEN {folded} >= 2147483648 THEN {folded} - 4294967296 ELSE {folded} END"


OTHER_DATES = (
    "closed_date",
    "community_owned_date",
    "last_edit_date",
    "last_activity_date",
    "deletion_date",
)

# Rows shown by the queries about whole posts and comments.
POST_VIEW = f"""id, pos_type_id, parent_id, {_iso_sql('creation_date')} AS creation_date, score,
  view_count, body, owner_user_id, last_editor_user_id, title, tags, accepted_answer_id,
  owner_display_name, answer_count, comment_count, favorite_count, last_editor_display_name,
  {", ".join(f"{_iso_sql(c)} AS {c}" for c in OTHER_DATES)}"""
COMMENT_VIEW = f"""id, post_id, score, text, {_iso_sql('creation_date')} AS creation_date,
  user_id, user_display_name"""


def _post_view(posts: DataFrame, *more: Column) -> DataFrame:
    return posts.select(
        "id",
        "pos_type_id",
        "parent_id",
        format_iso("creation_date").alias("creation_date"),
        "score",
        "view_count",
        "body",
        "owner_user_id",
        "last_editor_user_id",
        "title",
        "tags",
        "accepted_answer_id",
        "owner_display_name",
        "answer_count",
        "comment_count",
        "favorite_count",
        "last_editor_display_name",
        *[format_iso(c).alias(c) for c in OTHER_DATES],
        *more,
    )


def _comment_view(comments: DataFrame) -> DataFrame:
    date = format_iso("creation_date").alias("creation_date")
    return comments.select("id", "post_id", "score", "text", date, "user_id", "user_display_name")


THREAD_VIEW = """SELECT q.id AS question_id, q.title AS question_title, a.id AS answer_id,
  a.title AS answer_title FROM questions q LEFT JOIN answers a ON a.parent_id = q.id"""
FULL_THREAD_VIEW = """SELECT q.id AS question_id, a.id AS answer_id, a.score AS answer_score,
  c.id AS comment_id, c.text AS comment_text FROM questions q
  LEFT JOIN answers a ON a.parent_id = q.id LEFT JOIN comments c ON c.post_id = a.id
  UNION ALL SELECT q.id, NULL, NULL, c.id, c.text FROM questions q
  JOIN comments c ON c.post_id = q.id"""


def _thread_view(flat: DataFrame) -> DataFrame:
    return flat.select(
        F.col("question.id").alias("question_id"),
        F.col("question.title").alias("question_title"),
        F.col("answer.id").alias("answer_id"),
        F.col("answer.title").alias("answer_title"),
    )


def _full_thread_view(threads: DataFrame) -> DataFrame:
    """A row for each answer's comments, and one for each of the question's."""
    answers = flatten_threads(threads).select(
        F.col("question.id").alias("question_id"),
        F.col("answer.id").alias("answer_id"),
        F.col("answer.score").alias("answer_score"),
        F.explode_outer("answer.comments").alias("comment"),
    )
    asked = threads.where("part = 0").select(
        F.col("question.id").alias("question_id"),
        F.lit(None).cast("string").alias("answer_id"),
        F.lit(None).cast("int").alias("answer_score"),
        F.explode("question.comments").alias("comment"),
    )
    return answers.unionByName(asked).select(
        "question_id",
        "answer_id",
        "answer_score",
        F.col("comment.id").alias("comment_id"),
        F.col("comment.text").alias("comment_text"),
    )


def _stored(spark: SparkSession, base: str) -> DataFrame:
    """A stored thread table with the columns that ``build_threads`` gave it."""
    rows = sources.read_table(spark, base, "thread")
    return rows.select(
        F.col("question.id").alias("thread_key"),
        F.lit(0).alias("part"),
        F.size("answers").alias("n_answers"),
        "question",
        "answers",
    )


def _stored_flat(spark: SparkSession, base: str) -> DataFrame:
    """A stored thread table flattened as ``flatten_threads`` does, whether or not a thread
    comes as several rows: it is without answers only if all its rows are."""
    rows = sources.read_table(spark, base, "thread")
    question = F.struct("question.id", "question.title").alias("question")
    answers = rows.select(question, F.explode("answers").alias("answer"))
    sizes = rows.select(question, F.size("answers.id").alias("n"))
    totals = sizes.groupBy("question").agg(F.sum("n").alias("n"))
    no_answer = F.lit(None).cast(answers.schema["answer"].dataType).alias("answer")
    return answers.unionByName(totals.where("n = 0").select("question", no_answer))


def _one_line_text() -> Column:
    return F.translate(F.coalesce("text", F.lit("")), "\n\r", "  ")


ONE_LINE_TEXT = "replace(replace(coalesce(text, ''), chr(10), ' '), chr(13), ' ')"


def _text_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "lines")
    turns = A.source_table(spark, sf_dir, "conversations")
    turns.select(_one_line_text().alias("value")).write.text(path)
    return path


def _posts_xml(spark: SparkSession, sf_dir: str, *, packed: bool = False) -> str:
    path = scratch_dir(spark, "posts-xml")
    return A.write_xml(A.star_posts(spark, sf_dir), "post", path, packed=packed)


def _comments_xml(spark: SparkSession, sf_dir: str, *, packed: bool = False) -> str:
    path = scratch_dir(spark, "comments-xml")
    return A.write_xml(A.star_comments(spark, sf_dir), "comment", path, packed=packed)


# --- scans ----------------------------------------------------------------------------------


@query("a1_text_lines", f"SELECT {ONE_LINE_TEXT} AS line FROM conversations")
def a1_text_lines(spark, sf_dir):
    return sources.read_lines(spark, _text_file(spark, sf_dir)).select(F.col("value").alias("line"))


@query("a2_xml_posts", f"SELECT {POST_VIEW} FROM posts", POSTS)
def a2_xml_posts(spark, sf_dir):
    scan = sources.scan_rows(spark, _posts_xml(spark, sf_dir), "post")
    return _post_view(sources.accepted(sources.type_records(scan, "post")))


@query("a2_xml_posts_any_layout", f"SELECT {POST_VIEW} FROM posts", POSTS)
def a2_xml_posts_any_layout(spark, sf_dir):
    path = scratch_dir(spark, "posts-xml")
    lines = A.xml_lines(A.star_posts(spark, sf_dir), "post")
    spanning = lines.select(F.replace("value", F.lit(" PostTypeId="), F.lit("\n  PostTypeId=")))
    spanning.write.option("lineSep", " ").text(path)
    scan = sources.scan_rows(spark, path, "post")
    return _post_view(sources.accepted(sources.type_records(scan, "post")))


@query("a3_xml_comments", f"SELECT {COMMENT_VIEW} FROM comments", COMMENTS)
def a3_xml_comments(spark, sf_dir):
    scan = sources.scan_rows(spark, _comments_xml(spark, sf_dir), "comment")
    return _comment_view(sources.accepted(sources.type_records(scan, "comment")))


@query(
    "a6_xml_rejects",
    """SELECT CASE o_orderkey % 97
        WHEN 0 THEN '<row Id="' || o_orderkey || '"/><row Id="0"/>'
        WHEN 1 THEN '<row Id="' || o_orderkey || '"'
        WHEN 2 THEN '<row Id="' || o_orderkey || '" Id="0"/>'
        ELSE '<rows Id="' || o_orderkey || '"/>' END AS line,
      CASE o_orderkey % 97 WHEN 2 THEN 'corrupt' ELSE 'layout' END AS reason
    FROM orders WHERE o_orderkey % 97 < 4""",
)
def a6_xml_rejects(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 97
    line = (
        F.when(kind == 0, F.concat(F.lit('<row Id="'), key, F.lit('"/><row Id="0"/>')))
        .when(kind == 1, F.concat(F.lit('<row Id="'), key, F.lit('"')))
        .when(kind == 2, F.concat(F.lit('<row Id="'), key, F.lit('" Id="0"/>')))
        .when(kind == 3, F.concat(F.lit('<rows Id="'), key, F.lit('"/>')))
        .otherwise(F.concat(F.lit('<row Id="'), key, F.lit('"/>')))
    )
    path = scratch_dir(spark, "broken-xml")
    A.source_table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return sources.rejects(sources.scan_rows(spark, path, "post", one_row_per_line=True))


# --- columns --------------------------------------------------------------------------------


@query(
    "b1_parse_iso_ts",
    f"SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN {_iso_sql('ts')} END AS parsed FROM events",
)
def b1_parse_iso_ts(spark, sf_dir):
    offset = F.when(F.col("event_id") % 3 == 0, "Z").when(F.col("event_id") % 3 == 1, "")
    text = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), offset.otherwise("+02:00")
    )
    events = A.source_table(spark, sf_dir, "events")
    return events.select("event_id", format_iso(parse_iso(text)).alias("parsed"))


@query("b2_format_iso_ts", f"SELECT event_id, {_iso_sql('ts')} AS printed FROM events")
def b2_format_iso_ts(spark, sf_dir):
    events = A.source_table(spark, sf_dir, "events")
    return events.select("event_id", format_iso("ts").alias("printed"))


NUMBER_TEXT = """CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN CAST(user_id AS VARCHAR)
  WHEN 2 THEN '' WHEN 3 THEN event_id || '0000000000' ELSE ' ' || user_id || ' ' END"""


def _number_text() -> Column:
    kind = F.col("event_id") % 5
    return (
        F.when(kind == 0, F.col("event_type"))
        .when(kind == 1, F.col("user_id").cast("string"))
        .when(kind == 2, "")
        .when(kind == 3, F.concat(F.col("event_id").cast("string"), F.lit("0000000000")))
        .otherwise(F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
    )


@query(
    "b3_int_cast",
    f"SELECT event_id, TRY_CAST({NUMBER_TEXT} AS INTEGER) AS number FROM events",
)
def b3_int_cast(spark, sf_dir):
    events = A.source_table(spark, sf_dir, "events")
    return events.select("event_id", to_int(_number_text()).alias("number"))


@query(
    "b4_score_coerce",
    f"SELECT event_id, TRY_CAST({NUMBER_TEXT} AS BIGINT) AS score FROM events",
)
def b4_score_coerce(spark, sf_dir):
    events = A.source_table(spark, sf_dir, "events")
    return events.select("event_id", to_bigint(_number_text()).alias("score"))


@query("b5_post_row", f"SELECT {POST_VIEW}, 0 AS n_comments FROM posts", POSTS)
def b5_post_row(spark, sf_dir):
    rows = post_row(A.star_posts(spark, sf_dir))
    return _post_view(rows, F.size("comments").alias("n_comments"))


@query("b6_comment_row", f"SELECT {COMMENT_VIEW} FROM comments", COMMENTS)
def b6_comment_row(spark, sf_dir):
    return _comment_view(comment_row(A.star_comments(spark, sf_dir)))


@query(
    "b7_thread_row",
    """SELECT q.id AS question_id, q.view_count AS question_view_count, a.id AS answer_id,
      a.score AS answer_score FROM questions q JOIN answers a ON a.parent_id = q.id""",
    POSTS,
    QUESTIONS,
    ANSWERS,
)
def b7_thread_row(spark, sf_dir):
    rows = thread_row(build_threads(A.star_posts(spark, sf_dir)))
    return rows.select("question", F.explode("answers").alias("answer")).select(
        F.col("question.id").alias("question_id"),
        F.col("question.view_count").alias("question_view_count"),
        F.col("answer.id").alias("answer_id"),
        F.col("answer.score").alias("answer_score"),
    )


@query(
    "b8_array_map",
    """SELECT p.id, lower(c.text) || ' by ' || c.user_id AS label
    FROM posts p JOIN comments c ON c.post_id = p.id""",
    POSTS,
    COMMENTS,
)
def b8_array_map(spark, sf_dir):
    nested = nesting.nest_comments(A.star_posts(spark, sf_dir), A.star_comments(spark, sf_dir))
    labels = map_array(
        "comments", lambda c: F.concat(F.lower(c["text"]), F.lit(" by "), c["user_id"])
    )
    return nested.select("id", F.explode(labels).alias("label"))


@query(
    "b9_empty_array",
    """SELECT p.id, count(c.post_id) AS n_comments
    FROM posts p LEFT JOIN comments c ON c.post_id = p.id GROUP BY p.id""",
    POSTS,
    COMMENTS,
)
def b9_empty_array(spark, sf_dir):
    nested = nesting.nest_comments(A.star_posts(spark, sf_dir), A.star_comments(spark, sf_dir))
    sizes = nested.select("id", F.size(or_empty("comments", COMMENT_LIST)).alias("n"))
    return sizes.groupBy("id").agg(F.sum("n").alias("n_comments"))


@query(
    "b10_attr_alias",
    "SELECT id, last_editor_user_id AS owner_display_name, last_editor_user_id FROM posts",
    POSTS,
)
def b10_attr_alias(spark, sf_dir):
    scan = sources.scan_rows(spark, _posts_xml(spark, sf_dir), "post", alias_editor=True)
    typed = sources.accepted(sources.type_records(scan, "post", alias_editor=True))
    return typed.select("id", "owner_display_name", "last_editor_user_id")


@query(
    "b11_java_hash",
    f"SELECT conv_id, turn, CAST({_hash_sql('text')} AS INTEGER) AS hash FROM conversations",
)
def b11_java_hash(spark, sf_dir):
    turns = A.source_table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", string_hash("text").alias("hash"))


# --- routing and keys -----------------------------------------------------------------------


@query(
    "c1_hash_sample",
    f"SELECT conv_id, turn, text FROM conversations WHERE {_hash_sql('text')} % 100 = 0",
)
def c1_hash_sample(spark, sf_dir):
    turns = A.source_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return routing.sample_lines(turns, column="text")


@query(
    "c3_route_posts", "SELECT id, pos_type_id FROM posts WHERE pos_type_id IN ('1', '2')", POSTS
)
def c3_route_posts(spark, sf_dir):
    return routing.thread_posts(A.star_posts(spark, sf_dir)).select("id", "pos_type_id")


@query(
    "c4_threads_having_question",
    """SELECT q.id AS thread_key, CAST(count(a.id) AS INTEGER) AS n_answers
    FROM questions q LEFT JOIN answers a ON a.parent_id = q.id GROUP BY q.id""",
    POSTS,
    QUESTIONS,
    ANSWERS,
)
def c4_threads_having_question(spark, sf_dir):
    threads = build_threads(A.star_posts(spark, sf_dir))
    return threads.where("part = 0").select("thread_key", "n_answers")


@query(
    "d3_thread_key",
    """SELECT id, CASE pos_type_id WHEN '1' THEN id ELSE parent_id END AS thread_key
    FROM posts WHERE pos_type_id IN ('1', '2')""",
    POSTS,
)
def d3_thread_key(spark, sf_dir):
    return routing.with_thread_key(A.star_posts(spark, sf_dir)).select("id", "thread_key")


# --- joins and groups -----------------------------------------------------------------------


@query(
    "e1_cogroup",
    """SELECT coalesce(p.id, c.post_id) AS key, coalesce(p.n, 0) AS n_posts,
      coalesce(c.n, 0) AS n_comments
    FROM (SELECT id, count(*) AS n FROM copies GROUP BY id) p
    FULL JOIN (SELECT post_id, count(*) AS n FROM comments GROUP BY post_id) c
      ON p.id = c.post_id""",
    POSTS,
    COPIES,
    COMMENTS,
)
def e1_cogroup(spark, sf_dir):
    posts = A.star_posts_with_copies(spark, sf_dir)
    comments = A.star_comments(spark, sf_dir)
    groups = co_group({"posts": (posts, "id"), "comments": (comments, "post_id")})
    return groups.groupBy("key").agg(
        F.sum(F.size("posts")).alias("n_posts"), F.sum(F.size("comments")).alias("n_comments")
    )


@query(
    "e2_nest_comments",
    """SELECT p.id, p.title, c.id AS comment_id, c.text AS comment_text
    FROM posts p LEFT JOIN comments c ON c.post_id = p.id""",
    POSTS,
    COMMENTS,
)
def e2_nest_comments(spark, sf_dir):
    nested = nesting.nest_comments(A.star_posts(spark, sf_dir), A.star_comments(spark, sf_dir))
    flat = nested.select("id", "title", F.explode_outer("comments").alias("c"))
    return flat.select(
        "id", "title", F.col("c.id").alias("comment_id"), F.col("c.text").alias("comment_text")
    )


@query(
    "e3_orphan_comments",
    """SELECT c.id, c.post_id, c.text FROM comments c
    WHERE NOT EXISTS (SELECT 1 FROM posts p WHERE p.id = c.post_id)""",
    POSTS,
    COMMENTS,
)
def e3_orphan_comments(spark, sf_dir):
    orphans = nesting.orphan_comments(A.star_posts(spark, sf_dir), A.star_comments(spark, sf_dir))
    return orphans.select("id", "post_id", "text")


@query("e4_threads", THREAD_VIEW, POSTS, QUESTIONS, ANSWERS)
def e4_threads(spark, sf_dir):
    return _thread_view(flatten_threads(build_threads(A.star_posts(spark, sf_dir))))


@query(
    "e4_threads_with_comments", FULL_THREAD_VIEW, POSTS, COMMENTS, QUESTIONS, ANSWERS
)
def e4_threads_with_comments(spark, sf_dir):
    threads = build_threads(A.star_posts(spark, sf_dir), A.star_comments(spark, sf_dir))
    return _full_thread_view(threads)


HOT = _one_line(
    """hot AS (SELECT * REPLACE (CASE WHEN pos_type_id = '2' THEN 'c1' ELSE parent_id END AS parent_id)
    FROM posts)"""
)
HOT_COMMENTS = _one_line(
    """hot_comments AS (SELECT * REPLACE (
      CASE WHEN text LIKE 'A %' THEN 'o1' WHEN text LIKE 'R %' THEN 'c1' ELSE post_id END AS post_id)
    FROM comments)"""
)


def _hot_posts(spark, sf_dir):
    """All answers to one question, more than a task lists at every scale but the smallest."""
    posts = A.star_posts(spark, sf_dir)
    return posts.withColumn(
        "parent_id", F.when(routing.is_answer(), "c1").otherwise(F.col("parent_id"))
    )


def _hot_comments(spark, sf_dir):
    """A quarter of the comments on one answer, another quarter on the question."""
    kind = F.substring("text", 1, 2)
    home = F.when(kind == "A ", "o1").when(kind == "R ", "c1").otherwise(F.col("post_id"))
    return A.star_comments(spark, sf_dir).withColumn("post_id", home)


@query(
    "e2_nest_hot_comments",
    """SELECT p.id, CAST(count(c.id) AS INTEGER) AS n_comments, min(c.id) AS least
    FROM posts p LEFT JOIN hot_comments c ON c.post_id = p.id GROUP BY p.id""",
    POSTS,
    COMMENTS,
    HOT_COMMENTS,
)
def e2_nest_hot_comments(spark, sf_dir):
    posts, comments = A.star_posts(spark, sf_dir), _hot_comments(spark, sf_dir)
    # the hot posts outgrow one row, so they come in parts
    nested = nesting.nest_comments(posts, comments, max_group=MAX_GROUP)
    ids = F.col("comments.id")
    parts = nested.select("id", ROW_ID, F.size(ids).alias("n"), F.array_min(ids).alias("least"))
    whole = parts.groupBy("id", ROW_ID).agg(
        F.sum("n").cast("int").alias("n_comments"), F.min("least").alias("least")
    )
    return whole.drop(ROW_ID)


@query(
    "e4_hot_thread",
    """SELECT q.id AS thread_key, CAST(count(DISTINCT a.id) AS INTEGER) AS n_answers,
      min(a.id) AS least, CAST(count(c.id) AS INTEGER) AS answer_comments,
      (SELECT CAST(count(*) AS INTEGER) FROM hot_comments k WHERE k.post_id = q.id)
        AS question_comments
    FROM hot q LEFT JOIN hot a ON a.pos_type_id = '2' AND a.parent_id = q.id
    LEFT JOIN hot_comments c ON c.post_id = a.id WHERE q.pos_type_id = '1' GROUP BY q.id""",
    POSTS,
    COMMENTS,
    HOT,
    HOT_COMMENTS,
)
def e4_hot_thread(spark, sf_dir):
    posts, comments = _hot_posts(spark, sf_dir), _hot_comments(spark, sf_dir)
    # the hot thread outgrows one row, so it comes in parts
    parts = build_threads(posts, comments, max_group=MAX_GROUP).select(
        "thread_key",
        "n_answers",
        F.array_min("answers.id").alias("least"),
        F.size(F.flatten("answers.comments")).alias("answer_comments"),
        F.size("question.comments").alias("question_comments"),
    )
    return parts.groupBy("thread_key").agg(
        F.max("n_answers").alias("n_answers"),
        F.min("least").alias("least"),
        F.sum("answer_comments").cast("int").alias("answer_comments"),
        F.sum("question_comments").cast("int").alias("question_comments"),
    )


@query(
    "e5_orphan_answers",
    """SELECT a.id, a.parent_id, a.title FROM answers a
    WHERE NOT EXISTS (SELECT 1 FROM questions q WHERE q.id = a.parent_id)""",
    POSTS,
    QUESTIONS,
    ANSWERS,
)
def e5_orphan_answers(spark, sf_dir):
    return orphan_answers(A.star_posts(spark, sf_dir)).select("id", "parent_id", "title")


@query(
    "f1_group_by_key",
    """SELECT CASE pos_type_id WHEN '1' THEN id ELSE parent_id END AS thread_key, id, title
    FROM posts WHERE pos_type_id IN ('1', '2')""",
    POSTS,
)
def f1_group_by_key(spark, sf_dir):
    groups = group_by_key(routing.with_thread_key(A.star_posts(spark, sf_dir)), "thread_key")
    flat = groups.select("thread_key", F.explode("items").alias("post"))
    return flat.select(
        "thread_key", F.col("post.id").alias("id"), F.col("post.title").alias("title")
    )


@query(
    "f3_last_question",
    """SELECT thread_id AS thread_key, arg_max(text, turn) FILTER (WHERE kind = '1') AS question,
      CAST(count(*) FILTER (WHERE kind = '2') AS INTEGER) AS n_answers
    FROM turns GROUP BY thread_id HAVING count(*) FILTER (WHERE kind = '1') > 0""",
    TURNS,
)
def f3_last_question(spark, sf_dir):
    posts = A.conversation_posts(spark, sf_dir)
    threads = build_threads(posts, key=F.col("thread_id"), order=F.col("turn"))
    return threads.where("part = 0").select(
        "thread_key", F.col("question.body").alias("question"), "n_answers"
    )


@query(
    "f4_first_post",
    """SELECT id, title FROM copies
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY creation_date NULLS FIRST) = 1""",
    POSTS,
    COPIES,
)
def f4_first_post(spark, sf_dir):
    return first_posts(A.star_posts_with_copies(spark, sf_dir)).select("id", "title")


@query(
    "f5_dup_answers",
    """SELECT q.id AS thread_key, CAST(count(a.id) AS INTEGER) AS listed,
      CAST(count(DISTINCT a.id) AS INTEGER) AS first_only
    FROM (SELECT * FROM copies WHERE pos_type_id = '1') q
    LEFT JOIN (SELECT * FROM copies WHERE pos_type_id = '2') a ON a.parent_id = q.id
    GROUP BY q.id""",
    POSTS,
    COPIES,
)
def f5_dup_answers(spark, sf_dir):
    posts = A.star_posts_with_copies(spark, sf_dir)
    listed = build_threads(posts).where("part = 0")
    first_only = build_threads(posts, A.star_comments(spark, sf_dir)).where("part = 0")
    return listed.select("thread_key", F.col("n_answers").alias("listed")).join(
        first_only.select("thread_key", F.col("n_answers").alias("first_only")), "thread_key"
    )


# --- data quality ---------------------------------------------------------------------------


@query(
    "g1_unsupported_type",
    "SELECT id, pos_type_id, title FROM posts WHERE pos_type_id NOT IN ('1', '2')",
    POSTS,
)
def g1_unsupported_type(spark, sf_dir):
    posts = A.star_posts(spark, sf_dir)
    return quality.unsupported_posts(posts).select("id", "pos_type_id", "title")


@query(
    "g2_multi_question",
    """SELECT thread_id AS thread_key, count(*) AS n_questions FROM turns WHERE kind = '1'
    GROUP BY thread_id HAVING count(*) > 1""",
    TURNS,
)
def g2_multi_question(spark, sf_dir):
    return quality.multi_question_keys(A.conversation_posts(spark, sf_dir), F.col("thread_id"))


@query(
    "g3_missing_question",
    """SELECT DISTINCT parent_id AS thread_key FROM answers
    WHERE parent_id NOT IN (SELECT id FROM questions)""",
    POSTS,
    QUESTIONS,
    ANSWERS,
)
def g3_missing_question(spark, sf_dir):
    return missing_question_keys(A.star_posts(spark, sf_dir))


@query(
    "g4_missing_post",
    "SELECT DISTINCT post_id FROM comments WHERE post_id NOT IN (SELECT id FROM posts)",
    POSTS,
    COMMENTS,
)
def g4_missing_post(spark, sf_dir):
    return nesting.missing_post_keys(A.star_posts(spark, sf_dir), A.star_comments(spark, sf_dir))


@query(
    "g5_duplicate_post",
    "SELECT id, count(*) AS n_posts FROM copies GROUP BY id HAVING count(*) > 1",
    POSTS,
    COPIES,
)
def g5_duplicate_post(spark, sf_dir):
    return repeated_ids(A.star_posts_with_copies(spark, sf_dir))


HOLES = _one_line(
    """holes AS (SELECT id, CASE WHEN score % 17 = 0 THEN NULL ELSE pos_type_id END AS pos_type_id,
    CASE WHEN score % 13 = 0 THEN NULL ELSE parent_id END AS parent_id, title FROM posts)"""
)


@query(
    "g6_null_key",
    """SELECT id, pos_type_id, parent_id, title FROM holes
    WHERE pos_type_id IS NULL OR (pos_type_id = '2' AND parent_id IS NULL)""",
    POSTS,
    HOLES,
)
def g6_null_key(spark, sf_dir):
    posts = A.star_posts(spark, sf_dir).withColumns(
        {
            "pos_type_id": F.when(F.col("score") % 17 == 0, None).otherwise(F.col("pos_type_id")),
            "parent_id": F.when(F.col("score") % 13 == 0, None).otherwise(F.col("parent_id")),
        }
    )
    return quality.null_key_posts(posts).select("id", "pos_type_id", "parent_id", "title")


@query(
    "g_quality_counts",
    """SELECT 'unsupported_type' AS channel, count(*) AS n FROM copies
      WHERE pos_type_id NOT IN ('1', '2')
    UNION ALL SELECT 'null_key_posts', 0
    UNION ALL SELECT 'duplicate_post', count(*)
      FROM (SELECT id FROM copies GROUP BY id HAVING count(*) > 1)
    UNION ALL SELECT 'multi_question', 0
    UNION ALL SELECT 'missing_question', count(DISTINCT parent_id) FROM copies
      WHERE pos_type_id = '2' AND parent_id NOT IN (SELECT id FROM posts WHERE pos_type_id = '1')
    UNION ALL SELECT 'missing_post', count(DISTINCT post_id) FROM comments
      WHERE post_id NOT IN (SELECT id FROM posts)
    UNION ALL SELECT 'null_key_comments', 0""",
    POSTS,
    COPIES,
    COMMENTS,
)
def g_quality_counts(spark, sf_dir):
    posts = A.star_posts_with_copies(spark, sf_dir)
    return quality.quality_counts(posts, A.star_comments(spark, sf_dir))


# --- sinks ----------------------------------------------------------------------------------


@query("h1_write_read_back", f"SELECT {COMMENT_VIEW} FROM comments", COMMENTS)
def h1_write_read_back(spark, sf_dir):
    base = scratch_dir(spark, "tables")
    sinks.write_table(A.star_comments(spark, sf_dir), "comment", base, table="remarks")
    return _comment_view(sources.read_table(spark, base, "comment", table="remarks"))


@query("h2_post_table", f"SELECT {POST_VIEW} FROM posts", POSTS)
def h2_post_table(spark, sf_dir):
    base = scratch_dir(spark, "tables")
    sinks.write_table(post_row(A.star_posts(spark, sf_dir)), "post", base)
    return _post_view(sources.read_table(spark, base, "post"))


@query("h3_comment_table", f"SELECT {COMMENT_VIEW} FROM comments", COMMENTS)
def h3_comment_table(spark, sf_dir):
    base = scratch_dir(spark, "tables")
    sinks.write_table(comment_row(A.star_comments(spark, sf_dir)), "comment", base)
    return _comment_view(sources.read_table(spark, base, "comment"))


@query("h4_thread_table", THREAD_VIEW, POSTS, QUESTIONS, ANSWERS)
def h4_thread_table(spark, sf_dir):
    base = scratch_dir(spark, "tables")
    sinks.write_table(build_threads(A.star_posts(spark, sf_dir)), "thread", base)
    return _thread_view(_stored_flat(spark, base))


@query("h5_truncate_idempotent", f"SELECT {POST_VIEW} FROM posts", POSTS)
def h5_truncate_idempotent(spark, sf_dir):
    base = scratch_dir(spark, "tables")
    for _ in range(2):
        sinks.write_table(post_row(A.star_posts(spark, sf_dir)), "post", base)
    return _post_view(sources.read_table(spark, base, "post"))


@query(
    "h7_required_check",
    """SELECT a.parent_id AS thread_key, a.id AS answer_id FROM answers a
    WHERE a.parent_id NOT IN (SELECT id FROM questions)""",
    POSTS,
    QUESTIONS,
    ANSWERS,
)
def h7_required_check(spark, sf_dir):
    groups = build_threads(A.star_posts(spark, sf_dir), keep_questionless=True)
    refused = sinks.missing_required(groups, "thread")
    return refused.select("thread_key", F.explode("answers.id").alias("answer_id"))


# --- jobs -----------------------------------------------------------------------------------


@query(
    "i0_sample_log",
    f"""SELECT line FROM (SELECT {ONE_LINE_TEXT} AS line FROM conversations)
    WHERE {_hash_sql('line')} % 100 = 0""",
)
def i0_sample_log(spark, sf_dir):
    sample = plans.sample_log(spark, _text_file(spark, sf_dir))
    return sample.select(F.col("value").alias("line"))


@query("i1_load_posts", f"SELECT {POST_VIEW} FROM posts", POSTS)
def i1_load_posts(spark, sf_dir):
    base = scratch_dir(spark, "tables")
    plans.load_posts(spark, _posts_xml(spark, sf_dir), base)
    return _post_view(sources.read_table(spark, base, "post"))


@query(
    "i2_load_both",
    f"""SELECT 'post' AS source, id, parent_id AS parent, {_iso_sql('creation_date')} AS
      creation_date, body AS text, CAST(score AS BIGINT) AS score FROM posts
    UNION ALL SELECT 'comment', id, post_id, {_iso_sql('creation_date')}, text, score
    FROM comments""",
    POSTS,
    COMMENTS,
)
def i2_load_both(spark, sf_dir):
    base = scratch_dir(spark, "tables")
    plans.load_both(spark, _posts_xml(spark, sf_dir), _comments_xml(spark, sf_dir), base)
    date = format_iso("creation_date").alias("creation_date")
    posts = sources.read_table(spark, base, "post").select(
        F.lit("post").alias("source"),
        "id",
        F.col("parent_id").alias("parent"),
        date,
        F.col("body").alias("text"),
        F.col("score").cast("bigint").alias("score"),
    )
    comments = sources.read_table(spark, base, "comment").select(
        F.lit("comment").alias("source"),
        "id",
        F.col("post_id").alias("parent"),
        date,
        "text",
        "score",
    )
    return posts.unionByName(comments)


@query("i3_threads", THREAD_VIEW, POSTS, QUESTIONS, ANSWERS)
def i3_threads(spark, sf_dir):
    base = scratch_dir(spark, "tables")
    plans.threads_without_comments(
        spark, _posts_xml(spark, sf_dir), _comments_xml(spark, sf_dir), base, count_quality=False
    )
    return _thread_view(_stored_flat(spark, base))


@query("i4_threads_with_comments", FULL_THREAD_VIEW, POSTS, COMMENTS, QUESTIONS, ANSWERS)
def i4_threads_with_comments(spark, sf_dir):
    base = scratch_dir(spark, "tables")
    # plain XML takes more disk than all tables and shuffles; it goes when the tables are there
    with job_folder(spark):
        dumps = _posts_xml(spark, sf_dir, packed=True), _comments_xml(spark, sf_dir, packed=True)
        plans.threads_with_comments(spark, *dumps, base)
    return _full_thread_view(_stored(spark, base))
