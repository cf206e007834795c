"""Building discussion threads: a question, its answers and, if wanted, all their comments.

A thread is one group, so its posts meet in a single shuffle on the thread key; the question
never has to be joined to its answers. Comments are first grouped by post and reach their thread
through a table of post keys only, so a post's body is shuffled once and not a second time to
meet its comments.

Threads are weighed first, by their answers and comments and by the bytes of their texts. A thread
is one row at every size. A very large one is cut at values of its answers' order, its stretches are
listed by several tasks, and the lists are put one after the other, so nothing sorts the whole of
it; that last row is the result itself, so no plan can avoid it, and a thread that no row can hold
is an error that says so. A caller that wants no such row gives ``max_group``: threads with more
answers and comments, or more bytes than a part holds, then come as several rows that repeat the question's own columns, and every row tells
its ``part`` and the number of parts. Every answer and comment is in exactly one part; an answer
with very many comments is listed several times, each time with another slice of them. The flat
relations :func:`answers_of_questions` and :func:`comments_of_posts` need no grouping at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import empty_array, or_empty, ordered_list
from threadloom.operators.comments import comment_lists, comments_per_post
from threadloom.operators.duplicates import first_posts, post_order
from threadloom.operators.listing import (
    PART_BYTES,
    bytes_of,
    cuts_of,
    heavy_keys,
    refuse_too_large,
    sampled,
    stretch_of,
)
from threadloom.operators.rows import post_struct
from threadloom.operators.routing import is_answer, is_question, with_thread_key
from threadloom.operators.skew import (
    MAX_GROUP,
    KeyTable,
    Splits,
    bounded,
    group_divided,
    keep_keys,
    measure,
    numbered,
    part_of,
    store,
    with_parts,
)
from threadloom.schemas import COMMENT_LIST, POST_SCALARS, ROW_ID


# What a post takes beside its texts.
POST_BYTES = 256


def missing_question_keys(posts: DataFrame) -> DataFrame:
    """Distinct thread keys that have answers but no question."""
    keyed = with_thread_key(posts)
    answered = keyed.where(is_answer()).select("thread_key").distinct()
    asked = keyed.where(is_question()).select(F.col("thread_key").alias("_asked")).distinct()
    return answered.join(asked, answered["thread_key"] == asked["_asked"], "left_anti")


def orphan_answers(posts: DataFrame) -> DataFrame:
    """Answers whose parent is not a question of the archive."""
    answers = posts.where(is_answer() & F.col("parent_id").isNotNull())
    return keep_keys(answers, "parent_id", missing_question_keys(posts))


def _last_per_thread(questions: DataFrame) -> DataFrame:
    """One question per thread key, the last by ``_order``."""
    last = F.max_by(F.struct(*questions.columns), F.col("_order")).alias("_last")
    return questions.groupBy("thread_key").agg(last).select("_last.*")


def _post_bytes() -> Column:
    """About what a post takes in a thread, without comments."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in ("body", "title")]
    return sum(texts, F.lit(POST_BYTES).cast("long"))


def _rows_per_part(members: DataFrame, slices: Splits | None) -> DataFrame:
    """Give every post its part and comment slice, repeating it where it stands in several.

    A question stands in all parts of its thread and brings slice ``i`` of its comments to part
    ``i``. Of several questions with one key only the last can appear, so it is picked before
    it is repeated.
    """
    sized = with_parts(members, "id", slices, "_slices")
    wide_question = is_question() & F.col("n_answers").isNotNull()
    winners = (
        _last_per_thread(sized.where(wide_question))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumn("slice", F.col("part"))
    )
    others = (
        sized.where(~wide_question)
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
        .withColumn("part", part_of(F.col("_parts"), F.col(ROW_ID), F.col("slice")))
    )
    return others.unionByName(winners)


def _rows_per_stretch(members: DataFrame) -> DataFrame:
    """Give the posts of large threads the stretch of their thread's order they are in, as ``part``;
    questions go to the first."""
    place = F.struct("creation_date", "id", ROW_ID)
    answers = members.where(is_answer())
    samples = sampled(answers, F.col("_parts"), F.col("n_answers")).groupBy("thread_key", "_parts")
    cuts = samples.agg(F.sort_array(F.collect_list(place)).alias("samples")).select(
        F.col("thread_key").alias("_cut_key"), cuts_of(F.col("samples"), F.col("_parts")).alias("_cuts")
    )
    cuts = store(cuts, "thread-cuts")
    placed = members.join(cuts, members["thread_key"] == cuts["_cut_key"], "left")
    part = F.when(is_question(), 0).otherwise(stretch_of(F.col("_cuts"), place))
    return placed.withColumns({"part": part, "slice": F.lit(0)}).drop("_cut_key", "_cuts")


def build_threads(
    posts: DataFrame,
    comments: DataFrame | None = None,
    *,
    key: Column | None = None,
    order: Column | None = None,
    keep_questionless: bool = False,
    max_group: int | None = None,
) -> DataFrame:
    """Threads of the posts.

    Columns: ``thread_key``, ``part`` and ``n_parts`` (0 and 1 unless ``max_group`` asks for parts
    and the thread has more answers and comments), ``n_answers`` of the whole thread, ``question``
    and ``answers``.

    Without ``comments``, posts keep the comment lists they have, if any, and repeated posts all
    count: each copy of an answer is listed and the last question by ``order`` stands. With
    ``comments``, the first post of each id stands and carries its comments. Groups without a
    question are dropped unless ``keep_questionless``. ``key`` replaces the usual thread key.
    """
    with_comments = comments is not None
    whole_threads = max_group is None
    max_group = MAX_GROUP if whole_threads else max_group
    if with_comments:
        posts = first_posts(posts, keep=True)
    if order is None:
        # one post per id leaves one question per id, with nothing to choose from
        unique = with_comments and key is None
        order = F.lit(0) if unique else post_order(posts)
    nested = "comments" in posts.columns and not with_comments
    own_list = or_empty("comments", COMMENT_LIST) if nested else empty_array(COMMENT_LIST)
    members = with_thread_key(
        posts.withColumns({"_order": F.when(is_question(), order), "comments": own_list}), key
    )

    # Weigh posts and threads: keys and sizes are shuffled, no text; comments without a post count.
    own_bytes = _post_bytes() + bytes_of(F.col("comments"), COMMENT_LIST)
    weighed, n_comments = members.withColumn("_bytes", own_bytes), F.size("comments")
    comment_bytes = F.lit(0)
    if with_comments:
        counts = comments_per_post(comments, weigh=True)
        weighed = weighed.join(counts, weighed["id"] == counts["post_id"], "full")
        n_comments = F.coalesce("n_comments", F.lit(0))
        comment_bytes = F.coalesce("comment_bytes", F.lit(0))
    totals = weighed.groupBy("thread_key").agg(
        F.sum(F.coalesce(is_answer(), F.lit(False)).cast("int") + n_comments).alias("listed"),
        F.sum(F.coalesce("_bytes", F.lit(0)) + comment_bytes).alias("nbytes"),
        F.count("*").alias("n_posts"),
        F.count_if(is_question()).alias("n_questions"),
        F.count_if(is_answer()).cast("int").alias("n_answers"),
        F.max(n_comments).alias("n_comments"),
    )
    # bytes count as the answers and comments that fill a part
    in_bytes = F.floor(F.col("nbytes") * (max_group / PART_BYTES))
    totals = totals.withColumn("weight", F.greatest("listed", in_bytes))
    in_thread = F.when(F.col("thread_key").isNotNull(), F.greatest("weight", "n_posts"))
    sizes = F.greatest(in_thread, "n_comments")
    threads = slices = None
    if (totals.agg(F.max(sizes)).first()[0] or 0) > max_group:
        heavy = store(totals.where(sizes > max_group), "heavy-threads")
        if whole_threads:
            named = heavy.where(F.col("thread_key").isNotNull())
            if not keep_questionless:
                named = named.where("n_questions > 0")
            refuse_too_large(named, "thread_key", "nbytes")
        carry = ("n_answers", "n_questions")
        threads = measure(heavy, "thread_key", "weight", max_group, rows="n_posts", carry=carry)
        if with_comments and not whole_threads:
            slices = measure(counts, "post_id", "n_comments", max_group)
    if threads is None:
        plain = members.withColumns({"part": F.lit(0), "slice": F.lit(0)})
        # no post has more comments than a task lists
        none = KeyTable(totals, 0, True) if max_group <= MAX_GROUP else None
        built = _listed(plain, comments, slices, split=False, heavy=none)
        return built if keep_questionless else _with_question(built)
    by_id = members.withColumn(ROW_ID, F.xxhash64("id"))
    members = by_id if with_comments else numbered(members)
    members = with_parts(members, "thread_key", threads, "_parts")
    if not keep_questionless:
        # a large group that will be dropped need not be shuffled
        members = members.where(F.coalesce(F.col("n_questions") > 0, F.lit(True)))
    if not whole_threads:
        built = _listed(_rows_per_part(members, slices), comments, slices, split=True)
        return built if keep_questionless else _with_question(built)

    usual = members.where("_parts = 1").withColumns({"part": F.lit(0), "slice": F.lit(0)})
    large = _rows_per_stretch(members.where("_parts > 1"))
    usual_comments = large_comments = comments
    heavy = heavy_usual = None
    if with_comments:
        # comments that no usual thread wants are listed with the large threads or not at all
        ids = large.where(F.col("id").isNotNull()).select(F.col("id").alias("_large_id")).distinct()
        ids = bounded(ids, rare=False).table
        large_comments = comments.join(ids, comments["post_id"] == ids["_large_id"], "left_semi")
        usual_comments = comments.join(ids, comments["post_id"] == ids["_large_id"], "left_anti")
        weights = counts.withColumnsRenamed({"n_comments": "rows", "comment_bytes": "nbytes"})
        heavy = heavy_keys(weights, "post_id")
        heavy_usual = heavy
        if heavy.n:
            elsewhere = heavy.table.join(ids, F.col("split_key") == ids["_large_id"], "left_anti")
            heavy_usual = bounded(elsewhere)
    merged = _put_together(
        _listed(large, large_comments, None, split=True, heavy=heavy), unique=with_comments
    )
    built = _listed(usual, usual_comments, None, split=False, heavy=heavy_usual).unionByName(merged)
    return built if keep_questionless else _with_question(built)


def _with_question(threads: DataFrame) -> DataFrame:
    return threads.where(F.col("question").isNotNull())


def _listed(
    rows: DataFrame,
    comments: DataFrame | None,
    slices: Splits | None,
    *,
    split: bool,
    heavy: KeyTable | None = None,
) -> DataFrame:
    """One row for each thread, or with ``split`` each part, of posts that know their ``part`` and
    ``slice``; the columns of :func:`build_threads`."""
    with_comments = comments is not None
    carried = ["n_answers", "_parts"] if split else []
    post = F.struct("id", "slice", post_struct(F.col("comments")).alias("post"))
    parts = rows.select(
        "thread_key",
        "part",
        *carried,
        "_order",
        F.when(is_question(), post).alias("q"),
        F.when(is_answer(), post).alias("a"),
        F.when(is_answer(), True).alias("answered"),
    )
    aggregates = [F.max(c).alias(f"max_{c}") for c in carried] + [
        # callers that want numbers alone need no lists
        F.count("answered").cast("int").alias("n_listed"),
        F.max_by("q", "_order").alias("q"),
        ordered_list(F.col("a"), F.col("a.post.creation_date"), F.col("a.id")).alias("a"),
    ]
    if with_comments:
        lists = comment_lists(comments, slices, heavy).withColumnRenamed("slice", "_slice")
        homes = rows.where(is_question() | is_answer()).select(
            "thread_key", "part", "id", "slice", "creation_date", is_question().alias("asks")
        )
        at_home = homes["id"] == lists["post_id"]
        if slices is not None:
            at_home = at_home & (homes["slice"] == lists["_slice"])
        # every answer has an entry, so that these lists, in the answers' order, stand beside them
        located = homes.join(lists, at_home, "left").select(
            "thread_key",
            "part",
            F.when(F.col("asks"), F.struct("id", "slice", "comments")).alias("own"),
            F.when(~F.col("asks"), F.struct("creation_date", "id", "slice", "comments")).alias("beside"),
        )
        parts = parts.unionByName(located, allowMissingColumns=True)
        aggregates += [
            F.collect_list("own").alias("own"),
            # an id and slice are there once, so sorting never looks at the comments
            F.sort_array(F.collect_list("beside"))["comments"].alias("beside"),
        ]

    keys = ["thread_key", "part"] if split else ["thread_key"]
    grouped = group_divided((parts, keys), "part", *aggregates)

    def whole(member: Column, comments: Column) -> Column:
        """A collected post with its comments."""
        scalars = [member["post"][c].alias(c) for c in POST_SCALARS]
        return F.struct(*scalars, or_empty(comments, COMMENT_LIST).alias("comments"))

    question, answers = F.col("q.post"), F.col("a.post")
    if with_comments:
        # of several questions with one key only the last appears
        same = lambda x: (x["id"] == F.col("q.id")) & (x["slice"] == F.col("q.slice"))
        question = whole(F.col("q"), F.get(F.filter("own", same), F.lit(0))["comments"])
        answers = F.zip_with("a", "beside", whole)

    listed = F.col("n_listed")
    return grouped.select(
        "thread_key",
        "part",
        (F.coalesce("max__parts", F.lit(1)) if split else F.lit(1)).alias("n_parts"),
        (F.coalesce("max_n_answers", listed) if split else listed).alias("n_answers"),
        F.when(F.col("q").isNotNull(), question).alias("question"),
        answers.alias("answers"),
    )


def _put_together(parts: DataFrame, *, unique: bool) -> DataFrame:
    """One row for each thread from stretches of its order. Unless ids are ``unique``, answers of
    one date and id may be in two stretches, so the list is put in order once more; it is sorted
    but for those, which takes one pass over it."""
    grouped = parts.groupBy("thread_key").agg(
        F.first("question", ignorenulls=True).alias("question"),
        # stretches have different numbers, so sorting never looks at the lists
        F.sort_array(F.collect_list(F.struct("part", "answers"))).alias("stretches"),
    )
    answers = F.flatten(F.col("stretches")["answers"])
    if not unique:
        # the order of ordered_list
        entries = F.transform(
            answers,
            lambda post: F.struct(
                post["creation_date"].alias("k0"), post["id"].alias("k1"), post.alias("item")
            ),
        )
        answers = F.sort_array(entries)["item"]
    joined = grouped.select("thread_key", "question", answers.alias("answers"))
    return joined.select(
        "thread_key",
        F.lit(0).alias("part"),
        F.lit(1).alias("n_parts"),
        F.size("answers").alias("n_answers"),
        "question",
        "answers",
    )


def answers_of_questions(posts: DataFrame) -> DataFrame:
    """Questions beside each of their answers, as structs ``question`` and ``answer``, for work on
    threads of any size without lists. Questions without an answer are left out."""
    kept = [c for c in posts.columns if c != ROW_ID]
    questions = posts.where(is_question()).select(F.struct(*kept).alias("question"))
    answers = posts.where(is_answer()).select(F.struct(*kept).alias("answer"))
    return questions.join(answers, F.col("question.id") == F.col("answer.parent_id"))


def comments_of_posts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts beside each of their comments, as structs ``post`` and ``comment``."""
    kept = [c for c in posts.columns if c != ROW_ID]
    left = posts.select(F.struct(*kept).alias("post"))
    right = comments.select(F.struct("*").alias("comment"))
    return left.join(right, F.col("post.id") == F.col("comment.post_id"))


def flatten_threads(threads: DataFrame) -> DataFrame:
    """One row per listed answer, with the question and the answer as structs; a thread without
    answers has one row with a null answer."""
    flat = threads.select(
        "thread_key", "part", "n_answers", "question", F.explode_outer("answers").alias("answer")
    )
    answerless = (F.col("part") == 0) & (F.col("n_answers") == 0)
    return flat.where(F.col("answer").isNotNull() | answerless)
