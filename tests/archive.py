"""Small invented archives and a plain-Python account of the threads they must give."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

from threadloom.schemas import COMMENT_SCHEMA, POST_SCALARS, POST_SCHEMA

DAY = dt.datetime(2020, 1, 1)


def post(id, kind, parent=None, day=0, **more):
    row = dict.fromkeys(POST_SCALARS)
    row.update(id=id, pos_type_id=kind, parent_id=parent, creation_date=DAY + dt.timedelta(day))
    row.update(more, comments=[])
    return row


def comment(id, post_id, day=0, **more):
    row = {"id": id, "post_id": post_id, "score": None, "text": f"text {id}"}
    row.update(creation_date=DAY + dt.timedelta(day), user_display_name=None, user_id=None)
    row.update(more)
    return row


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema)


def posts_frame(spark, rows):
    return frame(spark, rows, POST_SCHEMA)


def comments_frame(spark, rows):
    return frame(spark, rows, COMMENT_SCHEMA)


def random_archive(seed, n_questions=12, n_answers=60, n_comments=300, hot=True):
    """Posts and comments with orphans, other types and, if ``hot``, one very large thread."""
    rng = random.Random(seed)
    posts = [post(f"q{i}", "1", day=i, title=f"title {i}") for i in range(n_questions)]
    for i in range(n_answers):
        target = 0 if hot and rng.random() < 0.4 else rng.randrange(n_questions + 3)
        posts.append(post(f"a{i}", "2", f"q{target}", day=rng.randrange(5), body=f"body {i}"))
    posts += [post(f"w{i}", "5", day=1) for i in range(3)]
    comments = []
    for i in range(n_comments):
        kind = rng.random()
        if hot and kind < 0.2:
            target = "q0"
        elif hot and kind < 0.4:
            target = "a0"
        elif kind < 0.5:
            target = "missing"
        else:
            target = rng.choice(posts)["id"]
        comments.append(comment(f"c{i}", target, day=rng.randrange(5)))
    comments += [comment("copy", "q1") for _ in range(20)]
    rng.shuffle(posts)
    rng.shuffle(comments)
    return posts, comments


def expected_threads(posts, comments=()):
    """thread key -> (question id, sorted question comments, {answer id: sorted comments}, listed
    answers) with every post standing."""
    by_post = defaultdict(list)
    for c in comments:
        by_post[c["post_id"]].append(c["id"])
    threads = {}
    for q in posts:
        if q["pos_type_id"] != "1":
            continue
        answers = [a for a in posts if a["pos_type_id"] == "2" and a["parent_id"] == q["id"]]
        threads[q["id"]] = (
            q["id"],
            sorted(by_post[q["id"]]),
            {a["id"]: sorted(by_post[a["id"]]) for a in answers},
            sorted(a["id"] for a in answers),
        )
    return threads


def collected_threads(df):
    """Put the parts of each thread together again, in the form of ``expected_threads``."""
    threads = {}
    for row in df.collect():
        question, q_comments, answers, listed = threads.setdefault(
            row["thread_key"], (row["question"]["id"], [], defaultdict(list), [])
        )
        assert question == row["question"]["id"]
        q_comments.extend(c["id"] for c in row["question"]["comments"])
        for a in row["answers"]:
            answers[a["id"]].extend(c["id"] for c in a["comments"])
            listed.append(a["id"])
    return {
        key: (q, sorted(qc), {i: sorted(c) for i, c in answers.items()}, sorted(listed))
        for key, (q, qc, answers, listed) in threads.items()
    }
