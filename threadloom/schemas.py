"""Entity schemas, stated once and used by the XML scan, the thread builder and the sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Sink column, XML attribute and type of every scalar field, in sink order.
# ``pos_type_id`` is the table's own spelling.
POST_FIELDS = (
    ("id", "Id", T.StringType()),
    ("pos_type_id", "PostTypeId", T.StringType()),
    ("accepted_answer_id", "AcceptedAnswerId", T.StringType()),
    ("parent_id", "ParentId", T.StringType()),
    ("creation_date", "CreationDate", T.TimestampNTZType()),
    ("deletion_date", "DeletionDate", T.TimestampNTZType()),
    ("score", "Score", T.IntegerType()),
    ("view_count", "ViewCount", T.IntegerType()),
    ("body", "Body", T.StringType()),
    ("owner_user_id", "OwnerUserId", T.StringType()),
    ("owner_display_name", "OwnerDisplayName", T.StringType()),
    ("last_editor_user_id", "LastEditorUserId", T.StringType()),
    ("last_editor_display_name", "LastEditorDisplayName", T.StringType()),
    ("last_edit_date", "LastEditDate", T.TimestampNTZType()),
    ("last_activity_date", "LastActivityDate", T.TimestampNTZType()),
    ("title", "Title", T.StringType()),
    ("tags", "Tags", T.StringType()),
    ("answer_count", "AnswerCount", T.IntegerType()),
    ("comment_count", "CommentCount", T.IntegerType()),
    ("favorite_count", "FavoriteCount", T.IntegerType()),
    ("closed_date", "ClosedDate", T.TimestampNTZType()),
    ("community_owned_date", "CommunityOwnedDate", T.TimestampNTZType()),
)

COMMENT_FIELDS = (
    ("id", "Id", T.StringType()),
    ("post_id", "PostId", T.StringType()),
    ("score", "Score", T.LongType()),
    ("text", "Text", T.StringType()),
    ("creation_date", "CreationDate", T.TimestampNTZType()),
    ("user_display_name", "UserDisplayName", T.StringType()),
    ("user_id", "UserId", T.StringType()),
)

# Post types that take part in threads.
QUESTION = "1"
ANSWER = "2"


def _scalars(fields) -> list[T.StructField]:
    return [T.StructField(name, dtype, True) for name, _, dtype in fields]


COMMENT_SCHEMA = T.StructType(_scalars(COMMENT_FIELDS))
COMMENT_LIST = T.ArrayType(COMMENT_SCHEMA, True)
POST_SCHEMA = T.StructType(_scalars(POST_FIELDS) + [T.StructField("comments", COMMENT_LIST, True)])
POST_LIST = T.ArrayType(POST_SCHEMA, True)
THREAD_SCHEMA = T.StructType(
    [T.StructField("question", POST_SCHEMA, False), T.StructField("answers", POST_LIST, True)]
)
# A thread in parts, for callers that want no row of unbounded size.
THREAD_PART_SCHEMA = T.StructType(
    [
        T.StructField("thread_key", T.StringType(), False),
        T.StructField("part", T.IntegerType(), False),
        T.StructField("n_parts", T.IntegerType(), False),
        *THREAD_SCHEMA.fields,
    ]
)

POST_COLUMNS = tuple(POST_SCHEMA.names)
POST_SCALARS = tuple(name for name, _, _ in POST_FIELDS)
COMMENT_COLUMNS = tuple(COMMENT_SCHEMA.names)

# Optional column: a stable number for each stored row, used to spread the rows of one very large
# group (exact copies too) over several tasks.
ROW_ID = "_row_id"


@dataclass(frozen=True)
class Entity:
    """One kind of record: its table schema and, when it is read from XML, its attributes."""

    name: str
    schema: T.StructType
    fields: tuple = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


ENTITIES = {
    "post": Entity("post", POST_SCHEMA, POST_FIELDS),
    "comment": Entity("comment", COMMENT_SCHEMA, COMMENT_FIELDS),
    "thread": Entity("thread", THREAD_SCHEMA),
    "thread_part": Entity("thread_part", THREAD_PART_SCHEMA),
}


def entity(name: str) -> Entity:
    """Look an entity up by name; an unknown one is an error."""
    if name not in ENTITIES:
        raise ValueError(f"unsupported entity {name!r}; expected one of {sorted(ENTITIES)}")
    return ENTITIES[name]
