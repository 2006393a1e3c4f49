"""Fixed table layouts."""

from pyspark.sql import types as T


def _required(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable=False) for name, kind in fields])


_STRING = T.StringType()
_STRINGS = T.ArrayType(T.StringType(), containsNull=False)

CANDIDATES = _required(
    ("id", _STRING),
    ("repository_group_id", _STRING),
    ("subject", _STRING),
    ("diff", _STRING),
    ("committed_at_utc", _STRING),
    ("patch_id", _STRING),
)

SPLIT_ROWS = T.StructType([*CANDIDATES.fields, T.StructField("split", T.StringType(), False)])

PROVENANCE = _required(
    ("id", _STRING),
    ("repository_group_id", _STRING),
    ("repository_path", _STRING),
    ("remote_urls", _STRINGS),
    ("commit_sha", _STRING),
    ("author_name", _STRING),
    ("author_email", _STRING),
)

REPOSITORIES = _required(
    ("path", _STRING),
    ("remotes", _STRINGS),
    ("shallow", T.BooleanType()),
)

# `seq` orders the decisions on one id: the highest one counts.
DECISIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("approved", T.BooleanType()),
        T.StructField("seq", T.LongType()),
    ]
)

REFERENCE_COLUMNS = ("id", "repository_group_id", "subject", "diff", "committed_at_utc")
QUEUE_COLUMNS = ("split", "id", "subject", "diff")
SPLITS = ("train", "validation", "test")
HELD_OUT = ("validation", "test")
