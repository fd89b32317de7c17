"""Schemas of the raw inputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


STRING_MAP = T.MapType(T.StringType(), T.StringType())

#: One change record of the business database.
CDC = T.StructType(
    _strings("database", "table", "type")
    + [
        T.StructField("ts", T.LongType()),
        T.StructField("xid", T.LongType()),
        T.StructField("data", STRING_MAP),
        T.StructField("old", STRING_MAP),
    ]
)

COMMON = T.StructType(_strings("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc"))

PAGE = T.StructType(
    _strings("page_id", "last_page_id", "item", "item_type")
    + [T.StructField("during_time", T.LongType())]
    + _strings("source_type")
)

DISPLAY = T.StructType(
    _strings("display_type", "item", "item_type")
    + [T.StructField("order", T.LongType()), T.StructField("pos_id", T.LongType())]
)

ACTION = T.StructType(
    _strings("action_id", "item", "item_type") + [T.StructField("ts", T.LongType())]
)

#: One behaviour log record.  ``start`` and ``err`` stay JSON text.
LOG = T.StructType(
    [
        T.StructField("common", COMMON),
        T.StructField("page", PAGE),
        T.StructField("displays", T.ArrayType(DISPLAY)),
        T.StructField("actions", T.ArrayType(ACTION)),
        *_strings("start", "err"),
        T.StructField("ts", T.LongType()),
    ]
)

ROUTE = T.StructType(
    _strings("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")
)

#: One change record of the routing configuration.
ROUTE_CHANGE = T.StructType(
    [
        T.StructField("before", ROUTE),
        T.StructField("after", ROUTE),
        *_strings("op"),
        T.StructField("ts_ms", T.LongType()),
    ]
)

DICTIONARY = T.StructType(_strings("dic_code", "dic_name", "parent_code"))
