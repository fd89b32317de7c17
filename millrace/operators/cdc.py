"""Change records: parsing, filters, projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.codes import BOOTSTRAP_INSERT, DEFAULT_DATABASE

CORRUPT = "_corrupt"


def _loose(kind: T.DataType) -> T.DataType:
    """The same shape with whole numbers as text, which takes a number in any spelling."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType))
    return T.StringType() if isinstance(kind, T.LongType) else kind


def _typed(value: Column, kind: T.DataType) -> Column:
    """A loosely parsed value in its type; what is no whole number becomes null."""
    if isinstance(kind, T.StructType):
        parts = [_typed(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _typed(x, kind.elementType))
    if isinstance(kind, T.LongType):
        return value.try_cast("decimal(38,6)").try_cast("bigint")
    return value


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse a text column; text that is no JSON object is kept in ``_corrupt``.

    Only the text itself decides whether a record is broken.  A number may be written as
    text or with a fraction of zero; a field of another type is null, and the others of its
    record stay.
    """
    text = F.trim(F.col(value))
    whole = text.startswith("{") & text.endswith("}") & F.try_parse_json(F.col(value)).isNotNull()
    # a row of its own (explode) rather than a column: filters on the result then stay
    # above the parser, and each text is parsed once
    parsed = F.struct(
        F.from_json(F.col(value), _loose(schema)).alias("record"), F.coalesce(whole, F.lit(False)).alias("whole")
    )
    return df.select("*", F.explode(F.array(parsed)).alias("_parsed")).select(
        *[c for c in df.columns if c != value],
        *[_typed(F.col(f"_parsed.record.{f.name}"), f.dataType).alias(f.name) for f in schema.fields],
        F.when(~F.col("_parsed.whole"), F.coalesce(F.col(value), F.lit(""))).alias(CORRUPT),
    )


def split_cdc(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Change envelopes from JSON text, and the text of broken records."""
    parsed = parse_json(raw, schemas.CDC, value)
    broken = parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT), broken


def parse_cdc(raw: DataFrame, value: str = "value") -> DataFrame:
    """Change envelopes only; :func:`split_cdc` also gives the broken records."""
    return split_cdc(raw, value)[0]


def changes(
    cdc: DataFrame, table: str, types: Sequence[str], database: str = DEFAULT_DATABASE
) -> DataFrame:
    """Records of one table with one of the given change types."""
    return cdc.where(
        (F.col("database") == database) & (F.col("table") == table) & F.col("type").isin(*types)
    )


def data(column: str) -> Column:
    """New value of a column (null if the record lacks it)."""
    return F.col("data")[column]


def old(column: str) -> Column:
    """Previous value of a column that this update changed, else null."""
    return F.col("old")[column]


def fields(*columns: str) -> list[Column]:
    """The new values of several columns under their own names."""
    return [F.expr(f"data['{c}'] AS `{c}`") for c in columns]


def changed(column: str) -> Column:
    return old(column).isNotNull()


def moved(column: str, before: str, after: str) -> Column:
    return (data(column) == after) & (old(column) == before)


def increase(column: str) -> Column:
    """New minus previous value; null unless both are whole numbers."""
    return data(column).try_cast("int") - old(column).try_cast("int")


def commit_time() -> Column:
    return F.timestamp_seconds(F.col("ts"))


def snapshot_then_changes(
    snapshot: DataFrame, changes: DataFrame, table: str, position: tuple[int, int], database: str = DEFAULT_DATABASE
) -> DataFrame:
    """A table as it was at ``position`` (commit time, transaction) and its changes after it, as one feed.

    Rows of ``snapshot`` become bootstrap records at the position, with all columns as text.
    Changes of the table up to the position are in the snapshot already and are left out:
    nothing comes twice, and a row deleted before the position does not come back.  With
    ``changes`` a stream, the feed needs the snapshot once only: see ``jobs.load_snapshot``.
    """
    ts, xid = position
    taken = snapshot.select(
        F.lit(database).alias("database"), F.lit(table).alias("table"), F.lit(BOOTSTRAP_INSERT).alias("type"),
        F.lit(ts).cast("bigint").alias("ts"), F.lit(xid).cast("bigint").alias("xid"),
        F.map_filter(
            F.create_map(*[x for c in snapshot.columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]),
            lambda _, v: v.isNotNull(),
        ).alias("data"),
        F.lit(None).cast("map<string,string>").alias("old"),
    )
    return taken.unionByName(after_position(changes, table, position, database))


def after_position(
    changes: DataFrame, table: str, position: tuple[int, int], database: str = DEFAULT_DATABASE
) -> DataFrame:
    """Changes of one table after a position of the log; records without a time are left out."""
    ts, xid = position
    later = (F.col("ts") > ts) | ((F.col("ts") == ts) & (F.coalesce(F.col("xid"), F.lit(0)) > xid))
    return changes.where((F.col("database") == database) & (F.col("table") == table) & later).select(
        "database", "table", "type", "ts", "xid", "data", "old"
    )
