"""Behaviour logs: dirty split and the five-way router."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.cdc import CORRUPT, parse_json


def parse_logs(raw: DataFrame, value: str = "value") -> DataFrame:
    """Log records plus ``_corrupt``, the text of records that are no JSON object."""
    return parse_json(raw, schemas.LOG, value)


def dirty(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def clean(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def errors(logs: DataFrame) -> DataFrame:
    """Error payloads; the record itself also goes on to its other output."""
    return logs.where(F.col("err").isNotNull()).drop("start", "page", "displays", "actions")


def starts(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("start").isNotNull()).drop("err", "page", "displays", "actions")


def _page_records(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("start").isNull())


def pages(logs: DataFrame) -> DataFrame:
    return _page_records(logs).drop("err", "start", "displays", "actions")


def _exploded(logs: DataFrame, column: str, min_size: int) -> DataFrame:
    kept = [c for c in logs.columns if c not in schemas.LOG.fieldNames()]
    return (
        _page_records(logs)
        .where(F.size(column) >= min_size)
        .select(
            *kept,
            F.to_json("common").alias("common"),
            F.col("page.page_id").alias("page_id"),
            F.col("ts").alias("_log_ts"),
            F.posexplode(column).alias("pos", "_item"),
        )
    )


def displays(logs: DataFrame, min_size: int = 1) -> DataFrame:
    """One row per display, with ``common`` as JSON text, page and time of its record.

    ``min_size=2`` leaves out records with a single display.
    """
    return _exploded(logs, "displays", min_size).select(
        "*", "_item.*", F.col("_log_ts").alias("ts")
    ).drop("_item", "_log_ts")


def actions(logs: DataFrame, min_size: int = 1) -> DataFrame:
    """One row per action; an action keeps its own time."""
    return _exploded(logs, "actions", min_size).select("*", "_item.*").drop("_item", "_log_ts")


def route(logs: DataFrame, min_size: int = 1) -> dict[str, DataFrame]:
    """The five outputs of the log router."""
    return {
        "error": errors(logs),
        "start": starts(logs),
        "display": displays(logs, min_size),
        "action": actions(logs, min_size),
        "page": pages(logs),
    }
