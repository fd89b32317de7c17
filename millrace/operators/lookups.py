"""Joins with dictionaries and dimension tables.

Dimension tables get no hint: Spark knows the size of files, broadcasts them
while they are below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both
sides beyond it, where adaptive execution splits skewed partitions of the fact
side.  Where a size is known only at run time (change feeds, databases), adaptive
execution broadcasts what turned out small; a dictionary of a database that streams
look up belongs in a table, whose size is known.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import shared_dir


class ExpiringTable:
    """A lookup table that is read again once it is older than ``max_age`` seconds.

    Each reading is written to the shared folder, so all tasks of a micro-batch, and tasks that
    are tried again, see one version of it, and the source is asked once per reading, not once
    per task.  Its size is known then, and Spark broadcasts it only while it is small.  ``clock``
    gives seconds.
    """

    def __init__(self, read: Callable[[], DataFrame], max_age: float, clock: Callable[[], float] = time.time) -> None:
        self._read = read
        self._max_age = max_age
        self._clock = clock
        self._held: DataFrame | None = None
        self._since = 0.0

    def current(self) -> DataFrame:
        """The version in force: ask once per micro-batch."""
        now = self._clock()
        if self._held is None or now - self._since >= self._max_age:
            rows = self._read()
            path = shared_dir(rows.sparkSession, "lookup")
            rows.write.parquet(path)
            self._held, self._since = rows.sparkSession.read.schema(rows.schema).parquet(path), now
        return self._held


def lookup(
    fact: DataFrame,
    table: DataFrame,
    code: str,
    take: Mapping[str, str],
    key: str = "id",
    how: str = "left",
) -> DataFrame:
    """Add the columns ``{output name: table column}`` of the row whose ``key`` equals ``code``.

    ``how="left"`` keeps rows without a match, ``how="inner"`` drops them.
    """
    side = table.select(
        F.col(key).alias("_lookup_key"), *[F.col(c).alias(name) for name, c in take.items()]
    )
    return fact.join(side, F.col(code) == F.col("_lookup_key"), how).drop("_lookup_key")


def dictionary_name(fact: DataFrame, dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Add the name of ``code``; rows with a code the dictionary lacks are dropped."""
    return lookup(fact, dictionary, code, {name: "dic_name"}, key="dic_code", how="inner")
