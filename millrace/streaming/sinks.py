"""Sinks.  Each query names its checkpoint; batch writes carry the batch number, so a
batch that runs again after a failure overwrites its own output."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.dedup import dedup_latest


def _start(writer, checkpoint: str, trigger: Mapping | None) -> StreamingQuery:
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Hand each micro-batch and its number to ``write``."""
    return _start(df.writeStream.foreachBatch(write), checkpoint, trigger)


def append_table(
    df: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Append rows to a parquet table, each of them once."""
    return _start(
        df.writeStream.format("parquet").outputMode("append").option("path", path),
        checkpoint, trigger,
    )


def append_changes(df: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Append a log of changes, a folder per micro-batch; a repeated batch replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _start(df.writeStream.outputMode("update").foreachBatch(write), checkpoint, trigger)


def append_text(
    df: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Append rows as JSON text, one record per line."""
    text = df.select(F.to_json(F.struct("*")).alias("value"))
    return _start(
        text.writeStream.format("text").outputMode("append").option("path", path),
        checkpoint, trigger,
    )


def kafka_topic(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    key: str | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Write rows as JSON to a topic (needs the Kafka package of Spark)."""
    value = F.to_json(F.struct("*")).alias("value")
    records = df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)
    return _start(
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic),
        checkpoint, trigger,
    )


def jdbc_table(
    df: DataFrame,
    url: str,
    table: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Append rows to a table of a database, one write per micro-batch.

    The column ``batch_id`` tells a repeated batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.format("jdbc")
            .options(url=url, dbtable=table, **(options or {}))
            .mode("append")
            .save()
        )

    return _start(df.writeStream.foreachBatch(write), checkpoint, trigger)


def fan_out(
    df: DataFrame,
    outputs: Callable[[DataFrame], Mapping[str, DataFrame]],
    path: str,
    checkpoint: str,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Write several outputs of one stream below ``path``, reading and parsing it once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, out in outputs(batch).items():
                out.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return _start(df.writeStream.foreachBatch(write), checkpoint, trigger)


class KeyedTable:
    """A table with one row per key, written by change batches.

    A batch adds its newest row per key in a folder of its own and touches no older file,
    so the cost of a write goes with the batch, not with the table.  Every ``fold_every``
    batches the writer folds the newest snapshot and the batches since into a new snapshot.
    A read takes the newest finished snapshot and the finished batches after it, and keeps
    the newest row per key; folders still being written, or left by a failed try, do not
    count.  With a ``schema`` the table can be read before its first batch; with
    ``partition`` (one of the keys) reads of one value open the files of that value only.

    After a fold the writer removes what no reader needs: snapshots but the newest two, and
    batches that the older of these covers, except the newest ``keep`` of them, from which the
    change feed is read.  ``keep=None`` removes nothing.
    """

    def __init__(
        self, path: str, keys: Sequence[str], version: Sequence[str],
        schema: str | None = None, partition: str | None = None, fold_every: int | None = None, keep: int | None = None,
    ) -> None:
        self.path = path
        self.keep = keep
        self.keys = list(keys)
        self.version = list(version)
        self.schema = schema
        self.partition = partition
        self.fold_every = fold_every

    def _newest(self, df: DataFrame, *more: str) -> DataFrame:
        first, *rest = [*self.version, *more]
        return dedup_latest(df, self.keys, first, rest)

    def _finished(self, spark: SparkSession, kind: str) -> list[int]:
        """Numbers of the finished folders of a kind, smallest first."""
        jvm = spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(top)]
        done = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{n}/_SUCCESS"))]
        return sorted(int(n.partition("=")[2]) for n in done if n.startswith("batch_id="))

    def _save(self, rows: DataFrame, kind: str, number: int) -> None:
        writer = rows.write.mode("overwrite")
        if self.partition:
            writer = writer.partitionBy(self.partition)
        writer.parquet(f"{self.path}/{kind}/batch_id={number}")

    def _load(self, spark: SparkSession, kind: str, numbers: Sequence[int]) -> DataFrame:
        reader = spark.read.option("basePath", f"{self.path}/{kind}")
        if self.schema:
            reader = reader.schema(f"{self.schema}, batch_id bigint")
        return reader.parquet(*[f"{self.path}/{kind}/batch_id={n}" for n in numbers])

    def has_batch(self, spark: SparkSession, batch_id: int) -> bool:
        return batch_id in self._finished(spark, "batches") or any(n >= batch_id for n in self._finished(spark, "snapshots"))

    def changes(self, spark: SparkSession, after: int | None = None, deleted: str | None = None) -> DataFrame:
        """Changes of the batches after number ``after``: ``op, batch_id, before, after``.

        ``op`` is insert, update or delete; ``before`` and ``after`` are the rows of the key
        around the batch, null where there was none.  A batch that writes a key's version again,
        or an older one, changes nothing.  Rows for which ``deleted`` holds are tombstones: they
        take the key away, and a key that was not there gives no change.  The state before
        comes from the newest snapshot up to ``after`` and the batches since.
        """
        first = -1 if after is None else after
        finished = self._finished(spark, "batches")
        later = [n for n in finished if n > first]
        covering = [n for n in self._finished(spark, "snapshots") if n > first]
        if covering and not (finished and finished[0] <= first + 1):
            raise ValueError(f"batches after {first} were removed; read the table and go on from its newest batch")
        if not later:
            return self._no_changes(spark)
        parts = [self._load(spark, "batches", later)]
        if after is not None:
            parts.append(self._rows(spark, after).withColumn("batch_id", F.lit(after)))
        columns = [c for c in parts[0].columns if c != "batch_id"]
        rows = parts[0].select(*columns, F.col("batch_id").cast("long").alias("batch_id"))
        for p in parts[1:]:
            rows = rows.unionByName(p.select(*columns, F.col("batch_id").cast("long").alias("batch_id")), allowMissingColumns=True)
        version = F.struct(*[F.col(c) for c in self.version])
        by_key = Window.partitionBy(*self.keys).orderBy("batch_id")
        before = by_key.rowsBetween(Window.unboundedPreceding, -1)
        # the newest version so far; an equal one of a later batch changes nothing
        seen = rows.select(
            "batch_id", *self.keys, F.struct(*columns).alias("after"), version.alias("_v"),
            (F.expr(f"coalesce({deleted}, false)") if deleted else F.lit(False)).alias("_gone"),
        ).withColumn("_most", F.max("_v").over(before))
        kept = seen.where("_most IS NULL OR _v > _most").select("batch_id", *self.keys, "after", "_gone")
        live = F.when(~F.col("_gone"), F.col("after"))
        pairs = kept.withColumn("before", F.lag(live).over(by_key)).withColumn("after", live)
        op = (
            F.when(F.col("before").isNull() & F.col("after").isNotNull(), "insert")
            .when(F.col("before").isNotNull() & F.col("after").isNull(), "delete")
            .when(F.col("before").isNotNull(), "update")
        )
        return pairs.where(F.col("batch_id") > first).select(op.alias("op"), "batch_id", "before", "after").where("op IS NOT NULL")

    def _no_changes(self, spark: SparkSession) -> DataFrame:
        if not self.schema:
            raise ValueError(f"nothing was written to {self.path} yet, and it has no schema")
        row = spark.createDataFrame([], self.schema).schema
        empty = T.StructType().add("op", "string").add("batch_id", "long").add("before", row).add("after", row)
        return spark.createDataFrame([], empty)

    def changes_since(
        self, spark: SparkSession, write: Callable[[DataFrame, int], None], done: int | None = None, deleted: str | None = None
    ) -> int | None:
        """Hand all changes after batch ``done`` to ``write`` with the newest batch number, and return it.

        A reader keeps the number with its own output and goes on from there.
        """
        finished = self._finished(spark, "batches")
        newest = finished[-1] if finished else None
        if newest is None or newest == done:
            return done
        write(self.changes(spark, done, deleted).where(F.col("batch_id") <= newest), newest)
        return newest

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """Add one batch; writing the same batch again replaces it."""
        self._save(self._newest(changes), "batches", batch_id)
        if self.fold_every and (batch_id + 1) % self.fold_every == 0:
            self.fold(changes.sparkSession, batch_id)

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Write the rows of all batches up to ``upto`` as a snapshot."""
        self._save(self._rows(spark, upto), "snapshots", upto)
        if self.keep is not None:
            self._remove_old(spark)

    def _remove_old(self, spark: SparkSession) -> None:
        snapshots = self._finished(spark, "snapshots")
        if len(snapshots) < 2:
            return
        *older, covered, _ = snapshots
        batches = self._finished(spark, "batches")
        kept = set(batches[len(batches) - self.keep :] if self.keep else [])
        gone = [("snapshots", n) for n in older] + [("batches", n) for n in batches if n <= covered and n not in kept]
        jvm = spark._jvm
        for kind, n in gone:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/batch_id={n}")
            # the mark of a finished folder goes first: a folder half removed does not count
            fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            fs.delete(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS"), False)
            fs.delete(folder, True)

    def _rows(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        kept = [n for n in self._finished(spark, "snapshots") if upto is None or n < upto][-1:]
        after = kept[0] if kept else -1
        batches = [n for n in self._finished(spark, "batches") if n > after and (upto is None or n <= upto)]
        parts = [self._load(spark, k, n) for k, n in (("snapshots", kept), ("batches", batches)) if n]
        if not parts:
            if not self.schema:
                raise ValueError(f"nothing was written to {self.path} yet, and it has no schema")
            return spark.createDataFrame([], self.schema)
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        return self._newest(rows, "batch_id").drop("batch_id")

    def read(self, spark: SparkSession, deleted: str | None = None) -> DataFrame:
        """The newest row per key; ``deleted`` is a condition for keys to leave out."""
        rows = self._rows(spark)
        return rows.where(f"NOT coalesce({deleted}, false)") if deleted else rows

    def compact(self, spark: SparkSession, path: str, batch_id: int) -> KeyedTable:
        """Write the current rows as the first batch of a new table at ``path``."""
        table = KeyedTable(path, self.keys, self.version, self.schema, self.partition, self.fold_every, self.keep)
        table.write(self.read(spark), batch_id)
        return table

    def sink(
        self, df: DataFrame, checkpoint: str, trigger: Mapping | None = None
    ) -> StreamingQuery:
        """Feed the table from a stream of changes."""
        return _start(df.writeStream.foreachBatch(self.write), checkpoint, trigger)
