"""Running jobs: stream in, tables out."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import logs, routing
from millrace.operators.cdc import CORRUPT, after_position, snapshot_then_changes
from millrace.operators.lookups import ExpiringTable
from millrace.schemas import CDC
from millrace.streaming.sinks import KeyedTable, fan_out, start_batches

#: Micro-batches between two snapshots of the dimension table.
FOLD_EVERY = 32
#: Batches whose changes can still be read from the feed after they were folded.
KEEP_BATCHES = 64

#: Columns of the dimension table.
DIMENSIONS = (
    "sink_table string, sink_columns string, pk string, type string, ts bigint, xid bigint, data map<string, string>"
)


def route_logs(
    parsed: DataFrame, path: str, checkpoint: str, min_size: int = 1, trigger: Mapping | None = None
) -> StreamingQuery:
    """The log router: broken records and the five outputs as tables below ``path``."""

    def outputs(batch: DataFrame) -> dict[str, DataFrame]:
        return {"dirty": logs.dirty(batch), **logs.route(logs.clean(batch), min_size)}

    assert CORRUPT in parsed.columns, "expects records from parse_logs"
    return fan_out(parsed, outputs, path, checkpoint, trigger)


def append_enriched(
    rows: DataFrame, enrich: Callable[[DataFrame, DataFrame], DataFrame], table: ExpiringTable, path: str, checkpoint: str,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Append ``enrich(batch, lookup table)``, with the table in force when each micro-batch starts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        enrich(batch, table.current()).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return start_batches(rows, write, checkpoint, trigger)


def load_dimensions(
    cdc: DataFrame,
    read_routes: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    trigger: Mapping | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """The dimension job: change records to one keyed table of all dimensions.

    ``read_routes`` is called for each micro-batch, so a changed configuration
    takes effect with the next one.  Every ``fold_every`` micro-batches the table is folded.
    """
    table = dimension_store(path, fold_every)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(routing.route_dimensions(batch, read_routes()), batch_id)

    writer = cdc.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def load_snapshot(
    table: KeyedTable, snapshot: DataFrame, changes: DataFrame, name: str, position: tuple[int, int], checkpoint: str,
    pk: str = "id", trigger: Mapping | None = None,
) -> StreamingQuery:
    """A keyed table filled from a snapshot once, then from the changes after the snapshot's position.

    ``position`` is (commit time, transaction).  The snapshot is written as the table's first
    batch, with the position as the version of its rows; a restart finds it and goes on with
    the changes where the checkpoint stopped.  On a restart the position of the first start is
    passed again; the snapshot is not read then.
    """
    spark = changes.sparkSession
    key = F.col("data")[pk]
    later = after_position(changes, name, position).withColumn("pk", key).where("pk IS NOT NULL")
    if not table.has_batch(spark, 0):
        no_changes = spark.createDataFrame([], CDC)
        table.write(snapshot_then_changes(snapshot, no_changes, name, position).withColumn("pk", key), 0)
    return start_batches(later, lambda batch, number: table.write(batch, number + 1), checkpoint, trigger)


def snapshot_store(path: str, fold_every: int = FOLD_EVERY) -> KeyedTable:
    """The keyed table of one source table: its newest change record per key, deletions included."""
    schema = (
        "database string, table string, type string, ts bigint, xid bigint, data map<string, string>, "
        "old map<string, string>, pk string"
    )
    return KeyedTable(path, ["pk"], ["ts", "xid"], schema, fold_every=fold_every, keep=KEEP_BATCHES)


def load_dimensions_by_time(
    cdc: DataFrame, read_versions: Callable[[], DataFrame], path: str, checkpoint: str,
    trigger: Mapping | None = None, fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """As :func:`load_dimensions`, each record by the configuration in force at its own time.

    ``read_versions`` gives the history of the configuration (``routing.route_versions``).
    """
    table = dimension_store(path, fold_every)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(routing.route_by_time(batch, read_versions()), batch_id)

    return start_batches(cdc, write, checkpoint, trigger)


def dimension_store(path: str, fold_every: int = FOLD_EVERY) -> KeyedTable:
    """The keyed table of all dimensions, by sink table; it reads as empty before its first batch."""
    return KeyedTable(path, ["sink_table", "pk"], ["ts", "xid"], DIMENSIONS, "sink_table", fold_every, KEEP_BATCHES)
