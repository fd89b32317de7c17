"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Needed for keyed state; SQL settings, so they can also be set on a live session.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a join of streams keeps one store per task instead of four
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

#: Split a skewed join also where that costs a further shuffle.
SKEW_CONF = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}

#: Zone for day boundaries and for text timestamps.
ZONE_CONF = {"spark.sql.session.timeZone": "UTC"}

#: Settings read when the session starts.
START_CONF = {
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(
    app: str = "millrace",
    master: str | None = None,
    partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings above; ``conf`` overrides them.

    ``partitions`` is the number of shuffle partitions: on a large cluster a few per
    core, so that each fits in memory.  Adaptive execution merges small ones in
    batch; for streams with state the number is fixed by their first start.
    """
    if partitions:
        conf.setdefault("spark.sql.shuffle.partitions", str(partitions))
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **STATE_CONF, **SKEW_CONF, **ZONE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in {**STATE_CONF, **SKEW_CONF, **ZONE_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for ``purpose`` below the shared folder of the cluster.

    The cluster names the folder in ``spark.checkpoint.dir``.  Where that is
    unset and the master is local (tests), a temporary folder stands in for it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
