"""What the operators of this subpackage share: settings, column checks, checkpoints, components."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import prepare, shared_dir

#: Rows handed to Python at once; texts may be long, so batches are kept short.
BATCH_ROWS = 1000

#: Every fifth document (by this remainder) is held out when a model is trained.
HELD_OUT_FOLDS = 5

LLM_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}

_SHIPPED: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Runtime settings, and this package on every executor.

    Skewed joins are split, texts go to Python in short batches.
    """
    prepare(spark)
    for key, value in LLM_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace"), "zip",
            os.path.dirname(package), os.path.basename(package),
        )
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id is not held out."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(False))


def fresh(*taken: list[str]) -> str:
    """A column name no given list of columns holds, whatever the case of its letters."""
    names = {c.lower() for columns in taken for c in columns}
    while True:
        name = f"_{uuid.uuid4().hex[:8]}"
        if name not in names:
            return name


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: the rows go to the folder all executors share, so a lost executor loses none."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def stored(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """Write rows as Parquet to the folder all executors share and read them back."""
    path = shared_dir(df.sparkSession, purpose)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def each_row(df: DataFrame) -> DataFrame:
    """Distinct rows with a number each (``key``) and how often they come (``copies``), both fixed."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return cut(counted.withColumn("key", F.monotonically_increasing_id()))


def own_places(left: pa.Table, right: pa.Table, asked: np.ndarray, rows: np.ndarray, *same: str) -> np.ndarray:
    """For each row of ``left`` the place of its own row in ``right``, -1 if it is not there.

    That is the first row with its id, its vector (in the matrices) and the values of the
    columns ``same``; rows that agree in all of these are equal, so any of them will do.
    """
    columns = ("id", *same)
    mine, theirs = ([t.column(c).to_numpy() for c in columns] for t in (left, right))
    order = np.argsort(theirs[0], kind="stable")
    sorted_ids = theirs[0][order]
    out = np.full(left.num_rows, -1, np.int64)
    for i, vector in enumerate(asked):
        lo, hi = np.searchsorted(sorted_ids, mine[0][i], "left"), np.searchsorted(sorted_ids, mine[0][i], "right")
        places = order[lo:hi]
        fits = (rows[places] == vector).all(axis=1)
        for own, other in zip(mine[1:], theirs[1:], strict=True):
            fits &= other[places] == own[i]
        if fits.any():
            out[i] = places[fits.argmax()]
    return out


def add_columns(
    df: DataFrame,
    inputs: list[str],
    schema: str,
    work: Callable[[list[pa.Array]], list[pa.Array]],
    replace: bool = False,
) -> DataFrame:
    """Append columns worked out in Python from ``inputs``, one Arrow batch at a time.

    ``work`` gets the input columns of a batch and returns the new ones in the order of
    ``schema``.  The other columns pass through.  A new column that clashes with one of
    ``df`` (whatever the case) takes its place.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema.fields
    names = [f.name for f in fields]
    taken = {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in taken]
    marks = [fresh(df.columns, names) for _ in inputs]
    # inputs travel under names of their own: a new column may bear the name of an input
    given = df.select(
        *(df[f"`{c}`"] for c in kept), *(df[f"`{c}`"].alias(m) for c, m in zip(inputs, marks, strict=True))
    )
    out_schema = given.select(*kept).schema
    for f in fields:
        out_schema = out_schema.add(f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = work([batch.column(m) for m in marks])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new], names=[*kept, *names])

    return given.mapInArrow(run, out_schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every node of an undirected graph.

    ``edges`` has two long columns; columns ``node`` and ``component`` are returned, for
    nodes with an edge to another node only.  Alternates the large-star and small-star
    steps (Kiveris et al., SoCC 2014): each step is one aggregation, combined before its
    shuffle, and one equi-join whose hot keys adaptive execution splits.  Only a count of
    changes reaches the driver; each round is checkpointed.
    """
    a, b = edges.columns
    pairs = cut(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    while True:
        # large star: every larger neighbour goes to the smallest neighbour
        both = pairs.select("u", "v").unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        # small star: every smaller neighbour, and the node, go to the smallest one
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_least, "u")
        after = cut(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(joined.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        # done when every node has one edge, to a node without a smaller neighbour
        tops = after.select(F.col("v").alias("node")).distinct()
        open_ = after.join(tops, after.u == tops.node, "left_semi").limit(1).count()
        many = after.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        pairs = after
        if not open_ and not many:
            break
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionAll(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
