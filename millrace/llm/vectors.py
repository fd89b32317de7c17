"""Near-duplicate vectors by an epsilon grid order join.

Vectors of one label and length whose cosine reaches the threshold are linked; for vectors
of length one that is a Euclidean distance of at most epsilon.  The leading principal
directions (from a bounded sample) span a grid with cells of width epsilon; vectors are
sorted by their cells, first direction first, and cut into blocks, the sequence intervals.
Two blocks can only hold a link if their boxes over these directions come within epsilon,
so blocks meet by the first cells they touch.  Two blocks are joined by halving: two
intervals whose boxes are further apart than epsilon are skipped, small ones are compared
by a matrix product in double precision.

Copies of a vector are joined as one.  A task returns a number of links and one link of
the component per vector, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import connected_components, cut, ready, stored

COSINE = 0.98
#: Vectors the principal directions are learnt from, taken by a hash of the id.
MAX_SAMPLE = 4096
DIRECTIONS = 8
#: Directions whose cells decide which blocks meet.
CELLS = 2
BLOCK = 1024
LEAF = 64


def _directions(sample: np.ndarray) -> np.ndarray:
    """Leading principal directions, one per column."""
    if not sample.size:
        return np.zeros((sample.shape[1] if sample.ndim == 2 else 0, 0))
    centred = sample - sample.mean(axis=0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    return vectors[:, ::-1][:, :DIRECTIONS]


def _links(a: dict, b: dict, eps: float, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Copies linked to each vector of a and of b, and the smallest place each one reaches."""
    same = a is b
    na, nb = len(a["x"]), len(b["x"])
    n_a, n_b = np.zeros(na, np.int64), np.zeros(nb, np.int64)
    rows, cols = [], []
    stack = [(0, na, 0, nb)]
    while stack:
        i0, i1, j0, j1 = stack.pop()
        if same and j1 <= i0:
            continue
        low = np.maximum(a["p"][i0:i1].min(axis=0), b["p"][j0:j1].min(axis=0))
        high = np.minimum(a["p"][i0:i1].max(axis=0), b["p"][j0:j1].max(axis=0))
        if (np.maximum(low - high, 0) ** 2).sum() > eps * eps:
            continue
        if i1 - i0 > LEAF or j1 - j0 > LEAF:
            if i1 - i0 >= j1 - j0:
                m = (i0 + i1) // 2
                stack += [(i0, m, j0, j1), (m, i1, j0, j1)]
            else:
                m = (j0 + j1) // 2
                stack += [(i0, i1, j0, m), (i0, i1, m, j1)]
            continue
        dots = a["x"][i0:i1] @ b["x"][j0:j1].T
        near = dots >= cosine * a["norm"][i0:i1, None] * b["norm"][None, j0:j1]
        if same:
            near &= np.arange(i0, i1)[:, None] < np.arange(j0, j1)[None, :]
        r, c = np.nonzero(near)
        rows.append((r + i0).astype(np.int32))
        cols.append((c + j0).astype(np.int32))
        n_a[i0:i1] += near @ b["copies"][j0:j1]
        n_b[j0:j1] += near.T @ a["copies"][i0:i1]
    r = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    c = (np.concatenate(cols) if cols else np.zeros(0, np.int32)) + (0 if same else na)
    label = np.arange(na if same else na + nb)
    while len(r):
        before = label.copy()
        np.minimum.at(label, r, label[c])
        np.minimum.at(label, c, label[r])
        label = label[label]
        if (label == before).all():
            break
    return (n_a + n_b, np.zeros(0, np.int64), label) if same else (n_a, n_b, label)


def near_duplicates(
    df: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE,
) -> DataFrame:
    """One row per vector: ``id_``, ``n_links``, ``component_id`` (smallest id reachable), ``kept``.

    Vectors are compared within equal, non-null labels and equal lengths only; vectors that
    are null, empty, zero, or hold null or non-finite components link with nothing.  A row
    without id has no links and no component, and is kept.  Rows that repeat an id count
    as copies of one another in ``n_links`` if their vectors link.  Other columns are not
    read.  Frames without rows give none.
    """
    spark = ready(df.sparkSession)
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine)) * (1 + 1e-9) + 1e-12)
    x = F.col("x")
    usable = F.coalesce(
        F.col("label").isNotNull() & F.col("id").isNotNull() & (F.size("x") > 0)
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
        & F.exists(x, lambda v: v != 0),
        F.lit(False),
    )
    given = df.select(
        F.col(f"`{id_}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("x"),
    ).withColumn("usable", usable)
    # -0.0 and 0.0 are one value; copies of a vector are joined as one
    rows = given.where("usable").select("id", "label", F.transform(x, lambda v: v + F.lit(0.0)).alias("x"))
    one = rows.groupBy("label", "x").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    one = stored(one, "vectors")

    # the principal directions of each length
    sample = one.select("x").orderBy(F.xxhash64("rep"), "rep").limit(MAX_SAMPLE).collect()
    by_length: dict[int, list] = {}
    for (v,) in sample:
        by_length.setdefault(len(v), []).append(np.array(v) / max(np.linalg.norm(v), 1e-300))
    axes = spark.sparkContext.broadcast({d: _directions(np.array(vs)) for d, vs in by_length.items()})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, shown = [], []
            for v in batch.column("x").to_pylist():
                v = np.array(v)
                v = v / np.abs(v).max()
                v /= np.linalg.norm(v)
                w = axes.value.get(len(v))
                p = np.zeros(DIRECTIONS)
                if w is not None:
                    p[: w.shape[1]] = v @ w
                shown.append(p)
                cells.append(np.floor(p / eps).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("label", "rep", "copies", "x")), pa.array(cells, pa.list_(pa.int64())),
                 pa.array(shown, pa.list_(pa.float64()))],
                names=["label", "rep", "copies", "x", "cell", "p"],
            )

    placed = one.mapInArrow(
        place, "label string, rep long, copies long, x array<double>, cell array<long>, p array<double>"
    ).withColumn("dims", F.size("x"))
    order = ["label", "dims", *(F.col("cell")[i] for i in range(DIRECTIONS)), "rep"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []

        def settle() -> pa.RecordBatch:
            cells = sorted({tuple(r["cell"][:CELLS]) for r in rows})
            return pa.RecordBatch.from_pylist([{
                "label": rows[0]["label"], "dims": rows[0]["dims"], "block": rows[0]["rep"],
                "cells": [list(c) for c in cells],
                "reps": np.array([r["rep"] for r in rows], "<i8").tobytes(),
                "copies": np.array([r["copies"] for r in rows], "<i8").tobytes(),
                "x": np.array([r["x"] for r in rows], "<f8").tobytes(),
                "p": np.array([r["p"] for r in rows], "<f8").tobytes(),
            }], schema=pa.schema([
                ("label", pa.string()), ("dims", pa.int32()), ("block", pa.int64()),
                ("cells", pa.list_(pa.list_(pa.int64()))), ("reps", pa.binary()), ("copies", pa.binary()),
                ("x", pa.binary()), ("p", pa.binary()),
            ]))

        for batch in batches:
            for r in batch.to_pylist():
                if rows and (len(rows) >= BLOCK or (r["label"], r["dims"]) != (rows[0]["label"], rows[0]["dims"])):
                    yield settle()
                    rows = []
                rows.append(r)
        if rows:
            yield settle()

    blocks = stored(
        placed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(
            block,
            "label string, dims int, block long, cells array<array<long>>, reps binary, copies binary, x binary, p binary",
        ),
        "vector-blocks",
    )
    # blocks meet where a cell of one is a cell of the other or next to it
    touched = blocks.select("label", "dims", "block", F.explode("cells").alias("cell"))
    steps = [[i, j] for i in (-1, 0, 1) for j in (-1, 0, 1)]
    around = touched.select(
        "label", "dims", F.col("block").alias("left"),
        F.explode(F.array(*(
            F.array(*(F.col("cell")[d] + s[d] for d in range(CELLS))) for s in steps
        ))).alias("cell"),
    )
    meet = (
        around.join(touched.withColumnRenamed("block", "right"), ["label", "dims", "cell"])
        .where("left <= right").select("label", "dims", "left", "right").distinct()
    )
    side = lambda s: blocks.select(
        "label", "dims", F.col("block").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in ("reps", "copies", "x", "p"))
    )
    joined = (
        meet.join(side("left"), ["label", "dims", "left"]).join(side("right"), ["label", "dims", "right"])
        .select("dims", "left", "right", *(f"{s}_{c}" for s in ("left", "right") for c in ("reps", "copies", "x", "p")))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                sides = []
                for s in ("left", "right"):
                    reps = np.frombuffer(r[f"{s}_reps"], "<i8")
                    v = np.frombuffer(r[f"{s}_x"], "<f8").reshape(len(reps), r["dims"])
                    v = v / np.abs(v).max(axis=1, keepdims=True)
                    sides.append({
                        "reps": reps, "copies": np.frombuffer(r[f"{s}_copies"], "<i8"), "x": v,
                        "norm": np.sqrt((v * v).sum(axis=1)),
                        "p": np.frombuffer(r[f"{s}_p"], "<f8").reshape(len(reps), -1),
                    })
                same = r["left"] == r["right"]
                a, b = sides[0], sides[0] if same else sides[1]
                n_a, n_b, label = _links(a, b, eps, cosine)
                reps = a["reps"] if same else np.concatenate([a["reps"], b["reps"]])
                n = n_a if same else np.concatenate([n_a, n_b])
                hit = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reps[hit]), pa.array(n[hit]), pa.array(reps[label[hit]])], names=["rep", "n", "to"]
                )

    found = cut(joined.mapInArrow(compare, "rep long, n long, to long"))
    component = connected_components(found.where("rep <> to").select("rep", "to"))
    degree = found.groupBy(F.col("rep").alias("d_rep")).agg(F.sum("n").alias("n"))
    each = (
        one.join(degree, F.col("rep") == F.col("d_rep"), "left").join(component, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("label").alias("l"), F.col("x").alias("v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    # only vectors with links differ from the default, so the others need no partner
    each = each.where("n_links > 0")
    key = F.when(F.col("usable"), F.transform(x, lambda v: v + F.lit(0.0)))
    out = given.withColumn("key", key).join(each, (F.col("label") == F.col("l")) & (F.col("key") == F.col("v")), "left")
    comp = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        comp.alias("component_id"), F.coalesce(comp == F.col("id"), F.lit(True)).alias("kept"),
    )
