"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word pairs and pairs with one word between,
hashed to 2^18 coordinates.  Each coordinate has its own learning rate, and the L1 part of
the proximal step keeps most weights at exactly zero, so a model is a short list of
coordinates and weights that is small enough to broadcast whatever the corpus.

Training reads a bounded sample of labelled rows, dealt to a fixed number of shards by a
hash of the id.  In each pass every shard continues from the shared state on its own rows
in hash order, and the states are averaged per coordinate, a task for a range of
coordinates.  Sample, shards and order depend
on ids only, so the model does not depend on partitions or retries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import hashing
from millrace.llm.common import add_columns, held_out, ready, stored

BITS = 18
#: Labelled rows a model is trained on at most, taken by a hash of the id.
MAX_TRAIN_ROWS = 12_000
SHARDS = 16
PASSES = 12
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1.0, 0.1
#: Coordinate of the constant.
_BIAS = 0


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all words, pairs and skip-pairs, with their row, repeats included."""
    hashes, at = hashing.words(texts, hashing.NO_LETTER)
    rows, coords = [], []
    for n, skip in ((1, 0), (2, 0), (2, 1)):
        grams, borders = hashing.ngrams(hashes, at, n, skip)
        coords.append((grams >> np.uint64(64 - BITS)).astype(np.int32))
        rows.append(np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(borders)))
    return np.concatenate(rows), np.concatenate(coords)


def distinct(rows: np.ndarray, coords: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(rows.astype(np.int64) << BITS | coords)
    return (both >> BITS).astype(np.int64), (both & ((1 << BITS) - 1)).astype(np.int64)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The proximal step in closed form: zero within the L1 bound."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train(z: np.ndarray, n: np.ndarray, examples: list[tuple[np.ndarray, int]]) -> None:
    """One pass over examples (coordinates, label), changing ``z`` and ``n``."""
    for at, y in examples:
        w = weights(z[at], n[at])
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - y
        if g:
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g


@dataclass(frozen=True)
class Model:
    """Coordinates with a weight other than zero, and their weights."""

    coords: np.ndarray
    values: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        dense = np.zeros(1 << BITS, np.float32)
        dense[self.coords] = self.values
        rows, coords = features(texts)
        some = np.flatnonzero(dense[coords])
        rows, coords = distinct(rows[some], coords[some])
        keep = coords != _BIAS
        total = np.bincount(rows[keep], weights=dense[coords[keep]].astype(float), minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(total + float(dense[_BIAS]), -35, 35)))


def _packed(shard: pa.Table) -> pa.Table:
    """All examples of a shard as one row, in hash order."""
    shard = shard.sort_by([("place", "ascending"), ("y", "ascending")])
    coords = [np.frombuffer(c, "<i4") for c in shard.column("coords").to_pylist()]
    coords = [np.append(c[c != _BIAS], _BIAS).astype("<i4") for c in coords]
    return pa.table({
        "shard": pa.array(shard.column("shard").to_pylist()[:1], pa.int64()),
        "sizes": pa.array([np.array([len(c) for c in coords], "<i4").tobytes()], pa.binary()),
        "labels": pa.array([(shard.column("y").to_numpy() > 0).astype(np.uint8).tobytes()], pa.binary()),
        "coords": pa.array([np.concatenate(coords).tobytes()], pa.binary()),
    })


def _trainer(start: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One pass of each shard from the shared state on: how far each coordinate moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before_z, before_n = start.value
        for batch in batches:
            for r in batch.to_pylist():
                ends = np.cumsum(np.frombuffer(r["sizes"], "<i4"))
                found = np.split(np.frombuffer(r["coords"], "<i4"), ends[:-1])
                z, n = before_z.copy(), before_n.copy()
                train(z, n, list(zip(found, r["labels"], strict=True)))
                moved = np.flatnonzero((z != before_z) | (n != before_n))
                # a row per range of coordinates, so that no task holds the moves of all of them
                cuts = np.searchsorted(moved, np.arange(SHARDS + 1) * (1 << BITS) // SHARDS)
                for part, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    some = moved[lo:hi]
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([r["shard"]], pa.int64()), "part": pa.array([part], pa.int32()),
                        "coord": pa.array([some.astype("<i4").tobytes()], pa.binary()),
                        "z": pa.array([(z - before_z)[some].astype("<f4").tobytes()], pa.binary()),
                        "n": pa.array([(n - before_n)[some].astype("<f4").tobytes()], pa.binary()),
                    })

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The moves of all shards in some ranges as one row: averages, added up in order of the shards."""
    rows = pa.Table.from_batches(batches, schema=_MOVED).sort_by("shard")
    if not rows.num_rows:
        return
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for i in range(rows.num_rows):
        at, dz, dn = (np.frombuffer(rows.column(c)[i].as_buffer(), k) for c, k in (("coord", "<i4"), ("z", "<f4"), ("n", "<f4")))
        z[at] += dz / SHARDS
        n[at] += dn / SHARDS
    moved = np.flatnonzero((z != 0) | (n != 0))
    yield pa.RecordBatch.from_pydict({
        "coord": pa.array([moved.astype("<i4").tobytes()], pa.binary()),
        "z": pa.array([z[moved].tobytes()], pa.binary()), "n": pa.array([n[moved].tobytes()], pa.binary()),
    })


_MOVED = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("coord", pa.binary()), ("z", pa.binary()), ("n", pa.binary())])


def fit(
    docs: DataFrame, labels: DataFrame, id_: str = "doc_id", text: str = "text", label: str = "toxic",
    max_rows: int = MAX_TRAIN_ROWS,
) -> Model:
    """Learn from labelled rows that are not held out (see ``common.held_out``).

    Rows with a null id, label or text teach nothing; of several labels of an id the
    largest counts.  At most ``max_rows`` labels are used, the first ones by a hash of the
    id, so the rows broadcast to ``docs`` are bounded.  Without labels the model is empty
    and scores 0.5.
    """
    ready(docs.sparkSession)
    known = (
        labels.select(F.col(f"`{id_}`").cast("long").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out("id"))
        .groupBy("id").agg(F.max("y").alias("y"))
        .withColumn("place", F.xxhash64("id")).orderBy("place", "id").limit(max_rows)
    )
    given = docs.select(F.col(f"`{id_}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    given = given.where("text is not null").join(F.broadcast(known), "id").select("place", "y", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, coords = distinct(*features(batch.column("text")))
            borders = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            packed = [coords[a:b].astype("<i4").tobytes() for a, b in zip(borders, borders[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("y"), pa.array(packed, pa.binary())], names=["place", "y", "coords"]
            )

    shard = F.pmod(F.col("place"), F.lit(SHARDS)).alias("shard")
    dealt = (
        given.mapInArrow(extract, "place long, y int, coords binary").select(shard, "place", "y", "coords")
        .groupBy("shard").applyInArrow(_packed, "shard long, sizes binary, labels binary, coords binary")
    )
    examples = stored(dealt.repartition(SHARDS, "shard"), "toxicity")
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(PASSES):
        start = docs.sparkSession.sparkContext.broadcast((z, n))
        # a row per shard and range of coordinates; the driver gets one number per coordinate at most
        moved = examples.mapInArrow(
            _trainer(start), "shard long, part int, coord binary, z binary, n binary"
        ).repartition(SHARDS, "part")
        # the new arrays leave those that were sent alone
        z, n = z.copy(), n.copy()
        for row in moved.mapInArrow(_averaged, "coord binary, z binary, n binary").collect():
            at = np.frombuffer(row.coord, "<i4")
            z[at] += np.frombuffer(row.z, "<f8")
            n[at] += np.frombuffer(row.n, "<f8")
        start.destroy()
    w = weights(z, n)
    used = np.flatnonzero(w)
    return Model(used.astype(np.int32), w[used].astype(np.float32))


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Append ``out``, the probability of label 1 (0 to 1), for every whole text.

    Null and empty texts have no features and get the score of the constant alone.  A
    column called ``out`` is replaced.
    """
    sent = ready(df.sparkSession).sparkContext.broadcast(model)
    return add_columns(df, [text], f"`{out}` double", lambda columns: [pa.array(sent.value.score(columns[0]))])
