"""Near-duplicate documents by a multi-index Hamming join of b-bit minhash signatures.

Every distinct shingle set gets a signature of 64 symbols of 16 bits.  Two sets of
similarity s differ in a symbol with probability 1 - s, so similar sets have a small Hamming
distance over symbols.  Signatures are split into 17 chunks: at a distance of at most 33, some
chunk holds at most one differing symbol (pigeonhole).  Each chunk is therefore indexed once
per position with that symbol left out, and every pair within the distance shares a key.
The only pairs that may be missed are similar ones beyond the distance, for which the
binomial tail at similarity 0.75 is 1.4e-6 and less above.

Pairs of a key are not listed.  First each set is compared with the smallest one of its
keys (a row per set and smallest one), similar ones are linked on their full sets, and
components are formed.  Only where members of a key are still in different components are
they compared with each other, in blocks, first by signature, then on their full sets; a
block returns one link per member at most.  So a group of copies costs work in proportion
to its size, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import shingles
from millrace.llm.common import connected_components, cut, ready, stored

SYMBOLS = 64
#: Symbols of each chunk; one of them may differ.
CHUNKS = (4,) * 13 + (3,) * 4
MAX_DISTANCE = 2 * len(CHUNKS) - 1
#: Similarity as a fraction of whole numbers.
SIMILAR = (75, 100)
#: Members compared with each other at once.
BLOCK = 512
#: Pairs of signatures compared at once within a task.
_PAIRS = 1 << 16

_PREPARED = "id long, n long, k1 long, k2 long, sig binary"


def _prepare(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """Set size, fingerprint and signature of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, at = shingles.shingle_sets(batch.column(1))
            k1, k2 = shingles.fingerprints(sets, at)
            packed = shingles.signatures(sets, at, SYMBOLS).tobytes()
            width = 2 * SYMBOLS
            sigs = [packed[i : i + width] for i in range(0, len(packed), width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(at)), pa.array(k1), pa.array(k2), pa.array(sigs, pa.binary())],
                names=["id", "n", "k1", "k2", "sig"],
            )

    given = docs.select(F.col(f"`{id_}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return given.mapInArrow(run, _PREPARED)


def _full_sets(docs: DataFrame, id_: str, text: str, wanted: DataFrame) -> DataFrame:
    """Full shingle sets (``id``, ``shingles``) of the documents in ``wanted`` (one column ``id``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, at = shingles.shingle_sets(batch.column(1))
            values = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["id", "shingles"])

    given = docs.select(F.col(f"`{id_}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return given.join(wanted, "id", "left_semi").mapInArrow(run, "id long, shingles array<long>")


def _keys(sets: DataFrame) -> DataFrame:
    """A row per set and key: each chunk with each of its symbols left out."""
    keys, base = [], 0
    for chunk, size in enumerate(CHUNKS):
        for out in range(size):
            parts = [
                F.substring("sig", 2 * base + 1, 2 * out),
                F.substring("sig", 2 * (base + out + 1) + 1, 2 * (size - out - 1)),
            ]
            number = chunk * 16 + out
            keys.append(F.xxhash64(F.lit(number), *(p for p, n in zip(parts, (out, size - out - 1), strict=True) if n)))
        base += size
    return sets.select("rep", F.posexplode(F.array(*keys)).alias("slot", "key"))


#: Chunk of each symbol, first slot of each chunk.
_CHUNK_OF = np.repeat(np.arange(len(CHUNKS)), CHUNKS)
_FIRST_SLOT = np.concatenate([[0], np.cumsum(CHUNKS)[:-1]])


def _first_slot(differ: np.ndarray) -> np.ndarray:
    """The first key each pair shares, from the symbols in which it differs (pairs x symbols).

    A pair is compared under this key only, however many it shares.  Within the distance
    there always is one.
    """
    wrong = np.add.reduceat(differ, _FIRST_SLOT, axis=1, dtype=np.int64)
    chunk = (wrong <= 1).argmax(axis=1)
    inside = differ & (_CHUNK_OF[None, :] == chunk[:, None])
    # the symbol left out is the one that differs, or the chunk's first one
    return np.where(inside.any(axis=1), inside.argmax(axis=1), _FIRST_SLOT[chunk])


def _distance(a: str, b: str):
    """Symbols in which two signatures differ."""
    return reduce(
        lambda x, y: x + y,
        [(F.substring(a, 2 * i + 1, 2) != F.substring(b, 2 * i + 1, 2)).cast("int") for i in range(SYMBOLS)],
    )


def _cells(named: DataFrame, apart: DataFrame) -> DataFrame:
    """Blocks of members that may be near each other though in different components: ``rep, comp, other, slot, cross, cell``.

    ``named`` has the members of keys (``other``: not in the component of the key's smallest set,
    the pivot), ``apart`` their distance ``d`` to it.  A pair with the pivot is known.  A key of
    several blocks is thinned out first: distances obey the triangle inequality, so of the
    pivot's component only members that reach up to the nearest other one are compared, and
    with them only other ones within that reach.
    """
    size = named.groupBy("key").agg(F.count_if("other").alias("n_other"), F.count(F.lit(1)).alias("n_all"))
    large = F.greatest("n_other", F.col("n_all") - F.col("n_other") - 1) > BLOCK
    placed = named.where("rep <> pivot").join(
        size.where("n_other > 0 and n_all > 2").select("key", large.alias("large")), "key"
    )
    reach = apart.select(F.col("a").alias("rep"), F.col("b").alias("pivot"), "d")
    placed = cut(
        placed.where("large").join(reach, ["rep", "pivot"])
        .unionByName(placed.where("not large").withColumn("d", F.lit(None).cast("int")))
    )
    bounds = placed.groupBy("key").agg(
        F.min(F.when(F.col("other"), F.col("d"))).alias("nearest"), F.max(F.when(~F.col("other"), F.col("d"))).alias("widest"),
    )
    meets = F.when(F.col("other"), F.col("d") <= F.col("widest") + MAX_DISTANCE).otherwise(F.col("d") >= F.col("nearest") - MAX_DISTANCE)
    spread = placed.join(bounds, "key").withColumn("meets", ~F.col("large") | F.coalesce(meets, F.lit(False))).where("other or meets")
    # blocks of the pivot's component, of the other members, and of those of them that meet it
    other_comp = F.when(F.col("other"), F.col("comp"))
    counts = spread.groupBy("key").agg(
        F.ceil(F.count_if(~F.col("other")) / BLOCK).alias("nd"), F.ceil(F.count_if("other") / BLOCK).alias("no"),
        F.ceil(F.count_if(F.col("other") & F.col("meets")) / BLOCK).alias("nc"),
        (F.min(other_comp) < F.max(other_comp)).alias("several"),
    )

    def numbers(n: str):
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    def dealt(n: str):
        return F.pmod(F.xxhash64("rep"), F.col(n))

    up = F.transform(numbers("nc"), lambda i: F.struct(F.lit(True).alias("cross"), i.alias("i"), dealt("nd").alias("j")))
    down = F.transform(numbers("nd"), lambda j: F.struct(F.lit(True).alias("cross"), dealt("nc").alias("i"), j.alias("j")))
    among = F.transform(
        numbers("no"),
        lambda j: F.struct(
            F.lit(False).alias("cross"), F.least(dealt("no"), j).alias("i"), F.greatest(dealt("no"), j).alias("j")
        ),
    )
    # the pivot is left out above, so its component may have no block; members without a place have no partner
    across = F.col("meets") & (F.col("nd") > 0)
    places = (
        F.when(~F.col("other"), up).when(across & F.col("several"), F.concat(down, among))
        .when(across, down).when(F.col("several"), among)
    )
    return (
        spread.join(counts, "key").withColumn("place", F.explode(places))
        .select("rep", "comp", "other", "slot", "place.cross", F.xxhash64("key", "place.cross", "place.i", "place.j").alias("cell"))
    )


def _near_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell; gives those with a partner in another component within the distance.

    A pair counts under the first key it shares, so it is found in one cell only.
    """
    held: list[pa.RecordBatch] = []

    def settle(rows: pa.Table) -> pa.RecordBatch | None:
        cell = rows.column("cell").to_numpy()
        comp = rows.column("comp").to_numpy()
        other = rows.column("other").to_numpy(zero_copy_only=False)
        cross = rows.column("cross").to_numpy(zero_copy_only=False)
        slot = rows.column("slot").to_numpy()
        data = np.frombuffer(b"".join(rows.column("sig").to_pylist()), "<u2").reshape(len(cell), SYMBOLS)
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sizes = np.diff(np.append(starts, len(cell)))
        hit = np.zeros(len(cell), bool)
        # each row meets the later rows of its cell
        later = np.repeat(starts + sizes, sizes) - np.arange(len(cell)) - 1
        ends = np.cumsum(later)
        lo = 0
        while lo < len(cell):
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _PAIRS, "right"))
            hi = max(hi, lo + 1)
            left = np.repeat(np.arange(lo, hi), later[lo:hi])
            if len(left):
                first = np.repeat(np.cumsum(later[lo:hi]) - later[lo:hi], later[lo:hi])
                right = left + 1 + np.arange(len(left)) - first
                keep = (comp[left] != comp[right]) & (~cross[left] | (other[left] != other[right]))
                left, right = left[keep], right[keep]
                differ = data[left] != data[right]
                near = np.flatnonzero(differ.sum(axis=1) <= MAX_DISTANCE)
                near = near[_first_slot(differ[near]) == slot[left[near]]]
                hit[left[near]] = True
                hit[right[near]] = True
            lo = hi
        if not hit.any():
            return None
        return rows.select(["cell", "rep", "comp"]).filter(pa.array(hit)).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column("cell").to_numpy()
        last = len(cells) - int(np.argmax((cells != cells[-1])[::-1])) if cells[0] != cells[-1] else 0
        if held and held[0].column("cell")[0].as_py() != cells[-1]:
            out = settle(pa.Table.from_batches([*held, batch.slice(0, last)]))
            held = [batch.slice(last)]
        elif not held and last:
            out = settle(pa.Table.from_batches([batch.slice(0, last)]))
            held = [batch.slice(last)]
        else:
            out = None
            held.append(batch)
        if out is not None:
            yield out
    if held:
        out = settle(pa.Table.from_batches(held))
        if out is not None:
            yield out


def _links_in_block(rows: pa.Table) -> pa.Table:
    """Links between members of one cell in different components, compared on their full sets."""
    rows = rows.combine_chunks()
    reps, comp = rows.column("rep").to_numpy(), rows.column("comp").to_numpy()
    lists = rows.column("shingles").chunk(0) if rows.column("shingles").num_chunks else None
    n = len(reps)
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if lists is None or n < 2:
        return none
    at = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy()[at[0] : at[-1]]
    sizes = np.diff(at)
    _, place, times = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = times[place] > 1
    place, owner = place[shared], owner[shared]
    columns, place = np.unique(place, return_inverse=True)
    common = np.zeros((n, n), np.int64)
    for lo in range(0, len(columns), 8192):  # a stretch of shingles at a time bounds the matrix
        here = (place >= lo) & (place < lo + 8192)
        held = np.zeros((n, min(8192, len(columns) - lo)), np.float32)
        held[owner[here], place[here] - lo] = 1
        common += np.rint(held @ held.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    near = (SIMILAR[1] * common >= SIMILAR[0] * union) & (comp[:, None] != comp[None, :])
    # the smallest member each one reaches within the block: a link per member keeps them together
    label = np.arange(n)
    while True:
        reached = np.minimum(label, np.where(near, label[None, :], n).min(axis=1))
        if (reached == label).all():
            break
        label = reached
    moved = np.flatnonzero(label != np.arange(n))
    return pa.table({"a": pa.array(reps[moved]), "b": pa.array(reps[label[moved]])})


def near_duplicates(
    docs: DataFrame, id_: str = "doc_id", text: str = "text",
    n_shingles: str = "n_shingles", component: str = "component_id", kept: str = "kept",
) -> DataFrame:
    """One row per document: ``id_``, set size, smallest id reachable by links, and ``kept``.

    Words are runs without ASCII white space, A-Z lower-cased; a set holds the distinct
    shingles of five words as 64-bit hashes, a shorter text its whole sequence.  Documents
    whose sets have a Jaccard similarity of 0.75 or more are linked.  Null and empty texts
    are linked with nothing.  A row without id is linked with nothing and has a null
    component, and is kept.  Rows with the same id count as one document.  Further columns
    of ``docs`` are not read.
    """
    ready(docs.sparkSession)
    prepared = stored(_prepare(docs, id_, text), "minhash")
    full = prepared.where("n > 0 and id is not null")
    sets = cut(full.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep"), F.max("sig").alias("sig")))

    keys = _keys(sets)
    least = keys.groupBy("key").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("c")).where("c > 1")
    least = cut(least)
    members = cut(keys.join(least, "key"))
    one = sets.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
    apart = cut(
        members.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
        .join(one, "a").join(two, "b").select("a", "b", _distance("sig_a", "sig_b").alias("d"))
    )
    pairs = apart.where(F.col("d") <= MAX_DISTANCE).select("a", "b")
    involved = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    values = cut(_full_sets(docs, id_, text, involved))
    inter = F.size(F.array_intersect("set_a", "set_b"))
    links = cut(
        pairs.join(values.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(values.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
        .where(SIMILAR[1] * inter >= SIMILAR[0] * (F.size("set_a") + F.size("set_b") - inter))
        .select("a", "b")
    )
    found = connected_components(links)

    # members of a key in several components: compared in blocks
    label = sets.join(found, sets.rep == found.node, "left").select(
        "rep", "sig", F.coalesce("component", "rep").alias("comp")
    )
    named = members.where("c > 2").join(label.select("rep", "comp"), "rep")
    home = found.select(F.col("node").alias("pivot"), F.col("component").alias("top"))
    named = cut(named.join(home, "pivot", "left").withColumn("other", F.coalesce("top", "pivot") != F.col("comp")))
    cells = _cells(named, apart)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = cut(
        cells.join(sets.select("rep", "sig"), "rep")
        .select("cell", "rep", "comp", "other", "slot", "cross", "sig")
        .repartition(partitions, "cell").sortWithinPartitions("cell")
        .mapInArrow(_near_in_blocks, "cell long, rep long, comp long")
    )
    values = _full_sets(docs, id_, text, near.select(F.col("rep").alias("id")).distinct())
    values = cut(values.groupBy("id").agg(F.max("shingles").alias("shingles")))
    more = cut(
        near.join(values, near.rep == values.id).select("cell", "rep", "comp", "shingles")
        .groupBy("cell").applyInArrow(_links_in_block, "a long, b long")
    )
    found = connected_components(
        more.select("a", "b").unionAll(found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")))
    )

    # back to all documents, by way of the set each one has
    copies = (
        sets.select("k1", "k2", "n", "rep").join(found, F.col("rep") == F.col("node"), "left")
        .select("k1", "k2", "n", F.coalesce("component", "rep").alias("component"))
    )
    out = prepared.select("id", "n", "k1", "k2").join(copies, ["k1", "k2", "n"], "left")
    comp = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_), F.col("n").alias(n_shingles), comp.alias(component),
        F.coalesce(comp == F.col("id"), F.lit(True)).alias(kept),
    )
