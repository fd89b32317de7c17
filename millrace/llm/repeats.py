"""Removal of passages that repeat, by repeated-phrase automata.

A window is a number of consecutive words.  Words covered by a window whose word sequence
starts in a second place, of the same or of another text, are removed.

1. Anchors: the anchor of a window is its least hashed short n-gram, so equal windows have
   equal anchors.  Anchors are counted over the corpus; a window can only recur if its
   anchor does, which leaves out most of a corpus before any text is shuffled.
2. Slices: the windows of one recurring anchor occurrence form a slice of the text.  Slices
   are dealt by anchor, each distinct one of a stretch of texts once, with its number and
   its places.  An anchor with more than ``HOT`` occurrences is dealt by whole windows
   instead, so that no key gathers more than ``HOT`` different slices.
3. Confirm: where all slices of an anchor meet, windows are compared word by word; those
   found twice are recurring passages, of which enough are taken as phrases to cover each
   run.  Phrases of a bounded number of slices are compiled into an Aho-Corasick automaton,
   the shard, with one letter per distinct word.
4. Locate: all slices of the shard stream through its automaton, which finds every
   occurrence.  The found stretches go back to the places of each slice and are cut out of
   the whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import hashing
from millrace.llm.common import ready, stored

WINDOW = 35
#: Words of an anchor.
ANCHOR = 8
#: Occurrences from which on an anchor is dealt by whole windows.
HOT = 8_000
#: Slices of one automaton, beyond those of its last anchor.
SHARD_SLICES = 8_000
#: Bytes of text worked on at once; a longer text is taken alone.
STRETCH_BYTES = 4 << 20
#: Places of one row of slices.
ROW_PLACES = 4096

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_U = np.uint64
_FACTOR = _U(0xD1342543DE82EF95)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


def _stretches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts stay within ``STRETCH_BYTES``, or are a single row."""
    for batch in batches:
        _, at = hashing.flat(batch.column(text))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + STRETCH_BYTES, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


class _Words:
    """Words of some texts: where they lie, their hashes and each text's first word."""

    def __init__(self, texts: pa.Array):
        self.data, borders = hashing.flat(texts)
        inside = ~hashing.ASCII_SPACE[self.data]
        n = len(inside)
        first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        first[borders], last[borders] = True, True
        first[1:n] |= ~inside[:-1]
        last[1:n] |= ~inside[1:]
        self.begin = np.flatnonzero(first[:n] & inside)
        self.end = np.flatnonzero(last[1:] & inside) + 1
        self.at = np.searchsorted(self.begin, borders)
        out, i = [np.zeros(0, _U)], 0
        while i < len(self.begin):  # a megabyte at a time
            j = max(i + 1, int(np.searchsorted(self.end, self.begin[i] + (1 << 20), "right")))
            lo = self.begin[i]
            part = self.data[lo : self.end[j - 1]]
            out.append(hashing.hash_ranges(part, self.begin[i:j] - lo, self.end[i:j] - lo, hashing.EXACT[0]))
            i = j
        self.hashes = np.concatenate(out)

    def windows(self, words: int) -> np.ndarray:
        """Starts of all windows that lie within one text."""
        n = np.maximum(np.diff(self.at) - words + 1, 0)
        borders = np.cumsum(n)
        return np.arange(int(borders[-1]) if len(borders) else 0) + np.repeat(self.at[:-1] - (borders - n), n)


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on."""
    size = max(len(hashes) - n + 1, 0)
    out = np.full(size, n, _U)
    for k in range(n):
        out = out * _FACTOR + hashes[k : k + size]
    return hashing.mix(out)


def _least(grams: np.ndarray, n: int) -> np.ndarray:
    """Place of the first least one of the n entries from each place on."""
    value, place, width = grams, np.arange(len(grams)), 1
    while width < n:
        step = min(width, n - width)
        size = len(value) - step
        right = value[step:] < value[:size]
        place = np.where(right, place[step:], place[:size])
        value = np.where(right, value[step:], value[:size])
        width += step
    return place


def _anchored(w: _Words, words: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all short n-grams, starts of windows and the place of each one's anchor."""
    starts = w.windows(words)
    if not len(starts):
        return np.zeros(0, _U), starts, starts
    grams = _grams(w.hashes, anchor)
    return grams, starts, _least(grams, words - anchor + 1)[starts]


def _written(df: DataFrame, purpose: str) -> DataFrame:
    """Rows written to the shared folder and read back; the shuffle files behind them go at once.

    Each step shuffles about one copy of the texts, which Spark keeps by default until the
    driver collects the plan as garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return stored(df, purpose)
    finally:
        conf.set(_CLEANUP, before)


def _runs(flags: list[bool]) -> list[tuple[int, int]]:
    """First and last place of each run of true flags."""
    out, begin = [], None
    for i, f in enumerate([*flags, False]):
        if f and begin is None:
            begin = i
        elif not f and begin is not None:
            out.append((begin, i - 1))
            begin = None
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that overlap or touch as one, in order."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def locate(slices: list[tuple[bytes, int]], words: int = WINDOW) -> list[list[tuple[int, int]]]:
    """Stretches (first word, word after the last) of each slice that windows found twice cover.

    A slice is a text and how many times it occurs.  Windows that recur are confirmed word by
    word; from each run of them those that cover it become phrases of an automaton, through
    which all slices stream.
    """
    letters: dict[bytes, str] = {}
    texts = []
    for text, _ in slices:
        found = _WORD_BYTES.findall(text)
        for word in found:
            if word not in letters:
                letters[word] = chr(len(letters) + 1)
        texts.append("".join([letters[word] for word in found]))
    seen: Counter[str] = Counter()
    for text, (_, n) in zip(texts, slices, strict=True):
        for s in range(len(text) - words + 1):
            seen[text[s : s + words]] += n
    phrases = set()
    for text in texts:
        flags = [seen[text[s : s + words]] > 1 for s in range(len(text) - words + 1)]
        for lo, hi in _runs(flags):
            for s in [*range(lo, hi, words), hi]:
                phrases.add(text[s : s + words])
    if not phrases:
        return [[] for _ in texts]
    shard = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase in phrases:
        shard.add_word(phrase)
    shard.make_automaton()
    return [_merged([(end - n + 1, end + 1) for end, n in shard.iter(text)]) for text in texts]


def remove_repeats(
    df: DataFrame, id_: str = "doc_id", text: str = "text", words: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT,
) -> DataFrame:
    """One row per row of ``df``: ``id_``, ``n_words``, ``n_removed``, ``kept``, ``removed``.

    Words are runs without ASCII white space, unchanged.  ``kept`` holds the words that stay,
    joined by one space; ``removed`` the stretches (first word, word after the last) that go.
    Windows are judged on the texts as given, and one that overlaps itself counts twice.
    A null or empty text has no words, 0 removed and an empty ``kept``.  Rows that repeat an
    id, or id and text, are texts of their own; a null id is one like any other.  Texts with
    fewer than ``words`` words lose nothing.  Other columns are not read.  A frame without
    rows gives none.
    """
    if not 0 < anchor <= words:
        raise ValueError("an anchor has between 1 and all words of a window")
    spark = ready(df.sparkSession)
    i, t = F.col(f"`{id_}`"), F.col(f"`{text}`").cast("string")
    docs = df.select(
        i.alias("id"), t.alias("text"), F.xxhash64(i, t).alias("k1"), F.xxhash64(t, F.lit(1), i).alias("k2")
    )
    # a window has so many characters at least; shorter texts meet no one
    long_enough = docs.where(F.length("text") >= 2 * words - 1).select("k1", "k2", "text")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _stretches(batches, "text"):
            w = _Words(part.column("text"))
            grams, _, places = _anchored(w, words, anchor)
            at = np.unique(places)
            row, found = np.searchsorted(w.at, at, "right") - 1, grams[at]
            # one row per text and anchor: its first place, and a list of the others where there are any
            order = np.lexsort((at, found, row))
            at, row, found = at[order], row[order], found[order]
            head = np.ones(len(at), bool)
            head[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
            first = np.flatnonzero(head)
            k1, k2 = (part.column(k).to_numpy()[row[first]] for k in ("k1", "k2"))
            places = (at - w.at[row]).astype(np.int64)
            others = np.diff(np.append(first, len(at))) - 1
            more = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(others)]).astype(np.int32)), pa.array(places[~head]), mask=pa.array(others == 0)
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1), pa.array(k2), pa.array(found[first].view(np.int64)), pa.array(places[first]), more],
                names=["k1", "k2", "anchor", "pos", "more"],
            )

    anchored = _written(long_enough.mapInArrow(anchors, "k1 long, k2 long, anchor long, pos long, more array<long>"), "anchors")
    # written, so that adaptive execution sees a plain shuffle on both sides and splits hot anchors
    times = F.when(F.col("more").isNull(), F.lit(1)).otherwise(F.size("more") + 1)
    recurring = _written(anchored.groupBy("anchor").agg(F.sum(times).alias("n")).where("n > 1"), "recurring")
    # equal rows (id and text) have equal places, so a set of places serves them all
    places_ = F.when(F.col("more").isNull(), F.array("pos")).otherwise(F.concat(F.array("pos"), "more"))
    hits = (
        anchored.join(recurring, "anchor")
        .select("k1", "k2", F.explode(places_).alias("p"), (F.col("n") > hot).cast("long").alias("hot"))
        .groupBy("k1", "k2").agg(F.collect_set(F.col("p") * 2 + F.col("hot")).alias("hits"))
    )

    def cut_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _stretches(batches, "text"):
            w = _Words(part.column("text"))
            grams, starts, places = _anchored(w, words, anchor)
            lists = part.column("hits")
            row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            marks = lists.flatten().to_numpy()
            state = np.zeros(len(w.hashes) + 1, np.int8)
            state[w.at[row] + (marks >> 1)] = 1 + (marks & 1)
            some = state[places] > 0
            starts, places = starts[some], places[some]
            if not len(starts):
                continue
            # windows of one anchor occurrence follow one another
            single = state[places] == 2
            first = np.ones(len(starts), bool)
            first[1:] = (places[1:] != places[:-1]) | single[1:]
            begin = np.flatnonzero(first)
            lo, hi, place, single = starts[begin], starts[np.append(begin[1:], len(starts)) - 1], places[begin], single[begin]
            inner = [*range(0, words - anchor, anchor), words - anchor]
            window = lambda s: hashing.mix(np.add.reduce([grams[s + o] * _U((2 * o + 3) ** 7) for o in inner]))
            s1 = window(lo)
            s2 = hashing.mix(window(hi) + (hi - lo).astype(_U) * _FACTOR)
            key = np.where(single, s1, grams[place])
            row = np.searchsorted(w.at, lo, "right") - 1
            k1, k2 = (part.column(k).to_numpy()[row] for k in ("k1", "k2"))
            order = np.lexsort((s2, s1))
            a, b = s1[order], s2[order]
            fresh_ = np.ones(len(order), bool)
            fresh_[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            group = np.flatnonzero(fresh_)
            # long lists of places are several rows
            within = np.arange(len(order)) - np.repeat(group, np.diff(np.append(group, len(order))))
            group = np.flatnonzero(fresh_ | (within % ROW_PLACES == 0))
            head = order[group]
            texts = [
                w.data[x:y].tobytes() for x, y in zip(w.begin[lo[head]].tolist(), w.end[hi[head] + words - 1].tolist(), strict=True)
            ]
            offsets = np.append(group, len(order)).astype(np.int32)
            where = pa.StructArray.from_arrays(
                [pa.array(k1[order]), pa.array(k2[order]), pa.array((lo - w.at[row])[order].astype(np.int64))], names=["k1", "k2", "pos"]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[head].view(np.int64)), pa.array(s1[head].view(np.int64)), pa.array(s2[head].view(np.int64)),
                 pa.array(np.diff(offsets).astype(np.int64)), pa.array(texts, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), where)],
                names=["key", "s1", "s2", "n", "slice", "places"],
            )

    slices = _written(
        long_enough.join(hits, ["k1", "k2"]).mapInArrow(
            cut_slices, "key long, s1 long, s2 long, n long, slice binary, places array<struct<k1: long, k2: long, pos: long>>"
        ),
        "slices",
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        last = None

        def settle() -> pa.RecordBatch:
            found = locate([tuple(v) for v in held.values()], words)
            rows = [(*k, lo, hi) for k, spans in zip(held, found, strict=True) for lo, hi in spans]
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["s1", "s2", "lo", "hi"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "s1", "s2", "n", "slice")]
            for key, s1, s2, n, text_ in zip(*columns, strict=True):
                if key != last and len(held) >= SHARD_SLICES:
                    yield settle()
                    held = {}
                last = key
                if (s1, s2) in held:
                    held[s1, s2][1] += n
                else:
                    held[s1, s2] = [text_, n]
        if held:
            yield settle()

    spans = _written(
        slices.select("key", "s1", "s2", "n", "slice").repartition("key").sortWithinPartitions("key")
        .mapInArrow(confirm, "s1 long, s2 long, lo long, hi long"),
        "spans",
    )
    covered = (
        slices.select("s1", "s2", "places").join(spans, ["s1", "s2"])
        .select("lo", "hi", F.explode("places").alias("p"))
        .select("p.k1", "p.k2", (F.col("p.pos") + F.col("lo")).alias("lo"), (F.col("p.pos") + F.col("hi")).alias("hi"))
        .groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    )
    out = f"`{id_}` {df.select(id_).schema[0].dataType.simpleString()}, n_words long, n_removed long, kept string, removed array<struct<from: long, to: long>>"
    removed_type = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _stretches(batches, "text"):
            counts, gone, kept, removed = [], [], [], []
            for t_, spans_ in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                found = _WORD.findall(t_ or "")
                cuts = _merged([(s["lo"], s["hi"]) for s in spans_ or ()])
                counts.append(len(found))
                gone.append(sum(hi - lo for lo, hi in cuts))
                stay, at = [], 0
                for lo, hi in [*cuts, (len(found), len(found))]:
                    stay += found[at:lo]
                    at = hi
                kept.append(" ".join(stay))
                removed.append([{"from": lo, "to": hi} for lo, hi in cuts])
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(removed, removed_type)],
                names=[id_, "n_words", "n_removed", "kept", "removed"],
            )

    return docs.join(covered, ["k1", "k2"], "left").select("id", "text", "spans").mapInArrow(remove, out)
