"""Packing of token ids into sequences: first-fit decreasing in randomised groups.

Each document becomes token ids with an end id; ids are cut at multiples of the sequence
length, so only the last piece of a document is shorter.  Documents go with all their pieces to
random groups of bounded expected size, and each group is packed by itself: longest piece
first, each into the first sequence with room, found by walking down a tournament tree of free capacities
(each inner node holds the larger of its two children).
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import add_columns, fresh

SEQUENCE_TOKENS = 2048
END_ID = 1
#: Expected documents of one group.
GROUP_DOCS = 4096
#: Words whose ids one Python worker remembers.
MAX_WORDS = 300_000

# Text of these characters needs no Unicode normalisation, and its lower case, white space,
# letters and numbers are the same for Python and for the tokenizer.
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_OTHER = re.compile("[^\t\n\x0b\x0c\r -~\xa1-\xac\xae-\xff]")
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
#: The split pattern for which ``_PIECE`` stands.
_KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordEncoder:
    """Ids of whole texts by the tokenizer file; ids of repeated words are remembered.

    Splitting never reaches across white space and merges never across a split, so a text's
    ids are those of its white-space separated words.  Words beyond Latin-1 go to the library,
    and with tokenizer files of another normaliser or split pattern whole texts do.
    """

    def __init__(self, path: str, end_id: int | None, max_words: int = MAX_WORDS):
        import json

        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        self.max_words = max_words
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        normal = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = (
            normal == ["NFC", "Replace", "Lowercase"]
            and split[0].get("pattern", {}).get("Regex") == _KNOWN_SPLIT
            and spec["model"]["type"] == "BPE"
        )
        shown = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: shown.pre_tokenize_str(chr(c))[0][0] for c in [*range(33, 127), *range(0xA1, 0x100)]}

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.translate(self.shown)
        ids = b"".join([self.packed[t.id] for t in self.tokenizer.model.tokenize(shown)])
        if len(piece) < 64:
            if len(self.pieces) > self.max_words:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        pieces = _PIECE.findall(word.lower())
        if len(pieces) == 1:
            return self.pieces.get(pieces[0]) or self._piece(pieces[0])
        found = list(map(self.pieces.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._piece(pieces[i])
        return b"".join(found)

    def _learn(self, word: str) -> bytes:
        """Ids of a word not remembered; words of other characters go to the library by themselves."""
        if _OTHER.search(word):
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            ids = self._word(word)
        if len(word) < 64:
            if len(self.words) > self.max_words:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        # separators of ASCII are white space for Python only
        if not self.by_word or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + self.end
        words = text.split()
        found = list(map(self.words.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._learn(words[i])
        found.append(self.end)
        return b"".join(found)


_ENCODERS: dict[tuple, WordEncoder] = {}


def encode_words(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", end_id: int | None = END_ID
) -> DataFrame:
    """Append ``ids``: ids of the whole text and ``end_id``, packed as little-endian 32-bit.

    A null text counts as empty and has the end id only.  A column called ``ids`` is
    replaced.  No shuffle; memory is one batch of rows and the bounded table of words.
    """

    def work(columns: list[pa.Array]) -> list[pa.Array]:
        key = (path, end_id)
        if key not in _ENCODERS:
            _ENCODERS[key] = WordEncoder(path, end_id)
        encode = _ENCODERS[key].encode
        return [pa.array([encode(t.as_py() or "") for t in columns[0]], pa.binary())]

    return add_columns(df, [text], f"`{ids}` binary", work)


def cut_pieces(df: DataFrame, ids: str = "ids", tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece of at most ``tokens`` ids; a document without ids has none.

    Appends ``start``, ``length`` and ``piece`` (packed ids) and ``doc_tokens``; the column
    ``ids`` goes.  Columns of ``df`` with these names are replaced.
    """
    new = {"start", "length", "piece", "doc_tokens", ids.lower()}
    kept = [c for c in df.columns if c.lower() not in new]
    mark, one = fresh(df.columns), fresh(df.columns, ["piece"])
    n = F.length(F.col(f"`{ids}`")).cast("long") / 4
    given = df.select(*(df[f"`{c}`"] for c in kept), F.col(f"`{ids}`").alias(mark), n.cast("long").alias("doc_tokens"))

    def piece(k):
        start = k * F.lit(tokens)
        length = F.least(F.lit(tokens).cast("long"), F.col("doc_tokens") - start)
        return F.struct(
            start.alias("start"), length.alias("length"),
            F.substring(F.col(mark), (start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("piece"),
        )

    starts = F.sequence(F.lit(0).cast("long"), ((F.col("doc_tokens") - 1) / tokens).cast("long"))
    return (
        given.where("doc_tokens > 0")
        .select(*kept, "doc_tokens", F.explode(F.transform(starts, piece)).alias(one))
        .select(*kept, f"{one}.start", f"{one}.length", f"{one}.piece", "doc_tokens")
    )


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ``lengths`` must come longest first and fit a bin."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    free = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, length in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if free[node] < length:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - free[node]
        free[node] -= length
        while node > 1:
            node //= 2
            left, right = free[2 * node], free[2 * node + 1]
            most = left if left >= right else right
            if free[node] == most:
                break
            free[node] = most
    return bins, offsets


def pack(
    pieces: DataFrame,
    keys: list[str],
    documents: int,
    length: str = "length",
    tokens: int = SEQUENCE_TOKENS,
    group_docs: int = GROUP_DOCS,
    document: list[str] | None = None,
) -> DataFrame:
    """Append ``sequence_id`` and ``offset`` to pieces of at most ``tokens`` ids.

    The hash of the columns ``document`` (the first key, unless given) deals documents with all
    their pieces to groups, about ``documents / group_docs`` of them; the hash of ``keys``
    breaks ties of length, so the result does not depend on partitions or retries.  Offsets in
    a sequence are gapless from 0.  Null keys are one value like any other.  Repeated rows are
    pieces of their own; they travel as one row with their number, ``group_docs`` of them at
    most, and each such lot goes to the next group, so that no group gathers the copies of a
    row.  Pieces of a null or non-positive length are no pieces and are left out; a longer one
    than ``tokens`` makes its task fail.  All columns must be such that Spark can group by them.
    """
    groups = max(1, math.ceil(documents / group_docs))
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    mark, tie, lot, copies = (fresh(pieces.columns) for _ in range(4))
    of = lambda columns: F.xxhash64(*(F.col(f"`{k}`") for k in columns))
    counted = (
        pieces.where(F.col(f"`{length}`") > 0).groupBy(*(pieces[f"`{c}`"] for c in kept))
        .agg(F.count(F.lit(1)).alias(copies))
    )
    lots = F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / group_docs))
    given = (
        counted.withColumn(lot, F.explode(lots))
        .withColumn(copies, F.least(F.lit(group_docs).cast("long"), F.col(copies) - F.col(lot) * group_docs))
        .withColumn(mark, F.pmod(of(document or keys[:1]) + F.col(lot), F.lit(groups)))
        .withColumn(tie, of(keys)).drop(lot)
    )
    schema = given.select(*(F.col(f"`{c}`") for c in kept)).schema.add("sequence_id", "long").add("offset", "long")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sort = [(length, "descending"), (tie, "ascending"), *((k, "ascending") for k in keys)]
        order = pc.sort_indices(group, sort_keys=sort).to_numpy()
        group = group.take(pa.array(np.repeat(order, group.column(copies).to_numpy()[order])))
        sizes = group.column(length).to_numpy().astype(np.int64)
        if len(sizes) and sizes[0] > tokens:
            raise ValueError(f"a piece of {sizes[0]} ids does not fit {tokens}")
        bins, offsets = first_fit_decreasing(sizes, tokens)
        number = bins * groups + group.column(mark)[0].as_py()
        out = group.select(kept)
        return out.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offsets))

    return given.groupBy(mark).applyInArrow(run, schema)
