"""Alignment of two tokenizers over the same texts, by diagonal run skipping.

The tokens of both tokenizers end at byte offsets of one text.  Offsets where both have an
end cut the tokens into groups.  Where one token follows another one-to-one, the arrays of
ends agree at a constant shift between their indices (a diagonal): probing compares ends at
the current shift, a few one by one, then stretches of 16, 32, 64, ... of them, and jumps over
those that agree.  Where they do not, the irregular group is resolved locally by stepping the shorter side, and the
shift becomes that behind the group.

Token pairs whose bytes overlap are linked.  Counts of linked pairs cover the corpus: blocks
of texts give their distinct pairs once each, Spark adds them up, and the counts come back to
each block, so a pair that all texts hold is an entry per block, never one per text.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import hashing
from millrace.llm.common import ready, stored

#: Bytes of links and groups that one block holds; a text with more is a block of its own.
BLOCK_BYTES = 8 << 20
#: Bytes of texts that are tokenized at once; a longer text is taken alone.
STRETCH_BYTES = 1 << 20

#: Ends compared one by one before stretches of them; most runs are shorter.
ONE_BY_ONE = 16

#: The split of texts that byte-level tokenizer files with ``use_regex`` stand for.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter that shows each byte in byte-level vocabularies: printable ones are themselves."""
    shown = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in shown):
        out[chr(256 + n)] = b
    return out


class ByteLevel:
    """Ids of ``space + text`` by a byte-level BPE file, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], _byte_letters()
        self.table = [b""] * (max(vocab.values()) + 1)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        for entry, i in vocab.items():
            self.table[i] = entry.encode() if entry in special else bytes(letters[c] for c in entry)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        results = [vocab[a + b] for a, b in merges]
        split = spec.get("pre_tokenizer") or {}
        plain = (
            not spec.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex")
            and not split.get("add_prefix_space") and not spec["model"].get("ignore_merges")
        )
        if plain and results == sorted(set(results)):
            # merges in the order of their ids: the same ids by ranks, worked out faster
            import tiktoken

            ranks = {self.table[i]: i for entry, i in vocab.items() if entry not in special}
            own = tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
            self._ids = own.encode_ordinary
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True  # their strings in a text are ordinary text
            self._ids = lambda text: whole.encode(text, add_special_tokens=False).ids

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self._ids(" " + t) for t in texts]


class Pieces:
    """Ids of texts by a sentence-piece model, which puts a space before them, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table = []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece) if self._model.is_byte(i) else None
            self.table.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def diagonal_groups(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[int, int, int, int, list | None]]:
    """Groups of tokens between common ends, in order: ``a0, a1, b0, b1, links``.

    Without links, the tokens a0 to a1 and b0 to b1 correspond one to one and are a group each;
    otherwise the tokens of both ranges are one group, and ``links`` are the pairs of them that
    overlap.  Ends ascend, and the last ones agree.
    """
    na, nb = len(ends_a), len(ends_b)
    ends_a, ends_b = [*ends_a, -1], [*ends_b, -2]  # they differ behind the last ones
    packed = None
    i = j = 0
    while i < na:
        n = 0
        while n < ONE_BY_ONE and ends_a[i + n] == ends_b[j + n]:
            n += 1
        if n == ONE_BY_ONE:
            a, b = packed = packed or (array("q", ends_a).tobytes(), array("q", ends_b).tobytes())
            step, most = n, min(na - i, nb - j)
            while n < most:  # probe ahead at the shift j - i
                m = min(step, most - n)
                x, y = 8 * (i + n), 8 * (j + n)
                if a[x : x + 8 * m] == b[y : y + 8 * m]:
                    n, step = n + m, 2 * step
                    continue
                lo, hi = 0, m  # the first difference lies within hi
                while hi - lo > 1:
                    mid = (lo + hi) // 2
                    if a[x + 8 * lo : x + 8 * mid] == b[y + 8 * lo : y + 8 * mid]:
                        lo = mid
                    else:
                        hi = mid
                n += lo
                break
        if n:
            yield i, i + n, j, j + n, None
            i, j = i + n, j + n
            if i == na:
                return
        # the ends differ here: step the side that ends first until they agree again
        p, q = i, j
        x, y = ends_a[p], ends_b[q]
        links = [(p, q)]
        while x != y:
            if x < y:
                p += 1
                x = ends_a[p]
            else:
                q += 1
                y = ends_b[q]
            links.append((p, q))
        yield i, p + 1, j, q + 1, links
        i, j = p + 1, q + 1


class Aligner:
    """Both tokenizers, loaded once a worker."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.len_a, self.len_b = (np.array([len(t) for t in c.table]) for c in (self.a, self.b))
        # ids as text with the sign behind them: where they end their side of a group, and within it
        self.shown_a, self.shown_b = (
            np.array([f"{i}{sign}" for sign in signs for i in range(len(n))], object)
            for n, signs in ((self.len_a, "|,"), (self.len_b, ";,"))
        )

    def ends(self, whole: bytes, ids_a: list[int], ids_b: list[int]) -> tuple[list[int], list[int]] | None:
        """Byte offsets at which the tokens of both end; None where either's bytes are not those of ``whole``."""
        out = []
        for ids, table, lengths in ((ids_a, self.a.table, self.len_a), (ids_b, self.b.table, self.len_b)):
            if b"".join(map(table.__getitem__, ids)) != whole:
                return None
            sizes = lengths[np.array(array("q", ids))]
            if not sizes.all():  # a token without bytes
                return None
            out.append(np.cumsum(sizes).tolist())
        return out[0], out[1]

    def align(
        self, ids_a: list[int], ids_b: list[int], ends_a: list[int], ends_b: list[int],
    ) -> tuple[int, str, np.ndarray]:
        """Number of groups, their text, and the A and B ids of all links (32 bits, a row each)."""
        stretches: list[int] = []
        overlaps: list[tuple[int, int]] = []
        for a0, a1, b0, b1, links in diagonal_groups(ends_a, ends_b):
            stretches += (a0, a1, b0, b1, links is None)
            if links is not None:
                overlaps += links
        a0, a1, b0, b1, single = np.array(array("q", stretches)).reshape(-1, 5).T
        single = single.astype(bool)
        size_a, size_b = a1 - a0, b1 - b0
        a, b = np.array(array("q", ids_a)), np.array(array("q", ids_b))
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        single_a, single_b = np.repeat(single, size_a), np.repeat(single, size_b)
        # the tokens of a group stand side by side, those of A first
        shown = np.empty(len(a) + len(b), object)
        inner = ~single_a & (at_a < np.repeat(a1 - 1, size_a))
        place = at_a + np.repeat(b0, size_a) + np.where(single_a, at_a - np.repeat(a0, size_a), 0)
        shown[place] = self.shown_a[a + inner * len(self.len_a)]
        inner = ~single_b & (at_b < np.repeat(b1 - 1, size_b))
        place = at_b + np.repeat(np.where(single, a0 + 1, a1), size_b) + np.where(single_b, at_b - np.repeat(b0, size_b), 0)
        shown[place] = self.shown_b[b + inner * len(self.len_b)]
        pairs = np.array(array("q", chain.from_iterable(overlaps))).reshape(-1, 2)
        linked = np.empty((np.count_nonzero(single_a) + len(pairs), 2), "<u4")
        linked[:, 0] = np.concatenate([a[single_a], a[pairs[:, 0]]])
        linked[:, 1] = np.concatenate([b[single_b], b[pairs[:, 1]]])
        return int(np.where(single, size_a, 1).sum()), "".join(shown.tolist())[:-1], linked

    def rows(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, str, bytes]]:
        """``n_a, n_b, n_groups, n_links, groups, links`` of each text; links are pairs of 32-bit ids."""
        given = [t or "" for t in texts]
        for text, ids_a, ids_b in zip(given, self.a.ids(given), self.b.ids(given), strict=True):
            ends = self.ends((" " + text).encode(), ids_a, ids_b) if text else None
            if ends is None:
                yield 0, 0, 0, 0, "", b""
                continue
            n, groups, links = self.align(ids_a, ids_b, *ends)
            yield len(ids_a), len(ids_b), n, len(links), groups, links.tobytes()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _packed(block: int, rows: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    """A block of aligned rows: its distinct pairs, in how many rows each is, and the rows themselves.

    The last entry of a row are its links; they become places among the pairs of the block.
    """
    columns = list(zip(*rows, strict=True))
    sizes = np.array([len(b) // 8 for b in columns[-1]])
    pairs = np.frombuffer(b"".join(columns[-1]), "<u4").reshape(-1, 2)
    keys, place = np.unique(pairs[:, 0].astype(np.int64) << 32 | pairs[:, 1], return_inverse=True)
    del pairs
    place = place.astype("<u4")
    links = np.split(place, np.cumsum(sizes)[:-1])
    docs = np.zeros(len(keys), np.int64)
    for one in links:
        docs[np.unique(one)] += 1
    kinds = [kind, *[pa.int64()] * 4, pa.string()]
    arrays = [pa.array(c, k) for c, k in zip(columns[:-1], kinds, strict=True)]
    local = pa.RecordBatch.from_arrays([*arrays, pa.array([p.tobytes() for p in links], pa.binary())], names=[*names, "links"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, local.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(local)
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([keys], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64())),
         pa.array([sink.getvalue().to_pybytes()], pa.binary())],
        names=["block", "keys", "docs", "rows"],
    )


def align(
    df: DataFrame, path_a: str, path_b: str, id_: str = "doc_id", text: str = "text", digest: bool = False,
) -> DataFrame:
    """One row per row: ``id_``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``n_best``, ``count_sum``.

    ``groups`` is text, ``a1,a2|b1;a3|b2,b3`` with decimal ids in order; with ``digest`` the
    hexadecimal SHA-256 of it.  The count of an id pair is the number of rows in which it is
    linked; ``count_sum`` adds up the counts of a row's links, ``n_best`` is the number of links
    whose count is the highest of all pairs with their A id, ties included.

    A text that is null, empty, or not given back byte by byte by the tokens of both tokenizers
    has no tokens: zeros and an empty ``groups``, never a digest.  Null and repeated ids are
    rows like any other; other columns are not read.  A frame without rows gives none.
    """
    spark = ready(df.sparkSession)
    given = df.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path_a, path_b)
        if key not in _ALIGNERS:
            _ALIGNERS[key] = Aligner(*key)
        aligner, task, number = _ALIGNERS[key], TaskContext.get().partitionId(), 0
        held, size, kind = [], 0, None
        for batch in batches:
            kind = batch.column(0).type
            ids, (_, at), lo = batch.column(0).to_pylist(), hashing.flat(batch.column(1)), 0
            while lo < batch.num_rows:
                # a stretch of texts at a time
                hi = max(lo + 1, int(np.searchsorted(at, at[lo] + STRETCH_BYTES, "right")) - 1)
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                for doc, row in zip(ids[lo:hi], aligner.rows(texts), strict=True):
                    *counts, groups, links = row
                    if digest and groups:
                        groups = hashlib.sha256(groups.encode()).hexdigest()
                    more = len(links) + len(groups)
                    if held and size + more > BLOCK_BYTES:
                        yield _packed(task << 32 | number, held, names, kind)
                        held, size, number = [], 0, number + 1
                    held.append((doc, *counts, groups, links))
                    size += more
                lo = hi
        if held:
            yield _packed(task << 32 | number, held, names, kind)

    blocks = stored(given.mapInArrow(pack, "block long, keys array<long>, docs array<long>, rows binary"), "links")
    each = blocks.select("block", F.explode(F.arrays_zip("keys", "docs")).alias("e")).select(
        "block", F.col("e.keys").alias("key"), F.col("e.docs").alias("docs")
    )
    counts = each.groupBy("key").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("key", 32))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = counts.join(most, "a").select("key", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = each.select("block", "key").join(counts, "key").select(F.col("block").alias("to"), "key", "n", "best")
    id_type = given.schema["id"].dataType.simpleString()
    schema = f"`{id_}` {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"

    def add_up(block: pa.Table, found: pa.Table) -> pa.Table:
        parts = []
        order = np.argsort(found.column("key").to_numpy())
        n = found.column("n").to_numpy()[order]
        best = found.column("best").to_numpy()[order]
        for packed in block.column("rows").to_pylist():
            rows = pa.ipc.open_stream(packed).read_all()
            links = [np.frombuffer(b, "<u4") for b in rows.column("links").to_pylist()]
            parts.append(
                rows.select(names).rename_columns([id_, *names[1:]])
                .append_column("n_best", pa.array([int(best[x].sum()) for x in links], pa.int64()))
                .append_column("count_sum", pa.array([int(n[x].sum()) for x in links], pa.int64()))
            )
        return pa.concat_tables(parts)

    return (
        blocks.select("block", "rows").groupBy("block").cogroup(answers.groupBy("to")).applyInArrow(add_up, schema)
    )
