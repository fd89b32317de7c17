"""Byte-level BPE: merges compiled into a lazily determinised transducer, and streaming decode.

The rank table is read as a set of merges.  A sequence of tokens is what the merges make of
its bytes exactly if every two neighbours are what the merges make of theirs, so the
encoding is the one path of a transducer whose arcs are tokens and whose adjacent arcs fit.
Several arcs may be open at once (``ab`` read, ``abc`` possible), so the transducer is
determinised while it runs: a state is the set of open arcs with the tokens not yet
decided, and a token is emitted as soon as all open arcs agree on it, which is at most the
length of the longest token later.  States and moves are built when first needed, kept for
later texts, and dropped when there are too many of them (they are then built again).

Decoding is a machine over UTF-8 states whose moves are whole tokens: a token that is
complete UTF-8 keeps the machine at rest, any other one is fed byte by byte.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millrace.llm import hashing
from millrace.llm.common import add_columns

#: Bounds of what one Python worker keeps: transducer states, fitting pairs, words, chunks.
MAX_STATES, MAX_PAIRS, MAX_WORDS, MAX_CHUNKS = 180_000, 250_000, 150_000, 1_500_000
#: Bytes of text worked on at once.
_STRETCH = 1 << 22

#: Marks of one character that no other character joins in the split pattern.
_MARKS = frozenset(".,;:!?|")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Transducer:
    """Encodes one match of the split pattern at a time."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES, max_pairs: int = MAX_PAIRS):
        self.ranks = ranks
        self.max_states, self.max_pairs = max_states, max_pairs
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.bytes_ = [ranks[bytes([b])] for b in range(256)]
        #: trie as nodes of {byte: node}; ends[node] is the token that ends there
        self.next: list[dict[int, int]] = [{}]
        self.ends: list[int | None] = [None]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                child = self.next[node].get(b)
                if child is None:
                    child = len(self.next)
                    self.next[node][b] = child
                    self.next.append({})
                    self.ends.append(None)
                node = child
            self.ends[node] = rank
        self.split_: dict[int, tuple[int, int] | None] = {}
        self.pair_: dict[tuple[int, int], int | None] = {}
        self.fits_: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        # a state is a tuple of open arcs (undecided tokens, last token, trie node)
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.start = self._state((((), -1, 0),))

    def _state(self, arcs: tuple) -> int:
        found = self.ids.get(arcs)
        if found is None:
            found = self.ids[arcs] = len(self.states)
            self.states.append(arcs)
            self.moves.append({})
        return found

    def _joined(self, a: int, b: int) -> int | None:
        """Rank of the token that the bytes of two tokens make."""
        try:
            return self.pair_[a, b]
        except KeyError:
            if len(self.pair_) > self.max_pairs:
                self.pair_.clear()
            out = self.pair_[a, b] = self.ranks.get(self.tokens[a] + self.tokens[b])
            return out

    def _split(self, token: int) -> tuple[int, int] | None:
        """The merge that makes a token of more than one byte; None if no merges lead to it."""
        if token in self.split_:
            return self.split_[token]
        parts = [self.bytes_[b] for b in self.tokens[token]]
        while len(parts) > 2:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self._joined(parts[i], parts[i + 1])
                if rank is not None and rank < token and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [best]
        out = (parts[0], parts[1]) if len(parts) == 2 else None
        self.split_[token] = out
        return out

    def _made(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self._split(token) is not None

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves exactly these two tokens.

        The merges are undone from the last one back: at each moment the two tokens at the
        border must not have had an earlier merge with each other than the one being undone.
        """
        key = (left, right)
        known = self.fits_.get(key)
        if known is not None:
            return known
        limit, strict, ok = None, False, True
        a, b = left, right
        while True:
            rank = self._joined(a, b)
            if rank is not None and (limit is None or rank < limit or (strict and rank == limit)):
                ok = False
                break
            long_a, long_b = len(self.tokens[a]) > 1, len(self.tokens[b]) > 1
            if not long_a and not long_b:
                break
            # of equal merges the left one comes first, so the right one is undone first
            if long_b and (not long_a or b >= a):
                limit, strict, b = b, True, self._split(b)[0]
            else:
                limit, strict, a = a, False, self._split(a)[1]
        if len(self.fits_) > self.max_pairs:
            self.fits_.clear()
        self.fits_[key] = ok
        return ok

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        arcs, tokens = [], []
        next_, ends, fits = self.next, self.ends, self.fits_
        for pending, last, node in self.states[state]:
            child = next_[node].get(byte)
            if child is None:
                continue
            if next_[child]:
                arcs.append((pending, last, child))
                tokens.append(pending)
            token = ends[child]
            if token is None:
                continue
            if last < 0:
                ok = self._made(token)
            else:
                ok = fits.get((last, token))
                if ok is None:
                    ok = self._made(token) and self._fits(last, token)
            if ok:
                pending = (*pending, token)
                arcs.append((pending, token, 0))
                tokens.append(pending)
        # what the least and the greatest of them share at the beginning, all share
        agreed = 0
        if len(arcs) == 1:
            agreed = len(tokens[0])
        elif () not in tokens:
            for x, y in zip(min(tokens), max(tokens), strict=False):
                if x != y:
                    break
                agreed += 1
        out: tuple[int, ...] = ()
        if agreed:
            out = tokens[0][:agreed]
            arcs = [(p[agreed:], last, node) for p, last, node in arcs]
        target = self._state(tuple(arcs))
        self.moves[state][byte] = move = (target, out)
        return move

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one match; a match that is a token itself is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states:
            self._reset()
        out: list[int] = []
        state, moves = self.start, self.moves
        for n, byte in enumerate(piece):
            step = moves[state].get(byte)
            if step is None:
                step = self._move(state, byte)
                if n % 4096 == 4095 and len(self.states) > self.max_states:
                    arcs = self.states[step[0]]
                    self._reset()
                    moves = self.moves
                    step = (self._state(arcs), step[1])
            state = step[0]
            if step[1]:
                out.extend(step[1])
        # at the end of the match, the arc that is at a token's end is the one path
        for pending, _, node in self.states[state]:
            if node == 0:
                out.extend(pending)
                return out
        raise AssertionError("every byte is a token, so some arc always ends here")


class Encoder:
    """Whole texts to packed ids (little-endian unsigned 32-bit), a batch at a time.

    Texts are cut at single spaces, each chunk with the space before it; no match reaches
    across such a cut (texts where one might are split by the pattern as a whole).  Each
    distinct chunk of a batch goes through the transducer once; its ids are kept for later
    batches under two independent 64-bit hashes of its bytes.
    """

    def __init__(self, path: str, pattern: str, max_chunks: int = MAX_CHUNKS):
        self.transducer = Transducer(read_ranks(path))
        self.pattern = regex.compile(pattern)
        self.max_chunks = max_chunks
        self.words: dict[str, bytes] = {}
        # with this pattern a run of letters is one match, and so is a mark after it
        self.letters = r" ?\p{L}+" in pattern and r" ?[^\s\p{L}\p{N}]+" in pattern
        self._forget()

    def _forget(self) -> None:
        # chunks by their first hash: second hash, where their ids begin and how many
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, "<u4")

    def _match(self, match: str) -> bytes:
        ids = self.words.get(match)
        if ids is None:
            ids = array("I", self.transducer.encode(match.encode())).tobytes()
            if len(match) < 64:
                if len(self.words) > MAX_WORDS:
                    self.words.clear()
                self.words[match] = ids
        return ids

    def plain(self, text: str) -> bytes:
        return b"".join(map(self._match, self.pattern.findall(text)))

    def _chunk(self, chunk: str) -> bytes:
        if self.letters:
            bare = chunk[1:] if chunk[:1] == " " else chunk
            if bare.isalpha():
                return self._match(chunk)
            if bare[-1:] in _MARKS and bare[:-1].isalpha():
                return self._match(chunk[:-1]) + self._match(chunk[-1])
        return self.plain(chunk)

    def _chunks(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, end to end, and how many each one has."""
        if len(self.keys) > self.max_chunks:
            self._forget()
        first, second = (hashing.hash_ranges(data, starts, ends, v) for v in hashing.EXACT)
        keys, at, place = np.unique(first, return_index=True, return_inverse=True)
        checks = second[at]
        if not (checks[place] == second).all():  # two chunks with one hash: go by the bytes
            found = [self._chunk(data[s:e].tobytes().decode()) for s, e in zip(starts, ends, strict=True)]
            return np.frombuffer(b"".join(found), "<u4"), np.array([len(f) // 4 for f in found], np.int64)
        where = np.searchsorted(self.keys, keys)
        begins, sizes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if len(self.keys):
            near = np.minimum(where, len(self.keys) - 1)
            known = (self.keys[near] == keys) & (self.checks[near] == checks)
            begins[known], sizes[known] = self.begins[near[known]], self.sizes[near[known]]
        else:
            known = np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        made = [
            self._chunk(data[s:e].tobytes().decode())
            for s, e in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)
        ]
        sizes[new] = [len(m) // 4 for m in made]
        begins[new] = len(self.pool) + np.cumsum(sizes[new]) - sizes[new]
        pool = np.concatenate([self.pool, np.frombuffer(b"".join(made), "<u4")])
        # long chunks hardly come again
        keep = new[(ends[at[new]] - starts[at[new]]) < 64]
        if len(keep):
            self.keys, self.checks = (np.insert(a, where[keep], b[keep]) for a, b in ((self.keys, keys), (self.checks, checks)))
            self.begins, self.sizes = (np.insert(a, where[keep], b[keep]) for a, b in ((self.begins, begins), (self.sizes, sizes)))
            self.pool = pool
        size = sizes[place]
        take = np.repeat(begins[place] - np.cumsum(size) + size, size)
        take += np.arange(len(take))
        return pool[take], size

    def encode_batch(self, texts: pa.Array) -> list[bytes]:
        data, at = hashing.flat(texts)
        n = len(at) - 1
        if not len(data):
            return [b""] * n
        cuts = data == 32
        cuts[at[:-1][np.diff(at) > 0]] = True
        starts = np.flatnonzero(cuts)
        ends = np.append(starts[1:], len(data))
        ids, counts = [], np.zeros(len(starts), np.int64)
        lo = 0
        while lo < len(starts):  # a stretch at a time, so that memory follows the stretch
            hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + _STRETCH)))
            base = starts[lo]
            found, counts[lo:hi] = self._chunks(data[base : ends[hi - 1]], starts[lo:hi] - base, ends[lo:hi] - base)
            ids.append(found)
            lo = hi
        packed = np.concatenate(ids).astype("<u4").tobytes()
        borders = 4 * np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, at)]
        out = [packed[a:b] for a, b in zip(borders.tolist(), borders[1:].tolist(), strict=False)]
        for i in _across(data, at):
            out[i] = self.plain(data[at[i] : at[i + 1]].tobytes().decode())
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_batch(pa.array([text], pa.string()))[0]


_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
#: White space of more than one byte: first two bytes, and the last ones that may follow.
_WIDE_SPACE = {
    (0xC2, 0x85): None, (0xC2, 0xA0): None, (0xE1, 0x9A): {0x80}, (0xE2, 0x81): {0x9F}, (0xE3, 0x80): {0x80},
    (0xE2, 0x80): {*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF},
}


def _across(data: np.ndarray, at: np.ndarray) -> list[int]:
    """Texts in which a match may reach across a cut.

    These have a space between white space, or between white space and the end.
    """
    begins, closes = _SPACE[data], _SPACE[data].copy()
    for p in np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))).tolist():
        pair = (int(data[p]), int(data[p + 1]))
        if pair in _WIDE_SPACE:
            last = _WIDE_SPACE[pair]
            if last is None or int(data[p + 2]) in last:
                begins[p] = True
                closes[p + (1 if last is None else 2)] = True
    starts = at[:-1][np.diff(at) > 0]
    spaces = np.flatnonzero(data == 32)
    begun, done = np.zeros(len(data), bool), np.append(begins, True)
    begun[starts] = True
    done[at] = True  # the end of a text counts as white space
    before = closes[np.maximum(spaces - 1, 0)] & ~begun[spaces]
    after = done[spaces + 1]
    found = spaces[before & after]
    return np.unique(np.searchsorted(at, found, "right") - 1).tolist() if len(found) else []


#: Byte classes of UTF-8: how many bytes follow, and the bounds of the first of them.
_FOLLOW = {
    **{b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)},
    0xE0: (2, 0xA0, 0xBF), **{b: (2, 0x80, 0xBF) for b in range(0xE1, 0xF0)}, 0xED: (2, 0x80, 0x9F),
    0xF0: (3, 0x90, 0xBF), **{b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)}, 0xF4: (3, 0x80, 0x8F),
}


class Utf8Machine:
    """Incremental UTF-8: feed tokens, get the text that is certain so far.

    Bytes that are no UTF-8 become U+FFFD, one for each maximal broken beginning.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.whole: dict[int, str] = {}
        self.tokens = tokens
        for rank, token in tokens.items():
            try:
                self.whole[rank] = token.decode()
            except UnicodeDecodeError:
                pass
        self.reset()

    def reset(self) -> None:
        self.held, self.left, self.low, self.high, self.valid = b"", 0, 0x80, 0xBF, True

    def _byte(self, b: int) -> str:
        if self.left:
            if self.low <= b <= self.high:
                self.held += bytes([b])
                self.left -= 1
                self.low, self.high = 0x80, 0xBF
                if self.left:
                    return ""
                out, self.held = self.held.decode(), b""
                return out
            self.held, self.left, self.valid = b"", 0, False
            return "�" + self._byte(b)
        if b < 0x80:
            return chr(b)
        if b in _FOLLOW:
            self.held, (self.left, self.low, self.high) = bytes([b]), _FOLLOW[b]
            return ""
        self.valid = False
        return "�"

    def feed(self, token: int) -> str:
        if not self.left:
            text = self.whole.get(token)
            if text is not None:
                return text
        return "".join(map(self._byte, self.tokens[token]))

    def close(self) -> str:
        if not self.left:
            return ""
        self.held, self.left, self.valid = b"", 0, False
        return "�"

    def decode(self, ids: Iterable[int]) -> str:
        self.reset()
        return "".join([*map(self.feed, ids), self.close()])

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text pieces, each as soon as it is certain."""
        self.reset()
        for token in ids:
            if out := self.feed(token):
                yield out
        if out := self.close():
            yield out


def _decoding_tables(path: str) -> tuple:
    """The machine, and for each id where its bytes begin, how many, and whether they are whole."""
    tokens = {rank: token for token, rank in read_ranks(path).items()}
    machine = Utf8Machine(tokens)
    begins, sizes = np.zeros(max(tokens) + 1, np.int64), np.zeros(max(tokens) + 1, np.int64)
    whole, at = np.zeros(max(tokens) + 1, bool), 0
    for rank, token in tokens.items():
        begins[rank], sizes[rank], whole[rank] = at, len(token), rank in machine.whole
        at += len(token)
    return machine, begins, sizes, np.frombuffer(b"".join(tokens.values()), np.uint8), whole


_ENCODERS: dict[tuple[str, str], Encoder] = {}
_DECODERS: dict[str, tuple] = {}


def _encode(texts: pa.Array, path: str, pattern: str) -> list[bytes]:
    """Packed ids of a batch; the compiled tables stay with the Python worker for its next tasks."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    gc.disable()  # the tables hold no cycles, and going through them again and again is slow
    try:
        return _ENCODERS[path, pattern].encode_batch(texts)
    finally:
        gc.enable()


def _decode(packed: Iterable[bytes], path: str) -> tuple[list[bytes], list[bool]]:
    """Bytes of packed ids, and whether they are UTF-8."""
    if path not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[path] = _decoding_tables(path)
    machine, begins, sizes, data, whole = _DECODERS[path]
    out, good = [], []
    for ids in packed:
        found = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        if len(found) and (found.max() >= len(sizes) or not sizes[found].all()):
            raise ValueError("an id without a token")
        size = sizes[found]
        ends = np.cumsum(size)
        at = np.repeat(begins[found] - ends + size, size)
        at += np.arange(len(at))
        out.append(data[at].tobytes())
        if whole[found].all():
            good.append(True)
        else:
            machine.decode(found.tolist())
            good.append(machine.valid)
    return out, good


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append ``ids``: the text's token ids, packed as little-endian unsigned 32-bit integers.

    A null text counts as empty; the empty text has no ids.  Every whole text is encoded in
    one task as it streams by: no shuffle, and memory for one batch of rows and the bounded
    tables of the transducer.  A column of ``df`` called ``ids`` is replaced.  ``path`` is a
    file of ranks that every executor can open.
    """
    return add_columns(
        df, [text], f"`{ids}` binary", lambda columns: [pa.array(_encode(columns[0], path, pattern), pa.binary())]
    )


def decode(
    df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded", valid: str = "decoded_valid"
) -> DataFrame:
    """Append ``decoded``, the bytes of packed ids, and ``valid``, whether they are UTF-8.

    Null ids count as none.  An id without a token makes the task fail: nothing is dropped.
    Text for display comes from :class:`Utf8Machine`, which gives it token by token.
    """

    def work(columns: list[pa.Array]) -> list[pa.Array]:
        out, good = _decode((p.as_py() or b"" for p in columns[0]), path)
        return [pa.array(out, pa.binary()), pa.array(good, pa.bool_())]

    return add_columns(df, [ids], f"`{decoded}` binary, `{valid}` boolean", work)


def encode_and_decode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
    decoded: str = "decoded", valid: str = "decoded_valid",
) -> DataFrame:
    """:func:`encode`, then :func:`decode` of its ids, in one Python pass.

    One after the other they would hold two Python workers per task, each with its tables.
    """

    def work(columns: list[pa.Array]) -> list[pa.Array]:
        packed = _encode(columns[0], path, pattern)
        out, good = _decode(packed, path)
        return [pa.array(packed, pa.binary()), pa.array(out, pa.binary()), pa.array(good, pa.bool_())]

    return add_columns(df, [text], f"`{ids}` binary, `{decoded}` binary, `{valid}` boolean", work)
