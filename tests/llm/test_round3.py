"""Repeated passages, tokenizer alignment and hard negatives against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import alignment, negatives, repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- repeated passages --------------------------------------------------------


def brute_repeats(docs, words):
    split = [(d, WORD.findall(t or "")) for d, t in docs]
    seen = Counter(tuple(w[s : s + words]) for _, w in split for s in range(len(w) - words + 1))
    out = []
    for d, w in split:
        gone = bytearray(len(w))
        for s in range(len(w) - words + 1):
            if seen[tuple(w[s : s + words])] > 1:
                gone[s : s + words] = b"\1" * words
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def shown_repeats(df):
    return sorted((tuple(r) for r in df.select(df.columns[0], "n_words", "n_removed", "kept").collect()), key=repr)


def texts(seed, n=60):
    """Few words, so that windows recur; passages inside texts, copies, one periodic and one long text."""
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c Ä B x y dd e".split(" "))
    passage = [f"w{i}" for i in range(40)]
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(0, 60))] if i % 4 else [f"u{rng.randrange(10**6)}" for _ in range(30)]
        if i % 3 == 0:
            lo = rng.randrange(20)
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[lo : lo + rng.randrange(5, 21)]
        out.append((i, rng.choice([" ", "\n", " \t"]).join(w)))
    out += [(1000, out[3][1]), (1001, out[3][1]), (1002, "p q " * 30), (1003, " ".join(f"z{i % 500}" for i in range(1200)))]
    return out


@pytest.mark.parametrize("words, anchor, hot", [(7, 3, 1000), (7, 3, 2), (5, 5, 1), (3, 1, 4)])
def test_repeats_equal_brute_force(spark, words, anchor, hot):
    docs = texts(words + hot)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = shown_repeats(repeats.remove_repeats(df, words=words, anchor=anchor, hot=hot))
    assert got == brute_repeats(docs, words)
    assert any(r[2] for r in got) and any(r[1] and not r[2] for r in got)


def test_repeats_of_odd_rows(spark):
    w = " ".join(f"w{i}" for i in range(10))
    docs = [(1, None), (2, ""), (3, " \n"), (None, w), (None, w), (4, "x " + w + " y"), (4, "one two"), (5, " ".join("abc"))]
    df = spark.createDataFrame([(d, t, "k", [(1, 2)]) for d, t in docs], "doc_id long, text string, kept string, removed array<struct<a:int,b:int>>")
    got = repeats.remove_repeats(df, words=10, anchor=4)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept", "removed"]
    assert shown_repeats(got) == brute_repeats(docs, 10)
    assert [(s["from"], s["to"]) for r in got.where("doc_id = 4 and n_words > 2").collect() for s in r.removed] == [(1, 11)]
    assert repeats.remove_repeats(df.where("doc_id < 0")).collect() == []


def test_a_whole_window_recurring_in_one_very_long_text(spark):
    rng = random.Random(1)
    w = [f"u{rng.randrange(10**7)}" for _ in range(60_000)]
    w[50_000:50_040] = w[10:50]
    docs = [(1, " ".join(w)), (2, "short text")]
    got = shown_repeats(repeats.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute_repeats(docs, 35) and got[0][2] == 80


def test_found_stretches_need_equal_words():
    same = b"a b c d e f"
    assert repeats.locate([(same, 1), (b"x a b c d", 1), (b"a b c", 1)], 4) == [[(0, 4)], [(1, 5)], []]
    assert repeats.locate([(same, 2)], 4) == [[(0, 6)]]
    assert repeats.locate([], 4) == []


# --- alignment ------------------------------------------------------------------

PATHS = tuple(public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def brute_groups(ends_a, ends_b):
    both = sorted(set(ends_a) & set(ends_b))
    out, i, j = [], 0, 0
    for c in both:
        p, q = ends_a.index(c) + 1, ends_b.index(c) + 1
        out.append((i, p, j, q))
        i, j = p, q
    return out


def test_diagonal_groups_equal_brute_force():
    rng = random.Random(2)
    for n in [1, 2, 5, 40, 300] * 8:
        ends = [sorted({rng.randrange(1, n + 1) for _ in range(rng.randrange(n + 1))} | {n}) for _ in range(2)]
        if rng.random() < 0.4:  # long diagonals with few differences
            ends[1] = sorted(set(ends[0]) - {ends[0][0]} | {n})
        got, links = [], []
        for a0, a1, b0, b1, pairs in alignment.diagonal_groups(*ends):
            got += [(a0 + t, a0 + t + 1, b0 + t, b0 + t + 1) for t in range(a1 - a0)] if pairs is None else [(a0, a1, b0, b1)]
            links += [(a0 + t, b0 + t) for t in range(a1 - a0)] if pairs is None else pairs
        assert got == brute_groups(*ends)
        begin = [[0, *e[:-1]] for e in ends]
        assert sorted(links) == [
            (p, q) for p in range(len(ends[0])) for q in range(len(ends[1]))
            if max(begin[0][p], begin[1][q]) < min(ends[0][p], ends[1][q])
        ]
    assert list(alignment.diagonal_groups([], [])) == []


def test_ids_and_bytes_are_those_of_the_libraries():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATHS[0])
    whole.encode_special_tokens = True
    a = alignment.ByteLevel(PATHS[0])
    for text in ["Hello  world's", "<|endoftext|> x", "数字 1234\n\n\tüß", "   ", "a" * 3000, "🙂🙂 é"]:
        ids = a.ids([text])[0]
        assert ids == whole.encode(" " + text, add_special_tokens=False).ids
        assert b"".join(a.table[i] for i in ids) == (" " + text).encode()


def brute_alignment(docs):
    both = alignment.Aligner(*PATHS)
    rows, counts = [], Counter()
    for d, t in docs:
        text = t or ""
        ids = (both.a.ids([text])[0], both.b.ids([text])[0])
        parts = [[c.table[i] for i in x] for c, x in zip((both.a, both.b), ids, strict=True)]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            rows.append((d, 0, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(b) for b in p]).tolist() for p in parts]
        groups = brute_groups(*ends)
        shown = ";".join(",".join(map(str, ids[0][i:p])) + "|" + ",".join(map(str, ids[1][j:q])) for i, p, j, q in groups)
        begin = [[0, *e[:-1]] for e in ends]
        links = [
            (ids[0][p], ids[1][q]) for i, u, j, v in groups for p in range(i, u) for q in range(j, v)
            if max(begin[0][p], begin[1][q]) < min(ends[0][p], ends[1][q])
        ]
        counts.update(set(links))
        rows.append((d, len(ids[0]), len(ids[1]), len(groups), links, shown))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    return sorted([
        (d, na, nb, ng, len(links), shown, sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links))
        for d, na, nb, ng, links, shown in rows
    ], key=repr)


def test_alignment_equals_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    word = ["the", "internationalisation", "Straße", "42", "<s>", "</s>", "<0x41>", "▁", "東京", "🙂", "x\ty", "\n\n", "O'Neil's", "aaaaaaa"]
    docs = [(i, " ".join(rng.choice(word) for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    docs += [(None, "the the"), (3, "the"), (3, "the"), (70, None), (71, ""), (72, " "), (73, "  double  spaces "), (74, "ﬁ ½  "), (75, "word " * 20_000)]
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 2000)
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_a int").repartition(3)
    want = brute_alignment(docs)
    got = sorted((tuple(r) for r in alignment.align(df, *PATHS).collect()), key=repr)
    assert got == want
    digests = {(r.doc_id, r.n_a, r.groups) for r in alignment.align(df, *PATHS, digest=True).collect()}
    assert digests == {(r[0], r[1], hashlib.sha256(r[5].encode()).hexdigest() if r[5] else "") for r in want}
    assert alignment.align(df.where("doc_id < 0"), *PATHS).collect() == []


# --- hard negatives -------------------------------------------------------------


def brute_negatives(anchors, rows, k, m, low=30, high=90):
    out = []
    for a, la, va in anchors:
        score = [(sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in rows if len(v) == len(va)]
        order = sorted(score, key=lambda s: (-s[0], s[1]))
        for p, i, _ in [s for s in order if s[2] == la and s[1] != a][:k]:
            fit = [s for s in order if s[2] != la and low * p <= 100 * s[0] <= high * p][:m]
            out += [(a, i, r, n, p, s) for r, (s, n, _) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("size, blocks", [(3, (2, 5)), (40, (64, 4096)), (10**9, (3, 7)), (10**12, (4, 9))])
def test_negatives_equal_brute_force(spark, size, blocks):
    rng = random.Random(size)
    centres = [[rng.randrange(-size, size + 1) for _ in range(4)] for _ in range(3)]
    rows = []
    for i in range(150):
        label = rng.randrange(3)
        v = [c + rng.randrange(-size // 3 - 1, size // 3 + 2) for c in centres[label]] if i % 3 else [rng.randrange(0, size) for _ in range(4)]
        rows.append((i, label, v if i % 31 else v[:2]))
    df = spark.createDataFrame(rows, "id long, label long, vec array<long>")
    anchors = [r for r in rows if r[0] % 5 == 0]
    got = negatives.hard_negatives(df.where("id % 5 = 0"), df, 3, 4, anchor_block=blocks[0], candidate_block=blocks[1])
    want = brute_negatives(anchors, rows, 3, 4)
    clip = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
    if size < 10**10:
        assert sorted(tuple(r) for r in got.collect()) == want
    else:  # beyond a long only ids are compared where no score is its bound
        bound = {r[0] for r in want if clip(r[4]) != r[4] or clip(r[5]) != r[5]}
        assert {tuple(r) for r in got.collect() if r.anchor_id not in bound} == {r for r in want if r[0] not in bound}
    assert want


def test_bounds_hold_and_leave_scores_out():
    rng = np.random.default_rng(1)
    centres = rng.integers(-300, 300, (4, 16))
    anchors = centres[rng.integers(0, 4, 60)] + rng.integers(-5, 6, (60, 16))
    candidates = centres[rng.integers(0, 4, 500)] + rng.integers(-40, 41, (500, 16))
    bounds = negatives.Bounds(anchors, candidates)
    exact = candidates @ anchors.T
    wanted_of = exact.max(axis=0) * 8 // 10

    def wanted(a, low, high):
        assert (low <= exact[:, a]).all() and (exact[:, a] <= high).all()
        return high >= wanted_of[a]

    for a, some, scores in bounds.visit(wanted):
        assert (scores == exact[some, a]).all()
        assert set(np.flatnonzero(exact[:, a] >= wanted_of[a])) <= set(some)
    assert bounds.rescored < exact.size / 2


def test_negatives_of_odd_rows(spark):
    odd = [
        (100, 1, [1.0, 0.0], "x"), (1, 1, [1.0, 0.0], "x"), (2, 1, [0.5, 0.0], "x"), (3, 2, [0.5, 0.0], "x"), (4, 2, [0.5, 0.9], "x"),
        (5, None, [1.0, 0.0], "x"), (6, 2, None, "x"), (7, 2, [None, 0.0], "x"), (8, 2, [float("nan"), 0.0], "x"), (9, 2, [float("inf"), 0.0], "x"),
        (None, 2, [0.5, 0.0], "x"), (10, 2, [0.5], "x"), (3, 2, [0.5, 0.0], "x"), (200, 3, [1.0, 0.0], "x"),
    ]
    df = spark.createDataFrame(odd, "vec_id long, label int, embedding array<float>, vec string")
    rows = negatives.labelled(df, "vec_id", "embedding", "label", 256)
    assert {r.id for r in rows.collect()} == {100, 1, 2, 3, 4, 10, 200}
    got = sorted(tuple(r) for r in negatives.hard_negatives(rows.where("id % 100 = 0"), rows).collect())
    # the repeated row 3 is a row of its own; anchor 200 has no positive
    assert got == sorted([
        (100, 1, r, n, 65536, 32768) for r, n in ((1, 3), (2, 3), (3, 4))
    ])
    none = rows.where("id < 0")
    assert negatives.hard_negatives(none, none).collect() == []
    assert negatives.hard_negatives(rows.where("id = 100"), none).collect() == []


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(3)
    x = rng.integers(-9, 10, (12, 3))
    order, parent, length = negatives.spanning_tree(x)
    assert sorted(order) == list(range(12)) and parent[order[0]] == -1
    seen = set()
    for a in order:
        assert parent[a] == -1 or parent[a] in seen
        seen.add(a)
    # Kruskal on all pairs
    edges = sorted((float(np.linalg.norm(x[i] - x[j])), i, j) for i in range(12) for j in range(i))
    group, total = list(range(12)), 0.0
    for d, i, j in edges:
        if group[i] != group[j]:
            total, old = total + d, group[i]
            group = [group[j] if g == old else g for g in group]
    assert length.sum() == pytest.approx(total, rel=1e-6)


def test_column_of_the_right_type_comes_out(spark):
    df = spark.createDataFrame([("a", "x y")], "doc_id string, text string")
    assert dict(repeats.remove_repeats(df).dtypes)["doc_id"] == "string"
    assert alignment.align(df, *PATHS).select(F.col("doc_id")).collect()[0][0] == "a"
