"""Near duplicates and top-k search against brute force."""

import random

import numpy as np
import pytest

from millrace.llm import minhash, shingles, topk, vectors
from millrace.llm.common import connected_components


def components(n, links):
    parent = {i: i for i in n}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in n}


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else ({tuple(words)} if words else set())


def brute_dedup(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    comp = components(ids, links)
    return sorted((i, len(sets[i]), comp[i], comp[i] == i) for i in ids)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    links = [(a, a + 1) for a in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)]
    links += [(1000, i) for i in range(1001, 1300)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for e in links if e[0] != e[1] for x in e}
    assert got == components(nodes, [e for e in links if e[0] != e[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_signature_distance_of_similar_sets():
    import pyarrow as pa

    rng = random.Random(2)
    base = [f"v{i}" for i in range(400)]
    texts = [" ".join(base), edited(rng, base, 8)]
    sets, at = shingles.shingle_sets(pa.array(texts))
    a, b = (shingle_set(t) for t in texts)
    s = len(a & b) / len(a | b)
    sig = shingles.signatures(sets, at, 4096)
    assert abs((sig[0] == sig[1]).mean() - s) < 0.04
    assert list(np.diff(at)) == [len(a), len(b)]


@pytest.fixture(scope="module")
def crowd():
    """Exact copies, near copies around the threshold, chains, one shared passage, odd texts."""
    rng = random.Random(3)
    docs = [None, "", " \t\n", "one two", "ONE  two", "one two three four", "a b c d e", "A b c d E", "é à b", "É à b"]
    passage = [f"p{i}" for i in range(30)]
    for g in range(12):
        base = [f"g{g}x{i}" for i in range(rng.randint(20, 160))]
        docs += [" ".join(base)] * rng.randint(1, 4)
        docs += [edited(rng, base, rng.randint(0, max(1, len(base) // 25))) for _ in range(8)]
    hot = [f"h{i}" for i in range(120)]
    docs += [edited(rng, hot, rng.randint(1, 4)) for _ in range(220)]
    docs += [" ".join(passage + [f"u{rng.randrange(10**6)}" for _ in range(12)]) for _ in range(60)]
    return list(enumerate(docs))


@pytest.mark.parametrize("block", [512, 16])
def test_near_duplicates_equal_brute_force(spark, crowd, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in crowd], "doc_id long, text string, KEPT int, sig string").repartition(6)
    got = minhash.near_duplicates(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == brute_dedup(crowd)


def test_near_duplicates_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(none).collect() == []
    odd = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, "A b c d e f"), (8, "x y " * 50_000)],
                                "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(odd).collect()), key=repr)
    assert got == sorted([(None, 2, None, True), (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (8, 2, 8, True)], key=repr)


def brute_top_k(rows, k, step):
    good = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % step == 0:
            dot = lambda b, a=a: sum(x * y for x, y in zip(a, b, strict=True))
            bound = 2**63 - 1
            scores = [(-max(-bound, min(bound, dot(b))), i) for i, b in good if i != q and len(a) == len(b)]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("dims,k,block", [(16, 10, 50), (3, 4, 4096), (1, 3, 7)])
def test_top_k_equals_brute_force(spark, dims, k, block):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(230, dims)).round(1)  # many ties
    x[40:80] = x[40]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(500, None), (505, [float("nan")] * dims), (510, [None] * dims), (515, [float("inf")] * dims), (520, [1.0] * (dims + 1)),
             (525, [2.0] * (dims + 1)), (None, [1.0] * dims), (530, [1e15] * dims)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    all_ = topk.integers(df, "vec_id", "embedding", 1024)
    got = topk.top_k(all_.where("id % 5 = 0"), all_, k, query_block=16, vector_block=block)
    assert sorted(map(tuple, got.collect())) == brute_top_k(rows, k, 5)


def test_top_k_of_nothing_and_of_few(spark):
    none = topk.integers(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding", 1024)
    assert topk.top_k(none, none, 10).collect() == []
    two = topk.integers(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>"), "vec_id", "embedding", 1024)
    assert sorted(map(tuple, topk.top_k(two, two, 10).collect())) == [(0, 1, 1, 2 * 1024**2), (1, 1, 0, 2 * 1024**2)]


def brute_vectors(rows):
    usable = [(i, v, label) for i, v, label in rows
              if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    degree = {id(r): 0 for r in usable}
    links = []
    for k, a in enumerate(usable):
        for b in usable[k + 1 :]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98:
                    degree[id(a)] += 1
                    degree[id(b)] += 1
                    links.append((a[0], b[0]))
    comp = components({r[0] for r in rows if r[0] is not None}, [e for e in links if e[0] != e[1]])
    mine = {id(r): n for r, n in zip(usable, degree.values(), strict=True)}
    by_row = {(r[0], str(r[1]), r[2]): mine[id(r)] for r in usable}
    return sorted(((i, by_row.get((i, str(v), label), 0), comp.get(i), i is None or comp[i] == i) for i, v, label in rows), key=repr)


@pytest.mark.parametrize("dims,block,leaf", [(12, 1024, 64), (3, 20, 4)])
def test_vectors_equal_brute_force(spark, dims, block, leaf, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "LEAF", leaf)
    rng = np.random.default_rng(dims)
    rows = []
    for g in range(12):
        centre = rng.normal(size=dims)
        for _ in range(20):
            v = centre + rng.normal(size=dims) * rng.choice([0.02, 0.1, 0.2])
            rows.append([float(c) for c in v * rng.choice([1, 3])])
    rows += [rows[0]] * 30 + [[0.0] * dims, None, [], [float("nan")] * dims, [None] * dims, [float("inf")] * dims, [1.0] * (dims + 1)]
    rows = [(i, v, int(rng.integers(0, 2)) if i % 17 else None) for i, v in enumerate(rows)]
    rows += [(None, rows[0][1], 1), (None, rows[1][1], None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, KEPT int").repartition(5)
    got = vectors.near_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_vectors(rows)


def test_vectors_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(none).collect() == []
