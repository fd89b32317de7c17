"""Work that is left out because it cannot give a link, and the parts of an alignment."""

import random

import numpy as np
import public_tokenizers

from millrace.llm import alignment, minhash

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def test_members_beyond_the_reach_of_each_other_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    # key, rep, component, other than the pivot's, distance to the pivot; the pivot is 0
    given = [(1, 0, 0, False, 0)] + [(1, i, 0, False, 3) for i in range(1, 21)] + [(1, 21, 0, False, 10)]
    far = [(1, i, 100, True, 50) for i in range(100, 110)]

    def cells(rows):
        named = spark.createDataFrame([(k, r, 0, c, o, 2) for k, r, c, o, _ in rows], "key long, rep long, pivot long, comp long, other boolean, slot int")
        apart = spark.createDataFrame([(r, 0, d) for _, r, _, _, d in rows if r], "a long, b long, d int")
        return minhash._cells(named, apart).collect()

    assert cells(given + far) == []
    # one that only the member at distance 10 may be near
    got = cells([*given, *far, (1, 200, 200, True, 43)])
    across = [r for r in got if r.cross]
    assert {r.rep for r in across} == {21, 200} and len({r.cell for r in across}) == 1
    # those of different components that are not the pivot's all meet
    met = {frozenset((x.rep, y.rep)) for x in got for y in got if not x.cross and x.cell == y.cell}
    assert all(frozenset((i, 200)) in met for i in range(100, 110))


def test_every_pair_that_may_be_near_shares_a_cell(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rng = random.Random(5)
    rows = [(k, k * 1000 + i, k * 1000 + rng.choice([0, 0, 1, 2]) * (i > 0), rng.randrange(0, 65) if i else 0) for k in range(8) for i in range(rng.randrange(3, 30))]
    named = spark.createDataFrame([(k, r, k * 1000, c, c != k * 1000, 2) for k, r, c, _ in rows], "key long, rep long, pivot long, comp long, other boolean, slot int")
    apart = spark.createDataFrame([(r, k * 1000, d) for k, r, _, d in rows if r != k * 1000], "a long, b long, d int")
    cells = {}
    for r in minhash._cells(named, apart).collect():
        cells.setdefault(r.cell, []).append(r)
    times = {}
    for members in cells.values():
        for x in members:
            for y in members:
                if x.rep < y.rep and x.comp != y.comp and (not x.cross or x.other != y.other):
                    times[x.rep, y.rep] = times.get((x.rep, y.rep), 0) + 1
    for k, r, c, d in rows:
        for l, q, e, f in rows:
            # a pair with the pivot is known
            if k == l and r < q and r != k * 1000 and c != e and abs(d - f) <= minhash.MAX_DISTANCE:
                across = (c == k * 1000) != (e == k * 1000)
                assert times[r, q] == 1 if across else times[r, q] >= 1


def test_ends_and_groups_of_long_diagonals():
    both = alignment.Aligner(*PATHS)
    rng = random.Random(6)
    for text in ["the " * 500, " ".join(rng.choice(["the", "internationalisation", "42", "x"]) for _ in range(300)), "a"]:
        whole, ids = (" " + text).encode(), (both.a.ids([text])[0], both.b.ids([text])[0])
        ends = both.ends(whole, *ids)
        assert both.ends(whole + b"!", *ids) is None
        for e, x, c in zip(ends, ids, (both.a, both.b), strict=True):
            assert e == np.cumsum([len(c.table[i]) for i in x]).tolist()
        n, groups, links = both.align(*ids, *ends)
        common = set(ends[0]) & set(ends[1])
        assert n == len(common) == groups.count(";") + 1
        assert links.shape == (len(set(ends[0]) | set(ends[1])), 2)
        assert [int(i) for g in groups.split(";") for i in g.split("|")[0].split(",")] == ids[0]
        assert [int(i) for g in groups.split(";") for i in g.split("|")[1].split(",")] == ids[1]
