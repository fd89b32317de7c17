"""The trained models against plain versions of their methods, and packing of equal rows."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, packing, toxicity
from millrace.llm.common import table

SF = "/root/testdata/sf0.001"


def test_toxicity_equals_plain_ftrl(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PASSES", 3)
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}

    known = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    places = {r.doc_id: r.p for r in docs.select("doc_id", F.xxhash64("doc_id").alias("p")).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    features = {d: {int(c) for c in toxicity.features(pa.array([t or ""]))[1]} - {0} | {0} for d, t in texts.items()}
    shards = {}
    for d in sorted((d for d in known if texts.get(d) is not None), key=lambda d: (places[d], known[d])):
        shards.setdefault(places[d] % toxicity.SHARDS, []).append((features[d], known[d]))

    def weight(z, n):
        if abs(z) <= toxicity.L1:
            return 0.0
        return -(z - math.copysign(toxicity.L1, z)) / ((toxicity.BETA + math.sqrt(n)) / toxicity.ALPHA + toxicity.L2)

    state = {}
    for _ in range(3):
        moves = {}
        for examples in shards.values():
            own = dict(state)
            for coords, y in examples:
                w = {c: weight(*own.get(c, (0.0, 0.0))) for c in coords}
                g = 1 / (1 + math.exp(-sum(w.values()))) - y
                for c in coords:
                    z, n = own.get(c, (0.0, 0.0))
                    sigma = (math.sqrt(n + g * g) - math.sqrt(n)) / toxicity.ALPHA
                    own[c] = (z + g - sigma * w[c], n + g * g)
            for c, (z, n) in own.items():
                z0, n0 = state.get(c, (0.0, 0.0))
                mz, mn = moves.get(c, (0.0, 0.0))
                moves[c] = (mz + (z - z0) / toxicity.SHARDS, mn + (n - n0) / toxicity.SHARDS)
        state = {c: (state.get(c, (0.0, 0.0))[0] + z, state.get(c, (0.0, 0.0))[1] + n) for c, (z, n) in moves.items()}
    for d, coords in features.items():
        total = sum(weight(*state[c]) for c in coords if c in state)
        assert got[d] == pytest.approx(1 / (1 + math.exp(-total)), abs=2e-3)


def plain_slots(text):
    """Slots of all 1- to 4-byte n-grams, letters lower-cased, other ASCII as spaces."""
    data = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in text.encode()]
    out = set()
    for i in range(len(data)):
        gram = 0
        for b in data[i : i + langid.LONGEST]:
            gram = (gram * 0x100000001B3 + b + 1) % 2**64
            out.add(gram * 0x9E3779B97F4A7C15 % 2**64 >> 51)
    return out


def test_language_scores_equal_a_plain_kernel_ridge(spark):
    rows = [r for r in table(spark, SF, "documents").select("doc_id", "text", "lang").collect() if r.text and len(r.text.encode()) <= 3000]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.predict(docs, langid.fit(docs, per_lang=30, landmarks_per_lang=5))
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}

    order = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    train = {}
    for r in sorted(rows, key=lambda r: order[r.doc_id]):
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 5:
            train.setdefault(r.lang, []).append(r)
    sets = {r.doc_id: plain_slots(r.text) for r in rows}
    kernel = lambda x, y: len(sets[x] & sets[y]) / math.sqrt(len(sets[x]) * len(sets[y]))
    letter = lambda r: any(c.isalpha() for c in r.text)
    some = [r for lang in train for r in train[lang][:30] if letter(r)]
    marks = [r.doc_id for lang in train for r in train[lang][:5] if letter(r)]
    k = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(k)
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = np.array([[kernel(r.doc_id, m) for m in marks] for r in some]) @ root
    names = sorted(train)
    y = np.array([[1.0 if r.lang == n else -1.0 for n in names] for r in some])
    w = np.array([len(some) / len(names) / sum(q.lang == r.lang for q in some) for r in some])[:, None]
    beta = np.linalg.solve(phi.T @ (w * phi) + langid.RIDGE * len(some) * np.eye(phi.shape[1]), phi.T @ (w * y))
    for r in rows:
        if not letter(r):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        margins = np.array([kernel(r.doc_id, m) for m in marks]) @ root @ beta
        best = int(margins.argmax())
        if np.sort(margins)[-1] - np.sort(margins)[-2] > 1e-3:
            assert got[r.doc_id][0] == names[best]
            assert got[r.doc_id][1] == pytest.approx(min(1, max(0, (margins[best] + 1) / 2)), abs=2e-3)


def test_packing_spreads_equal_rows_and_keeps_documents_together(spark):
    same = spark.range(40_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "0L AS start", "100L AS length", "7L AS crc")
    groups = lambda df: df.selectExpr("sequence_id % 10 AS g").groupBy("g").count().collect()
    packed = packing.pack(same, ["doc_id", "start", "crc"], 40_000, group_docs=4000)
    assert sorted(r["count"] for r in groups(packed)) == [4000] * 10
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count_distinct("offset").alias("o"), F.count("offset").alias("c"))
    assert full.where("n > 2048 OR o <> c").count() == 0

    pieces = spark.range(600).selectExpr("id % 60 AS doc_id", "id div 60 AS start", "20 + id % 90 AS length")
    packed = packing.pack(pieces, ["doc_id", "start"], 60, group_docs=6)
    of = packed.selectExpr("doc_id", "sequence_id % 10 AS g").groupBy("doc_id").agg(F.count_distinct("g").alias("n"))
    assert packed.count() == 600 and of.where("n > 1").count() == 0
