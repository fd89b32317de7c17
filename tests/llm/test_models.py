"""Language ID and toxicity: held-out accuracy, and defined results for odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, toxicity
from millrace.llm.common import held_out, table

SF = "/root/testdata/sf0.01"
ODD = [(1, None, "x"), (2, "", "x"), (3, "123 !?", "x"), (None, "le la les", "x"), (4, "the " * 100_000, "x"), (4, "the", "y")]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def test_held_out_is_crc32_of_the_id_as_text(spark):
    df = spark.createDataFrame([(i,) for i in [*range(200), -5, None]], "doc_id long")
    for r in df.select("doc_id", held_out().alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_presence_is_that_of_all_ngrams_and_stretches_join():
    texts = pa.array(["Ab", "ab", "xyz " * 50, ""])
    seen = langid.presence(texts)
    assert (seen[0] == seen[1]).all() and not seen[3].any()
    assert seen[0].sum() == 3  # a, b, ab
    whole = seen[2]
    langid._STRETCH, before = 16, langid._STRETCH
    try:
        assert (langid.presence(texts)[2] == whole).all()
    finally:
        langid._STRETCH = before


def test_language_held_out_accuracy(docs):
    model = langid.fit(docs)
    got = langid.predict(docs, model).where(held_out()).select("lang", "lang_pred", "score").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_megabyte_texts_with_odd_words(spark, docs):
    rng = random.Random(3)
    texts = {}
    for lang, text in docs.where(held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text").collect():
        texts.setdefault(lang, []).extend(text.split())
    long = []
    for size in (50_000, 1_000_000):
        for lang, words in sorted(texts.items()):
            out, n = [], 0
            while n < size:
                out += [*rng.choices(words, k=20), "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))]
                n += sum(len(w) + 1 for w in out[-21:])
            long.append((lang, " ".join(out)))
            long.append((lang, long[-1][1] + " 0123 " * (size // 3)))
    model = langid.fit(docs)
    got, _ = model.predict(pa.array([t for _, t in long]))
    assert len(texts) >= 4 and got == [lang for lang, _ in long]


def test_language_of_odd_rows(spark, docs):
    model = langid.fit(docs)
    df = spark.createDataFrame(ODD, "doc_id long, text string, Lang_Pred string")
    got = langid.predict(df, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.lang_pred == "und") == (r.text is None or r.text in ("", "123 !?"))
    none = docs.where("doc_id < 0")
    assert langid.predict(none, model).collect() == []
    empty = langid.fit(none)
    assert {r.lang_pred for r in langid.predict(df, empty).collect()} == {"und"}


def test_language_learns_only_from_other_folds_and_bounded_rows(docs):
    broken = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'zz', lang) as lang")
    assert "zz" not in langid.fit(broken, per_lang=20, landmarks_per_lang=10).languages


def test_toxicity_held_out(spark, docs):
    labels = table(spark, SF, "labels")
    model = toxicity.fit(docs, labels)
    assert len(model.coords) < 20_000
    got = toxicity.score(docs, model).where(held_out()).join(labels, "doc_id").select("score", "toxic").collect()
    y = np.array([r.toxic for r in got])
    s = np.array([r.score for r in got])
    assert ((s >= 0) & (s <= 1)).all()
    order = s.argsort().argsort() + 1
    auc = (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())
    assert auc > 0.85


def test_toxicity_of_odd_rows(spark, docs):
    train = spark.createDataFrame([(i, f"you idiot {i}" if i % 2 else f"a fine day {i}") for i in range(1, 400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 400)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(train, labels)
    df = spark.createDataFrame([*ODD, (9, "what an IDIOT!!", "x"), (10, "a fine evening", "x")], "doc_id long, text string, SCORE string")
    rows = {(r.doc_id, r.text): r.score for r in toxicity.score(df, model).collect()}
    assert rows[9, "what an IDIOT!!"] >= 0.5 > rows[10, "a fine evening"]
    assert rows[1, None] == rows[2, ""] == rows[3, "123 !?"]
    nothing = toxicity.fit(train, labels.where("doc_id < 0"))
    assert {r.score for r in toxicity.score(df, nothing).collect()} == {0.5}
    assert toxicity.score(df.where("doc_id < 0"), model).collect() == []


def test_features_are_words_pairs_and_skip_pairs():
    rows, coords = toxicity.distinct(*toxicity.features(pa.array(["a b c a b", "A, b!", None])))
    # a b c | ab bc ca | a_c b_a c_b
    assert (rows == 0).sum() == 9
    assert (rows == 1).sum() == 3
    assert not (rows == 2).any()


def test_ftrl_state_does_not_depend_on_partitions(spark, docs):
    labels = table(spark, SF, "labels")
    small = docs.where("doc_id < 200")
    a = toxicity.fit(small, labels)
    b = toxicity.fit(small.repartition(7), labels.repartition(3))
    assert (a.coords == b.coords).all() and np.allclose(a.values, b.values)
