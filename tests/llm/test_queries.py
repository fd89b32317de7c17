"""Registered queries against their SQL, and the pipeline stage by stage."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import _lines, duck
from millrace.llm import langid, toxicity
from millrace.llm.common import held_out, table
from millrace.llm.queries import ORACLE, QUERIES
from tests.llm.test_pairs import brute_dedup

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables not there")


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    got = _lines(df.columns, df.collect())
    cur = duck(SF).execute(ORACLE[name])
    assert got == _lines([c[0] for c in cur.description], cur.fetchall())


def test_near_dedup_query_equals_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op3_minhash_near_dedup"](spark, SF).collect()))
    assert got == brute_dedup(docs)


def test_model_queries_give_every_document(spark):
    n = table(spark, SF, "documents").count()
    for name in ("op5_language_id", "op7_toxicity", "op9_pii", "op1_byte_bpe"):
        assert QUERIES[name](spark, SF).select("doc_id").distinct().count() == n


@pytest.fixture(scope="module")
def docs(spark):
    """The sample with extra columns, a row without text, an empty one and one without id."""
    base = table(spark, SF, "documents").withColumn("score", F.lit("x"))
    odd = spark.createDataFrame([(900_001, None, "en", "s", None, "x"), (900_002, "", "en", "s", 0, "x"), (None, "the of and to", "en", "s", 13, "x")],
                                base.schema)
    return base.unionByName(odd)


def test_stages_keep_columns_and_decide(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language ID", "MinHash near-dedup", "PII", "packing"]

    model = toxicity.fit(docs, table(spark, SF, "labels"))
    want = toxicity.score(docs, model, out="p").where("p < 0.5").drop("p")
    got = stages["toxicity"](spark, docs, SF)
    assert got.columns == docs.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0

    got = stages["language ID"](spark, docs, SF)
    known = langid.predict(docs, langid.fit(docs))
    assert got.columns == docs.columns
    assert got.count() == known.where("lang_pred <> 'und' and score >= 0.25").count()
    assert {900_001, 900_002}.isdisjoint(r.doc_id for r in got.collect())

    got = stages["MinHash near-dedup"](spark, docs, SF)
    plain = [tuple(r) for r in docs.where("doc_id is not null").select("doc_id", "text").collect()]
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.where("doc_id is not null").collect()) == [i for i, _, _, kept in brute_dedup(plain) if kept]
    assert got.where("doc_id is null").count() == 1

    got = stages["PII"](spark, docs, SF)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert got.where("n_chars <> length(text)").count() == 0

    packed = stages["packing"](spark, docs, SF)
    ends = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d"))
    assert ends.where("n <> d").count() == 0 and ends.count() == docs.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_stages_of_an_empty_table(spark, docs):
    none = docs.where("doc_id < -5")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []


def test_run_gives_the_pieces_of_what_stays(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    kept = {r.doc_id for r in QUERIES["op3_minhash_near_dedup"](spark, SF).where("kept").collect()}
    assert got and {r.doc_id for r in got} <= {r.doc_id for r in table(spark, SF, "documents").collect()}
    assert len({r.doc_id for r in got}) <= len(kept) + 5
    held = table(spark, SF, "documents").where(held_out()).count()
    assert held > 0
