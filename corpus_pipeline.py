"""Cleaning of a document table: stages that each call one operator of the subpackage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written
and read again as the documents of the next one.  Rows whose decision is undefined (no id)
are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid, minhash, packing, pii, toxicity
from millrace.llm.common import fresh, stored, table
from millrace.llm.queries import PII_KEY

#: A document is rejected as toxic from this score on.
TOXIC_FROM = 0.5
#: A document is rejected without a language, or with a lower score than this.
LANGUAGE_FROM = 0.25


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    mark = fresh(docs.columns)
    return toxicity.score(docs, model, out=mark).where(F.col(mark) < TOXIC_FROM).select(docs.columns)


def reject_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learnt languages stay."""
    lang, score = fresh(docs.columns), fresh(docs.columns)
    found = langid.predict(docs, langid.fit(docs), lang=lang, score=score)
    return found.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LANGUAGE_FROM)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    dropped = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with pseudonyms for personal values and its new length."""
    out = pii.pseudonymise(docs, PII_KEY, n_replaced=(mark := fresh(docs.columns))).drop(mark)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast("long"))
    return out.select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 2048 tokens."""
    given = docs.select("doc_id", "text")
    encoded = packing.encode_words(given, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "ids")
    pieces = packing.cut_pieces(encoded).select(
        "doc_id", "start", "length", F.crc32("piece").alias("ids_crc32"), "doc_tokens"
    )
    return packing.pack(pieces, ["doc_id", "start", "ids_crc32"], given.count())


STAGES = [
    ("toxicity", reject_toxic),
    ("language ID", reject_unknown_language),
    ("MinHash near-dedup", near_dedup),
    ("PII", pseudonyms),
    ("packing", pack_sequences),
]

#: Trained models and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
