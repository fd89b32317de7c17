"""One registered query per operator: production parameters over the whole table, full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, bpe, langid, licenses, lm, minhash, negatives, packing, pii, repeats, topk, toxicity, vectors
from millrace.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

#: The key of pseudonyms in the registered queries; a real run passes its own secret.
PII_KEY = "example key"

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole text, decode the ids, and give digests of both."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", (F.length("ids").cast("long") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "decoded_valid",
    )


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line or whole text that is a licence notice, with its best template's coefficient."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs).select("doc_id", F.explode("licenses").alias("m"))
    return found.select("doc_id", "m.line", "m.license", F.round("m.dice", 6).alias("dice"))


ORACLE["op2_license_scan"] = licenses.oracle()


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, smallest reachable document and whether it is kept, for every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Links to components: the smallest id reachable from each node over ``links(a, b)``.
_REACH = """
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (
  SELECT id, id FROM nodes UNION SELECT r.a, l.b FROM reach AS r JOIN both_ways AS l ON l.a = r.b),
component AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY 1)"""

ORACLE["op3_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
nodes AS (
  SELECT doc_id AS id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM w),
e AS (SELECT id, unnest(s) AS g FROM nodes),
i AS (SELECT x.id AS a, y.id AS b, count(*) AS n FROM e AS x JOIN e AS y ON x.g = y.g AND x.id < y.id GROUP BY ALL),
links AS (
  SELECT a, b FROM i JOIN nodes AS x ON x.id = a JOIN nodes AS y ON y.id = b
  WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)), {_REACH}
SELECT id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, component_id = id AS kept
FROM nodes JOIN component USING (id)
"""


@query
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest inner products of every hundredth vector with all others."""
    vectors_ = topk.integers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024)
    return topk.top_k(vectors_.where("id % 100 = 0"), vectors_, 10)


ORACLE["op4_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 10
"""


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = packing.encode_words(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "ids")
    pieces = packing.cut_pieces(encoded).select(
        "doc_id", "start", "length", F.crc32("piece").alias("ids_crc32"), "doc_tokens"
    )
    return packing.pack(pieces, ["doc_id", "start", "ids_crc32"], docs.count())


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document, learnt from labels of four folds of five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op8_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of links, smallest reachable vector and whether it is kept, for every vector."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


ORACLE["op8_vector_near_dedup"] = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (
  SELECT id, label, e, sqrt(list_sum([x * x FOR x IN e])) AS n FROM nodes
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT x.id AS a, y.id AS b FROM v AS x JOIN v AS y ON x.label = y.label AND x.id < y.id AND len(x.e) = len(y.e)
  WHERE x.n > 0 AND y.n > 0 AND list_sum([x.e[i] * y.e[i] FOR i IN range(1, len(x.e) + 1)]) >= 0.98 * x.n * y.n), {_REACH},
degree AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY 1)
SELECT id AS vec_id, CAST(coalesce(degree.n, 0) AS BIGINT) AS n_links, component_id, component_id = id AS kept
FROM nodes JOIN component USING (id) LEFT JOIN degree USING (id)
"""


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers, dates and addresses replaced by pseudonyms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).select("doc_id", "text", "n_replaced")


@query
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the counts of all documents."""
    found = lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", F.round("log10_score", 4).alias("log10_score"),
        F.round("log10_per_word", 4).alias("log10_per_word"),
    )


ORACLE["op10_lm_score"] = lm.oracle()


@query
def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of passages of 35 words that occur twice."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


ORACLE["op11_repeated_passages"] = """
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (SELECT r, s, hash(array_to_string(w[s:s + 34], ' ')) AS h, md5(array_to_string(w[s:s + 34], ' ')) AS m
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM w)),
twice AS (SELECT h, m FROM g GROUP BY ALL HAVING count(*) > 1),
gone AS (SELECT r, list_distinct(flatten(list(range(s, s + 35)))) AS places FROM g JOIN twice USING (h, m) GROUP BY r),
k AS (
  SELECT doc_id, w, [i FOR i IN range(1, len(w) + 1) IF NOT coalesce(list_contains(places, i), false)] AS kept
  FROM w LEFT JOIN gone USING (r))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed,
  sha256(array_to_string([w[i] FOR i IN kept], ' ')) AS kept_sha256
FROM k
"""


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document, with corpus-wide counts of linked pairs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.align(docs, *paths, digest=True)
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for its five best positives."""
    given = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.labelled(given.select("vec_id", "embedding", moved.alias("label")), "vec_id", "embedding", "label", 256)
    return negatives.hard_negatives(rows.where("id % 100 = 0"), rows)


ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
    CAST(list_sum([a.e[i] * c.e[i] FOR i IN range(1, len(a.e) + 1)]) AS BIGINT) AS score
  FROM v AS a JOIN v AS c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.*, other AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS r
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score) WHERE r <= 10
"""
