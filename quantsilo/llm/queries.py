"""The registered queries of the training-data operators, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantsilo.llm import (bpe, chat_windows, content_sort, hard_negatives, langid_zstd, license_scan, lm_scoring, ngram_join,
                           packing, simhash_trie, sparse_balls, toxicity, vptree)
from quantsilo.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    out = toxicity.score(docs, model)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op4_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_sort(table(spark, sf_dir, "documents")).drop("n_chars")


SQL["op4_content_sort"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER w AS k
  FROM d
  WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid_zstd.train(docs, fold("doc_id", 4) != 2)
    out = langid_zstd.classify(docs, model, keep=("doc_id",))
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("detections")


@query
def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    return chat_windows.read_back(chat_windows.format_windows(turns.unionByName(more)))


@query
def op7_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


SQL["op7_vptree"] = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank, vec_id, score FROM p
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_scoring.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


@query
def op11_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_balls.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


SQL["op12_lexical_search"] = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), f AS (
  SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL
), d AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY ALL
), s AS (
  SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM d
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM f, s GROUP BY term
), p AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN w USING (term) JOIN d USING (doc_id), s
  GROUP BY ALL
), r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM p WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(vectors, vectors.where(F.col("vec_id") % 100 == 0))


SQL["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
  WHERE a.vec_id % 100 = 0
), pos AS (
  SELECT * FROM (SELECT anchor_id, id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k
                 FROM p WHERE same) WHERE k <= 5
), neg AS (
  SELECT q.anchor_id, q.id AS positive_id, q.score AS positive_score, p.id AS negative_id, p.score AS negative_score,
         row_number() OVER (PARTITION BY q.anchor_id, q.id ORDER BY p.score DESC, p.id) AS rank
  FROM pos q JOIN p ON p.anchor_id = q.anchor_id AND NOT p.same
   AND 30 * q.score <= 100 * p.score AND 100 * p.score <= 90 * q.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 10
"""
