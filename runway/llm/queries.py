"""Registered queries of the thirteen operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, imi, jaccard, lm, mixing, negatives, pages, quality, simhash, substrings, topk, toxicity, whitening
from .tables import crc32_mod, load


#: Vocabulary of the byte-level BPE.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document: three words, three bits."""
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, decoded again: number of ids and digests of both."""
    return bpe.encode(load(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, digests=True)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels outside the held-out quarter."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, learn=crc32_mod(F.col("doc_id"), 4) != 2)
    scored = docs.select("doc_id", quality.scorer(spark, model)("text").alias("score"))
    return scored.select("doc_id", (crc32_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products for every fiftieth vector."""
    return topk.search(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every document under a Kneser-Ney trigram model of four fifths of them."""
    docs = load(spark, sf_dir, "documents")
    model = lm.fit(docs, learn=crc32_mod(F.col("doc_id"), 5) != 1, order=3)
    return lm.score(docs, model).select("doc_id", (crc32_mod(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens", "n_known",
                                        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 1, 2, 3: what the mix takes of every document."""
    return mixing.mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth vector."""
    return imi.search(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.extract(load(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels outside the held-out fifth."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, learn=crc32_mod(F.col("doc_id"), 5) != 0)
    scored = docs.select("doc_id", toxicity.scorer(spark, model)("text").alias("score"))
    return scored.select("doc_id", (crc32_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents repeat from earlier ones, at a similarity of 0.8 or more."""
    return substrings.passages(load(spark, sf_dir, "documents"), least=50, similarity=0.8)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five best positives of every fiftieth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label, positives=5, k=3, low=50, high=95, scale=256)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whitened along the first eight principal components."""
    found = whitening.whiten(load(spark, sf_dir, "embeddings"), k=8, scale=1024, shift=100_000)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of at least 90 % of distinct three-word shingles in common."""
    return jaccard.join(load(spark, sf_dir, "documents"), words=3, percent=90).select("doc_id", "n_shingles", "component_id")


QUERIES = {f.__name__: f for f in (op1_simhash, op2_bpe, op3_quality, op4_topk, op5_language_model, op6_mixing, op7_multi_index, op8_pages, op9_toxicity, op10_substrings, op11_hard_negatives, op12_whitening, op13_jaccard)}

ORACLE = {
    "op4_topk": r"""
WITH parts AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS i, floor(256 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM embeddings
  WHERE len(embedding) = (SELECT mode(len(embedding)) FROM embeddings)
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op6_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0|' || doc_id) AS sort_key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources),
ordered AS (
  SELECT *, 3 * source_size / weight AS reach,
         sum(3 * source_size) OVER before AS bounds, sum(weight) OVER before AS weights
  FROM weighted
  WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) - (bounds - 3 * source_size))::DOUBLE
            / ((SELECT sum(weight) FROM weighted) - (weights - weight)) AS level
  FROM ordered),
chosen AS (SELECT level FROM levels WHERE level <= reach ORDER BY reach, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least((SELECT level FROM chosen) * weight, (3 * source_size)::DOUBLE) AS target
  FROM levels),
placed AS (
  SELECT s.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
         (sum(size) OVER (PARTITION BY s.source ORDER BY sort_key, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS words_before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size + least(greatest(budget % source_size - words_before, 0), size) END::BIGINT AS taken
FROM placed""",    "op11_hard_negatives": r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) = (SELECT mode(len(embedding)) FROM embeddings)
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, floor(256 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM rows),
scores AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
    "op13_jaccard": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lists AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2])) END) AS s FROM words),
grams AS (SELECT doc_id, unnest(s) AS gram FROM lists),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN lists a ON a.doc_id = x JOIN lists b ON b.doc_id = y
  WHERE 100 * shared >= 90 * (len(a.s) + len(b.s) - shared)),
reach AS (
  SELECT doc_id, doc_id AS root FROM lists
  UNION
  SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.doc_id)
SELECT l.doc_id, len(s)::BIGINT AS n_shingles, min(root) AS component_id FROM lists l JOIN reach r USING (doc_id) GROUP BY ALL""",
}
