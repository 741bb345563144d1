"""The registered queries of this subpackage, with production parameters over whole tables,
and their SQL twins where SQL can express the operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.llm import (
    alignment,
    bpe,
    clustering,
    ctw,
    embedding_dedup,
    line_dedup,
    mixing,
    pii,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    toxicity,
)
from convoy.llm.common import fold_of, labelled_sample, table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


def _sample(spark: SparkSession, sf_dir: str, label: str, training: Column, size: int) -> DataFrame:
    return labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label, training, size)


def _predicted(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 3) == 1
    lexicon = toxicity.learn(_sample(spark, sf_dir, "toxic", ~held_out, toxicity.SAMPLE))
    return _predicted(toxicity.score(table(spark, sf_dir, "documents"), lexicon), held_out)


def op5_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 5) == 1
    out = ctw.score(table(spark, sf_dir, "documents"), ~held_out)
    return out.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.query(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents")).drop("n_entropy")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 4) == 2
    model = quality_classifier.learn(_sample(spark, sf_dir, "quality", ~held_out, quality_classifier.SAMPLE))
    return _predicted(quality_classifier.score(table(spark, sf_dir, "documents"), model), held_out)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "__lines.n_lines", "__lines.n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan_documents(docs, pii.learn(spark, docs))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES, PATTERN)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_toxicity": op4_toxicity,
    "op5_ctw": op5_ctw,
    "op6_bpe": op6_bpe,
    "op7_secrets": op7_secrets,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_pii": op11_pii,
    "op12_alignment": op12_alignment,
    "op13_centroids": op13_centroids,
}

ORACLES: dict[str, str] = {}

ORACLES["op3_quality_rules"] = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
),
grams AS (
  SELECT doc_id, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)
),
hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1
),
cover AS (
  SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM hit) GROUP BY doc_id
),
f AS (
  SELECT w.doc_id, t, ws, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_word_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cover USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_word_lines
            OR 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 40 * word_chars
            OR 10 * (length(t) - length(replace(t, '!', ''))) > 3 * n_words
            OR 10 * len(list_filter(ws, lambda x: regexp_matches(x, '^[!-@\[-`{-~]+$'))) > 4 * n_words) AS kept
FROM f
"""

ORACLES["op9_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
                       FILTER (keeper IS NULL OR doc_id IS NOT DISTINCT FROM keeper), '')) AS kept_sha256
FROM l LEFT JOIN shared USING (k) GROUP BY doc_id
"""


def _lloyd_sql(dims: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> str:
    """Lloyd's rounds as a chain of common table expressions, one row per vector and dimension."""
    parts = [
        f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS g, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor({scale} * x)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
),
long AS MATERIALIZED (SELECT g, unnest(range(1, {dims} + 1)) AS i, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT c, unnest(range(1, {dims} + 1)) AS i, unnest(v) AS x
  FROM (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM kept)
  WHERE c < {k}
)"""
    ]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
  SELECT g, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT g, c, sum((l.x - m.x) * (l.x - m.x))::BIGINT AS d FROM long l JOIN c{r} m USING (i) GROUP BY g, c) GROUP BY g
)""")
        if r < rounds:
            parts.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, x)::BIGINT AS x
  FROM c{r} LEFT JOIN (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN long USING (g) GROUP BY c, i) USING (c, i)
)""")
    return ",".join(parts) + f"""
SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (g)
JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c) USING (c)
"""


ORACLES["op13_centroids"] = _lloyd_sql()
