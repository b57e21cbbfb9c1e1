"""The operators of this subpackage as queries over the test tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from areakit.llm import (
    jaccard,
    languages,
    mixing,
    nearest,
    negatives,
    pieces,
    quality,
    rules,
    sharding,
    spelling,
    substrings,
    tokens,
    toxicity,
)
from areakit.llm.common import documents, labels


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.nearest_rows(rows, F.col("vec_id") % 100 == 0)


def op4_shard_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.judge_documents(documents(spark, sf_dir)).select(*columns)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_documents(documents(spark, sf_dir), labels(spark, sf_dir))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_documents(documents(spark, sf_dir))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = substrings.remove_repeats(documents(spark, sf_dir))
    return rest.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return negatives.mine_negatives(rows.withColumn("label", turned), F.col("vec_id") % 50 == 0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(documents(spark, sf_dir))


def op13_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify_documents(documents(spark, sf_dir))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_toxicity": op2_toxicity,
    "op3_nearest": op3_nearest,
    "op4_shard_bytes": op4_shard_bytes,
    "op5_host_rules": op5_host_rules,
    "op6_quality": op6_quality,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_token_counts": op9_token_counts,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_languages": op13_languages,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_mix_sources": r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat_ws('|', CAST(doc_id AS VARCHAR), coalesce(source, ''), coalesce(md5(text), ''))) AS key
  FROM documents),
by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sizes GROUP BY source),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM by_source) - coalesce(sum(3 * source_size) OVER w, 0)) /
    ((SELECT sum(weight) FROM by_source) - coalesce(sum(weight) OVER w, 0)) AS level
  FROM by_source
  WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, (SELECT max(level) FROM levels) * weight) AS target
  FROM levels),
ordered AS (
  SELECT d.doc_id, d.size::BIGINT AS size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS before
  FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM ordered""",
    "op5_host_rules": r"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, words[i : i + 4] AS gram FROM (
    SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM base)),
repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(0, 5) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measured AS (
  SELECT b.doc_id, b.source, len(words)::BIGINT AS n_words,
    coalesce(list_sum([length(w) FOR w IN words]), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM base b LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS failed FROM judged
  WHERE source IS NOT NULL GROUP BY source),
spread AS (SELECT avg(failed / n) AS m, var_pop(failed / n) AS v, avg(1 / n) AS chance FROM hosts),
prior AS (SELECT m, v - m * (1 - m) * chance AS v FROM spread),
rates AS (
  SELECT source, CASE WHEN v > 0 THEN (failed + greatest(m * (1 - m) / v - 1, 0) * m)
    / (n + greatest(m * (1 - m) / v - 1, 0)) ELSE m END AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(rate <= 0.5, true) AS kept
FROM judged LEFT JOIN rates USING (source)""",
    "op10_substring_dedup": r"""
WITH base AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS gram FROM (
    SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM base)),
lost AS (
  SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY gram) < doc_id),
covered AS (
  SELECT DISTINCT doc_id, i + k AS place FROM lost, range(0, 50) AS r(k)),
placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM base),
rest AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM base LEFT JOIN rest USING (doc_id)""",
    "op11_hard_negatives": """
WITH base AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
    list_dot_product(a.v, c.v)::BIGINT AS score
  FROM base a JOIN base c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
}
