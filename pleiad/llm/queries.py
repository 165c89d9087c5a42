"""The registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import line_dedup, mixing, neighbours, ngram, packing, quality_model, quality_rules, secrets, simhash, toxicity
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_digest(table(spark, sf_dir, "documents"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.scored(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality_rules.judged(table(spark, sf_dir, "documents"))
    return got.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "class_distance", "word_distance")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


OPERATORS = (op1_simhash, op2_mixing, op3_packing, op4_quality_model, op5_ngram, op6_quality_rules, op7_line_dedup, op8_toxicity, op9_neighbours, op10_secrets)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPERATORS}
#: SQL for those that SQL can express. The others need hashes that it lacks, a tokenizer, a trained model or a sampled index; their
#: tests hold them against plain versions.
ORACLES: dict[str, str] = {
    "op7_line_dedup": r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM placed),
shared AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(shared.key) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN shared.key IS NULL THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id""",
}
