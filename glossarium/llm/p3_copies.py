"""Problem 3: headwords and synonyms that differ in formatting only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.llm.fingerprint import copy_counts, hidden_copies
from glossarium.sources.tables import load


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = load(spark, sf_dir, "words", "id", "display_form").select(F.lit("words").alias("source_table"), F.lit("").alias("scope"), "id", F.col("display_form").alias("value"))
    synonyms = load(spark, sf_dir, "sense_synonyms", "id", "sense_id", "is_antonym", "synonym").select(
        F.lit("sense_synonyms").alias("source_table"), F.concat(F.col("sense_id"), F.lit("|"), F.col("is_antonym")).alias("scope"), "id", F.col("synonym").alias("value")
    )
    return words.unionByName(synonyms)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_copies(_records(spark, sf_dir), "id", ["source_table", "scope"], ["value"]).select("source_table", "keep_id", "copy_id")


def p3_copy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_counts(hidden_copies(_records(spark, sf_dir), "id", ["source_table", "scope"], ["value"]), ["source_table"])


_GROUPS = r"""
WITH r AS (
  SELECT DISTINCT 'words' AS source_table, '' AS scope, id, display_form AS v FROM words
  UNION ALL SELECT DISTINCT 'sense_synonyms', sense_id || '|' || is_antonym, id, synonym FROM sense_synonyms
), k AS (
  SELECT *, list_sort(list_filter(list_transform(string_split_regex(lower(v), '[,;/|]'), lambda p: regexp_replace(p, '[^\p{L}\p{N}]', '', 'g')), lambda p: p <> '')) AS parts
  FROM r WHERE v IS NOT NULL AND scope IS NOT NULL
), g AS (SELECT *, min(id) OVER (PARTITION BY source_table, scope, parts) AS keep_id FROM k WHERE len(parts) > 0)
"""

QUERIES = {"p3_found": p3_found, "p3_copy_counts": p3_copy_counts}
SQL = {
    "p3_found": _GROUPS + "SELECT DISTINCT source_table, keep_id, id AS copy_id FROM g WHERE id <> keep_id",
    "p3_copy_counts": _GROUPS + "SELECT source_table, keep_id, count(DISTINCT id) AS copies FROM g GROUP BY source_table, scope, keep_id HAVING count(DISTINCT id) > 1",
}
