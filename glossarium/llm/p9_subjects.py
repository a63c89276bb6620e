"""Problem 9: the subjects of each document, in every language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.llm.subjects import document_subjects
from glossarium.sources.tables import load


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_subjects(load(spark, sf_dir, "documents", "doc_id", "text", "lang"), load(spark, sf_dir, "doc_labels", "doc_id", "subject"), load(spark, sf_dir, "subjects", "subject"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subjects(spark, sf_dir).select("doc_id", "subject")


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and summed shares by subject."""
    return _subjects(spark, sf_dir).groupBy("subject").agg(F.count(F.lit(1)).alias("documents"), F.round(F.sum("share"), 3).alias("summed_share"))


QUERIES = {"p9_found": p9_found, "p9_composition": p9_composition}
SQL: dict[str, str] = {}
