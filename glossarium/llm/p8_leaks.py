"""Problem 8: documents that contain passages of the evaluation items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.llm.leaks import leaked_items
from glossarium.sources.tables import load


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "eval_items", "item_id", "text"))


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item the number of documents it leaked into."""
    return p8_found(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))


QUERIES = {"p8_found": p8_found, "p8_report": p8_report}
SQL: dict[str, str] = {}
