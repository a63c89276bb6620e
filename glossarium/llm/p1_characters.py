"""Problem 1: pronunciations and definitions that hold characters other than those their look calls for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.llm.lookalikes import IPA, TEXT, consistent_texts, inconsistent_rows
from glossarium.operators.skew import union_all
from glossarium.sources.tables import load

FIELDS = (("entries", "pronunciation_uk", IPA), ("entries", "pronunciation_us", IPA), ("senses", "definition", TEXT))
ROW = ["source_table", "row_id", "field"]


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        [
            load(spark, sf_dir, t, "id", c).select(F.lit(t).alias("source_table"), F.col("id").alias("row_id"), F.lit(c).alias("field"), F.lit(k).alias("kind"), F.col(c).alias("text"))
            for t, c, k in FIELDS
        ]
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inconsistent_rows(_texts(spark, sf_dir), ROW)


def p1_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its consistent form."""
    return consistent_texts(_texts(spark, sf_dir).dropDuplicates(ROW), ROW)


QUERIES = {"p1_found": p1_found, "p1_consistent": p1_consistent}
SQL: dict[str, str] = {}
