"""Problem 5: senses whose definition and dictionary source repeat another's apart from small edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.llm.lookalikes import TEXT, consistent_texts
from glossarium.llm.near import link_counts, near_unique
from glossarium.sources.tables import load

THRESHOLD = 0.72


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    senses = load(spark, sf_dir, "senses", "id", "entry_id", "definition").where("definition is not null").dropDuplicates(["id"])
    texts = consistent_texts(senses.select("id", "entry_id", F.lit(TEXT).alias("kind"), F.col("definition").alias("text")), ["id", "entry_id"])
    titles = load(spark, sf_dir, "entries", "id", "dictionary_source").where("trim(dictionary_source) <> ''").groupBy(F.col("id").alias("key")).agg(F.min("dictionary_source").alias("title"))
    return near_unique(texts.select("id", "text", F.col("entry_id").alias("key")), titles, THRESHOLD)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir).select(F.col("id_a").alias("sense_id_a"), F.col("id_b").alias("sense_id_b"))


def p5_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sense that has near copies, with their number."""
    return link_counts(_near(spark, sf_dir))


QUERIES = {"p5_found": p5_found, "p5_links": p5_links}
SQL: dict[str, str] = {}
