"""Problem 4: dictionary senses and WordNet synsets of the same meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.llm.retrieval import matched, terms_column
from glossarium.sources.tables import load


def _bare(text: str | Column) -> Column:
    """A name without case, spaces and punctuation."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def _kind(pos: str) -> Column:
    """The synset letter of a part of speech as typed; satellites count as adjectives, what is none of the four as noun."""
    p = F.lower(F.trim(F.coalesce(F.col(pos), F.lit(""))))
    return F.when(p.rlike("^adv|^r$"), "r").when(p.rlike("^adj|^a$|^s$"), "a").when(p.rlike("verb|^v|phr.*v"), "v").otherwise("n")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = load(spark, sf_dir, "entries", "id", "headword", "pos").where("id is not null").groupBy(F.col("id").alias("entry_id")).agg(F.min(_bare("headword")).alias("name"), F.min(_kind("pos")).alias("kind"))
    senses = load(spark, sf_dir, "senses", "id", "entry_id", "definition").select("id", "entry_id", terms_column("definition").alias("terms"))
    index = senses.join(entries, "entry_id", "left").select("id", "terms", "name", "kind")
    queries = load(spark, sf_dir, "wn_synset", "synset_id", "definition", "lemmas", "pos").select(
        F.col("synset_id").alias("id"), terms_column("definition").alias("terms"), F.transform(F.split("lemmas", r"\|"), _bare).alias("names"), _kind("pos").alias("kind")
    )
    tied = (
        load(spark, sf_dir, "unified_senses", "id", "cambridge_sense_id")
        .where("cambridge_sense_id is not null")
        .join(load(spark, sf_dir, "unified_sense_wordnet_links", "unified_sense_id", "wordnet_id").withColumnRenamed("unified_sense_id", "id"), "id")
        .select(F.col("cambridge_sense_id").alias("index_id"), F.col("wordnet_id").alias("query_id"))
    )
    return matched(index, queries, tied)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select(F.col("index_id").alias("sense_id"), F.col("query_id").alias("wordnet_id"))


def p4_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The found pairs with score and confidence."""
    return pairs(spark, sf_dir).select(F.col("index_id").alias("sense_id"), F.col("query_id").alias("wordnet_id"), F.round("score", 6).alias("score"), F.round("confidence", 6).alias("confidence"))


QUERIES = {"p4_found": p4_found, "p4_confidence": p4_confidence}
SQL: dict[str, str] = {}
