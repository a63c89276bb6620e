"""Problem 2: freely typed parts of speech, form types and synonyms, mapped to the reference terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.llm.canonical import canonical_terms
from glossarium.operators.skew import salted_lookup, union_all
from glossarium.sources.tables import load

FIELDS = (("entries", "pos", "pos"), ("entry_inflections", "form_type", "form_type"), ("sense_synonyms", "synonym", "synonym"))
ABBREVIATED = ("pos", "form_type")


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_table, row_id, kind, value, term_id) of every row whose value is not null and not literally in the list."""
    rows = union_all([load(spark, sf_dir, t, "id", c).select(F.lit(t).alias("source_table"), F.col("id").alias("row_id"), F.lit(k).alias("kind"), F.col(c).alias("value")) for t, c, k in FIELDS])
    terms = load(spark, sf_dir, "canonical_terms")
    listed = terms.select("kind", F.col("canonical").alias("value")).distinct()
    distinct = rows.where("value is not null").select("kind", "value").distinct().join(listed, ["kind", "value"], "left_anti")
    found = canonical_terms(distinct, terms, ABBREVIATED)
    return salted_lookup(rows, found, ["kind", "value"], ["source_table", "row_id"]).distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(spark, sf_dir).select("source_table", "row_id", "term_id")


def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of no reference term, with the number of rows that have them."""
    return mapped(spark, sf_dir).where("term_id = 0").groupBy("source_table", "value").agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {"p2_found": p2_found, "p2_unmatched": p2_unmatched}
SQL: dict[str, str] = {}
