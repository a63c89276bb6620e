"""Problem 7: document texts in containers of a fixed number of tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossarium.llm.packing import packed, token_counts, usage
from glossarium.operators.skew import union_all
from glossarium.session import cut
from glossarium.sources.tables import load

CAPACITIES = (512, 2048, 8192)


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(load(spark, sf_dir, "documents", "doc_id", "text"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_sizes(spark, sf_dir), 2048)


def p7_containers_512(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_sizes(spark, sf_dir), 512)


def p7_containers_8192(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_sizes(spark, sf_dir), 8192)


def p7_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and unused space for every capacity."""
    sizes = cut(_sizes(spark, sf_dir))
    return union_all([usage(packed(sizes, c), c) for c in CAPACITIES])


QUERIES = {"p7_containers": p7_containers, "p7_containers_512": p7_containers_512, "p7_containers_8192": p7_containers_8192, "p7_usage": p7_usage}
SQL: dict[str, str] = {}
