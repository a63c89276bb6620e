"""Joins and groupings that keep their shape when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__salt"


def salt_of(*columns: str | Column, salts: int) -> Column:
    """A salt that depends on the row only, so a retried task gives the same one."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def salted_lookup(rows: DataFrame, lookup: DataFrame, on: list[str], row_id: list[str], how: str = "inner", salts: int = 8) -> DataFrame:
    """rows joined to a lookup with at most one row per key.

    The lookup is repeated once per salt and the rows of one key are spread over the salts, so a key that
    holds a third of all rows is worked on by `salts` tasks. Nothing is broadcast, as neither side has a
    bound. Keys that are null match nothing.
    """
    left = rows.withColumn(SALT, salt_of(*row_id, salts=salts))
    right = lookup.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, SALT], how).drop(SALT)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name of frames with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """df in as many partitions as a shuffle has, also where few bytes would be coalesced; for work that costs much per row."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n, *(columns or df.columns))
