"""Duplicates hidden by formatting: commutative fingerprints of a record's fields, verified without sorting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarium.operators.skew import salt_of
from glossarium.session import cut

#: What separates the parts of a value, and what counts within a part.
SEPARATORS = "[,;/|]"
IGNORED = r"[^\p{L}\p{N}]"
#: Each pair's hash gives 40 bits, so that the sum over up to 8 million pairs stays within a bigint.
_SHIFT = 24


def field_pairs(fields: Sequence[str]) -> Column:
    """array<struct<field, value>>: one pair per non-empty part of each field, brought to lower case letters and digits."""
    def of(field: str) -> Column:
        parts = F.transform(F.split(F.lower(F.coalesce(F.col(field), F.lit(""))), SEPARATORS), lambda p: F.regexp_replace(p, IGNORED, ""))
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.struct(F.lit(field).alias("field"), p.alias("value")))

    pairs = [of(f) for f in fields]
    return F.concat(*pairs) if len(pairs) > 1 else pairs[0]


def _sum_of_hashes(pairs: str, seed: int) -> Column:
    return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda acc, p: acc + F.shiftrightunsigned(F.xxhash64(F.lit(seed), p["field"], p["value"]), _SHIFT))


def _same_pairs(a: str, b: str) -> Column:
    """Whether two pair arrays are the same multiset, by counting, without sorting."""
    counts = lambda x, p: F.size(F.filter(x, lambda q: q == p))
    return (F.col(a) == F.col(b)) | ((F.size(a) == F.size(b)) & F.forall(a, lambda p: counts(a, p) == counts(b, p)))


def hidden_copies(rows: DataFrame, row_id: str, scope: Sequence[str], fields: Sequence[str], salts: int = 16) -> DataFrame:
    """(scope..., keep_id, copy_id): one row per record that repeats an earlier one of its scope up to formatting.

    Records are equal when the multisets of their (field, part) pairs are: letter case, everything but letters
    and digits, and the order of parts separated by , ; / | do not count; accents do. The pairs are hashed and
    the hashes summed, which gives the same fingerprint in any order. keep_id is the smallest id of a group.
    Records without any letter or digit, with a null id or with a null in the scope equal nothing. An id that
    comes several times counts once per fingerprint. Columns other than the named ones are ignored.

    Rows are spread by (fingerprint, salt of the id), so a fingerprint that holds a third of all records is
    worked on by `salts` tasks; its smallest id comes from at most `salts` partial results. Equal fingerprints
    are then verified pair by pair; records that only share the fingerprint are compared by the pairs themselves.
    """
    scope = list(scope)
    key = [*scope, "__f1", "__f2", "__n"]
    base = (
        rows.select(F.col(row_id).alias("__id"), *scope, *fields)
        .withColumn("__pairs", field_pairs(fields))
        .where(F.col("__id").isNotNull() & (F.size("__pairs") > 0))
        .where(" and ".join([f"`{s}` is not null" for s in scope]) or "true")
        .withColumns({"__f1": _sum_of_hashes("__pairs", 1), "__f2": _sum_of_hashes("__pairs", 2), "__n": F.size("__pairs")})
        .withColumn("__salt", salt_of("__id", salts=salts))
        .select("__id", *key, "__salt", "__pairs")
    )
    partial = base.groupBy(*key, "__salt").agg(F.min("__id").alias("__low"), F.max("__id").alias("__high"), F.min_by("__pairs", "__id").alias("__first"))
    groups = (
        partial.groupBy(*key)
        .agg(F.min("__low").alias("keep_id"), F.max("__high").alias("__top"), F.min_by("__first", "__low").alias("__kept"), F.collect_set("__salt").alias("__salts"))
        .where("keep_id < __top")
        .select(*key, "keep_id", "__kept", F.explode("__salts").alias("__salt"))
    )
    same = _same_pairs("__pairs", "__kept")
    found = cut(
        base.join(groups, [*key, "__salt"])
        .where("__id <> keep_id")
        .select(*scope, "keep_id", F.col("__id").alias("copy_id"), same.alias("__same"), F.when(~same, F.col("__pairs")).alias("__pairs"))
    )
    collided = found.where("not __same").select(*scope, F.col("copy_id").alias("__id"), F.array_sort("__pairs").alias("__exact"))
    lowest = collided.groupBy(*scope, "__exact").agg(F.min("__id").alias("keep_id"))
    rest = collided.join(lowest, [*scope, "__exact"]).where("__id <> keep_id").select(*scope, "keep_id", F.col("__id").alias("copy_id"))
    return found.where("__same").select(*scope, "keep_id", "copy_id").unionByName(rest).distinct()


def copy_counts(copies: DataFrame, scope: Sequence[str]) -> DataFrame:
    """(scope..., keep_id, copies): how many records each kept one stands for, itself included; only groups of two or more."""
    return copies.groupBy(*scope, "keep_id").agg((F.count(F.lit(1)) + 1).alias("copies"))
