"""Order-dependent logic expressed as aggregates, ranks and keyed joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossarium.session import cut

_PID, _LOCAL, _OFFSET = "__pid", "__local", "__offset"


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """df with the 1-based place of each row among the rows of its keys (of all rows where there are none).

    Rows are range-partitioned by keys and order, numbered inside each partition, and shifted by the counts of the
    partitions before, so neither a hot key nor a ranking without keys ends in one task. `order` should be total.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = cut(df.repartitionByRange(n, *keys, *order).withColumn(_PID, F.spark_partition_id()))
    before = W.partitionBy(*[F.col(k) for k in keys]).orderBy(_PID).rowsBetween(W.unboundedPreceding, -1)
    counts = placed.groupBy(*keys, _PID).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(_OFFSET, F.coalesce(F.sum("__n").over(before), F.lit(0))).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(_PID).alias("__p"), _OFFSET)
    local = placed.withColumn(_LOCAL, F.row_number().over(W.partitionBy(_PID, *keys).orderBy(*order)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], F.col(_PID) == F.col("__p"))
    return local.join(offsets, same).withColumn(name, F.col(_LOCAL) + F.col(_OFFSET)).select(*df.columns, F.col(name).cast("bigint").alias(name))


def surrogate_ids(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """df with ids 1, 2, ... in the given order."""
    return ranked(df, [], order, name)


def unique_slugs(df: DataFrame, slug: str, order: str, name: str = "unique_slug") -> DataFrame:
    """df with every slug made unique: the first of equal ones keeps it, the next get `-1`, `-2`, ...

    A suffixed slug that is also another row's own slug is numbered on, among the rows of the family only (slugs that
    are equal without trailing numbers); families in which nothing clashes, which is nearly all, need no second pass.
    """
    first = ranked(df, [slug], [order], "__r").withColumn(name, F.when(F.col("__r") == 1, F.col(slug)).otherwise(F.concat(slug, F.lit("-"), (F.col("__r") - 1).cast("string"))))
    first = cut(first.withColumn("__family", F.regexp_replace(slug, r"(-\d+)+$", "")))
    clash = first.groupBy(name).agg(F.count(F.lit(1)).alias("__n"), F.first("__family").alias("__family")).where("__n > 1").select("__family").distinct()
    calm = first.join(clash, "__family", "left_anti").select(*df.columns, name)
    schema = first.join(clash, "__family", "left_semi").select(*df.columns, name).schema

    def settle(rows):
        taken: set[str] = set()
        upto: dict[str, int] = {}
        out = []
        rows = rows.sort_values(order, kind="stable")
        for s in rows[slug]:
            k = upto.get(s, 0)
            candidate = s if k == 0 and s not in taken else None
            while candidate is None:
                k += 1
                candidate = f"{s}-{k}" if f"{s}-{k}" not in taken else None
            taken.add(candidate)
            upto[s] = max(k, 0)
            out.append(candidate)
        return rows.assign(**{name: out})[[f.name for f in schema]]

    return calm.unionByName(first.join(clash, "__family", "left_semi").groupBy("__family").applyInPandas(settle, schema))


def first_nonempty(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str) -> DataFrame:
    """Per key the first value of each column, in the given order, that is neither null nor empty."""
    pick = lambda c: F.min_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(order))).alias(c)
    full = lambda c: F.when(F.max(F.coalesce(F.col(c), F.lit("")) != ""), pick(c)).alias(c)
    return df.groupBy(*keys).agg(*[full(c) for c in columns])


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """One row per key: the first in the order, or the last; partial aggregation keeps one row per key and task."""
    value = F.struct(*order, *[c for c in df.columns if c not in order and c not in keys])
    best = (F.max_by if last else F.min_by)(value, F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("__v")).select(*keys, "__v.*").select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], replace: bool = True) -> DataFrame:
    """old with the rows of new: rows of equal key are replaced, or with replace=False kept."""
    if replace:
        return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)
    return old.unionByName(new.join(old.select(*keys).distinct(), list(keys), "left_anti"))


def unordered_pairs(df: DataFrame, a: str, b: str, order: str) -> DataFrame:
    """One row per unordered pair, the first in the order."""
    low, high = F.least(a, b), F.greatest(a, b)
    return keep_one(df.withColumns({"__a": low, "__b": high}), ["__a", "__b"], [order]).drop("__a", "__b")


def lookup_either(df: DataFrame, value: str, table: DataFrame, columns: Sequence[str], result: str) -> DataFrame:
    """df joined to the table where one of its columns equals the value, the smallest `result` of several.

    A union of equi-joins, one per column, instead of a join on a disjunction.
    """
    hits = reduce(lambda x, y: x.unionByName(y), [table.where(F.col(c).isNotNull()).select(F.col(c).alias(value), F.col(result)) for c in columns])
    return df.join(hits.groupBy(value).agg(F.min(result).alias(result)), value, "left")


def share_of_total(counts: DataFrame, n: str, name: str = "pct", digits: int = 2) -> DataFrame:
    """counts with each row's percentage of the sum, rounded half to even; the total is a scalar subquery."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(name, F.bround(F.lit(100.0) * F.col(n) / total, digits))


def describe(df: DataFrame, value: str) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles and maximum of a numeric column."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.agg(
        F.count(value).alias("n"),
        F.round(F.avg(value), 6).alias("mean"),
        F.round(F.stddev_samp(value), 6).alias("std"),
        F.min(value).alias("min"),
        q.alias("q"),
        F.max(value).alias("max"),
    ).select("n", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n) of every table."""
    return reduce(lambda x, y: x.unionByName(y), [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()])


def in_order(df: DataFrame, column: str, order: Sequence[str], name: str = "place") -> DataFrame:
    """df with the 1-based place of a value in a fixed order; values outside it come last, with null."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))
    return df.withColumn(name, F.when(place > 0, place))


def contained_pairs(sets: DataFrame, ident: str, tokens: str, jaccard: float = 0.6, least_length: int = 3, stop: Sequence[str] = ()) -> DataFrame:
    """(small, large, jaccard): pairs of different token sets of which one contains the other, of that similarity or more,
    that share a token of `least_length` letters which is no stop word.

    As the smaller set lies in the larger one, its rarest telling token does too: a set is entered once as smaller,
    under that token, and once per telling token as larger. Sets without telling tokens match nothing.
    """
    telling = F.filter(F.array_distinct(tokens), lambda t: (F.length(t) >= least_length) & ~t.isin(*stop) if stop else F.length(t) >= least_length)
    base = sets.select(F.col(ident).alias("__id"), F.array_distinct(tokens).alias("__t"), telling.alias("__w"))
    words = base.select("__id", "__t", F.explode("__w").alias("__token"))
    counts = words.groupBy("__token").agg(F.count(F.lit(1)).alias("__df"))
    rare = words.join(counts, "__token").groupBy("__id").agg(F.min(F.struct("__df", "__token"))["__token"].alias("__token"), F.first("__t").alias("__t"))
    a = rare.select(F.col("__id").alias("small"), "__token", F.col("__t").alias("ta"))
    b = words.select(F.col("__id").alias("large"), "__token", F.col("__t").alias("tb"))
    na, nb = F.size("ta"), F.size("tb")
    fits = (F.col("small") != F.col("large")) & (na <= nb) & (na >= nb * jaccard - 1e-9) & ((na < nb) | (F.col("small") < F.col("large")))
    return a.join(b, "__token").where(fits & (F.size(F.array_intersect("ta", "tb")) == na)).select("small", "large", (na / nb).alias("jaccard"))


def nearest(sources: DataFrame, targets: DataFrame, ident: str, vector: str) -> DataFrame:
    """(source, target, sim): for each source the other target of largest dot product, the smaller id in a tie.

    sources is a stated query set, held against all targets in blocks: targets stay where they are, the (bounded)
    sources go to them, and each task gives one winner per source before the shuffle. Both are counted first.
    """
    from glossarium.functions.text import dot

    limit = 100_000
    if sources.limit(limit + 1).count() > limit:
        raise ValueError(f"nearest takes at most {limit} query vectors at a time")
    s = sources.select(F.col(ident).alias("source"), F.col(vector).alias("__sv"))
    t = targets.select(F.col(ident).alias("target"), F.col(vector).alias("__tv"))
    scored = t.join(F.broadcast(s), F.col("source") != F.col("target")).select("source", "target", dot("__sv", "__tv").alias("sim"))
    best = scored.groupBy("source").agg(F.max_by("target", F.struct("sim", -F.col("target"))).alias("target"), F.max("sim").alias("sim"))
    return best
