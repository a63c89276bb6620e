"""Batches of tasks: fixed size, or balanced by longest processing time first."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarium.operators.relational import ranked

#: Tasks of one balancing group; larger inputs are balanced in several groups of similar weight.
GROUP = 50_000


def chunks(df: DataFrame, order: Sequence[str], size: int, name: str = "chunk") -> DataFrame:
    """df with 0-based numbers of chunks of `size` rows in the given order."""
    return ranked(df, [], order, "__r").withColumn(name, F.floor((F.col("__r") - 1) / size)).drop("__r")


def difficulty(n_left: str | Column, n_right: str | Column, method: str = "mul") -> Column:
    """Cost of a task with so many candidates on both sides: their product or their sum."""
    left, right = (F.col(c) if isinstance(c, str) else c for c in (n_left, n_right))
    if method == "mul":
        return left * right
    if method == "add":
        return left + right
    raise ValueError(f"no such method: {method}")


def token_difficulty(prompt: str | Column, vocabulary: str | None = None) -> Column:
    """Cost of a rendered task in tokens of a public rank file; without one, words and signs are counted."""
    if vocabulary is None:
        return F.size(F.regexp_extract_all(prompt, F.lit(r"([\p{L}\p{N}]+|[^\s\p{L}\p{N}])"), 1))

    def count(texts: pd.Series) -> pd.Series:
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encode = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return texts.map(lambda t: len(encode(t)) if t else 0)

    return F.pandas_udf(count, "int")(prompt)


def assign_longest_first(weights: Sequence[tuple[float, str]], batch: int) -> dict[str, int]:
    """Bin of each (weight, id): heaviest first, equal weights by larger id first, always to the least loaded bin, the
    lowest number in a tie; as many bins as full batches would need."""
    n = -(-len(weights) // batch)
    bins = [(0.0, i) for i in range(n)]
    out: dict[str, int] = {}
    for weight, ident in sorted(weights, reverse=True):
        load, i = heapq.heappop(bins)
        out[ident] = i
        heapq.heappush(bins, (load + weight, i))
    return out


def balanced_batches(tasks: DataFrame, ident: str, weight: str, batch: int, group: int = GROUP) -> DataFrame:
    """(id, weight, batch): tasks spread over batches of nearly equal weight, `batch` tasks in each on average.

    Up to `group` tasks are one group with the exact rule of assign_longest_first. More are dealt, in order of weight,
    into groups of at most that many tasks and balanced within each, so no task of the cluster holds them all; batch
    numbers continue from group to group.
    """
    if group % batch:
        raise ValueError("the group size must be a multiple of the batch size")
    order = ranked(tasks.select(F.col(ident).alias("id"), F.col(weight).cast("double").alias("weight")), [], ["weight", "id"], "__r")
    groups = F.greatest(F.ceil(F.lit(tasks.count()) / group), F.lit(1))
    dealt = order.withColumn("__g", F.pmod(F.col("__r") - 1, groups)).drop("__r")
    kind = dict(dealt.dtypes)["id"]

    def balance(rows: pd.DataFrame) -> pd.DataFrame:
        bins = assign_longest_first(list(zip(rows["weight"], rows["id"])), batch)
        base = int(rows["__g"].iloc[0]) * (group // batch)
        return pd.DataFrame({"id": rows["id"], "weight": rows["weight"], "batch": [base + bins[i] for i in rows["id"]]})

    return dealt.groupBy("__g").applyInPandas(balance, f"id {kind}, weight double, batch bigint")


def batch_report(batches: DataFrame) -> DataFrame:
    """One row: number of batches and the least, largest, mean and (population) deviation of tasks and weight per batch."""
    each = batches.groupBy("batch").agg(F.count(F.lit(1)).alias("tasks"), F.sum("weight").alias("load"))
    stats = [f(c).alias(f"{n}_{c}") for c in ("tasks", "load") for n, f in (("min", F.min), ("max", F.max))]
    stats += [F.round(f(c), 6).alias(f"{n}_{c}") for c in ("tasks", "load") for n, f in (("avg", F.avg), ("std", F.stddev_pop))]
    return each.agg(F.count(F.lit(1)).alias("batches"), *stats)
