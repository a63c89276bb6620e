"""Filling containers of fixed capacity with texts: non-negative least squares over shallow combinations of lengths.

Only the histogram of lengths, which has at most `capacity` rows, reaches the driver. There, combinations of up to
three length classes that fill the window are enumerated and their repeat counts solved against the histogram by
non-negative least squares, rounded down and turned into patterns of exact lengths. What is left over is packed
greedily, longest first, into the tightest open pattern, still as counts of equal containers. The result is a list
of patterns with repeat counts; every text then finds its container by its rank among the texts of its length.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossarium.session import cut

#: The lengths are put into so many classes of equal width for the least squares.
CLASSES = 128
RANKED_IN = 64


def default_vocabulary() -> str:
    """Path of the installed public vocabulary; any rank file of the same form may be given instead."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_counts(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens): the size of each whole text in tokens of the rank file; null texts have 0."""
    path = vocabulary or default_vocabulary()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encode = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": [len(encode(t)) if t else 0 for t in batch["text"]]})

    return documents.where("doc_id is not null").select("doc_id", "text").mapInPandas(count, "doc_id bigint, n_tokens bigint")


@dataclass
class Pattern:
    """So many containers alike: how many items of each length each of them holds, and the space left in each."""

    copies: int
    gap: int
    holds: dict[int, int] = field(default_factory=dict)


def _combinations(classes: int) -> np.ndarray:
    """Columns: up to three classes 1..classes that add up to `classes`."""
    columns = []
    for a in range(classes, 0, -1):
        for b in range(min(a, classes - a), -1, -1):
            c = classes - a - b
            if c <= b:
                column = np.zeros(classes + 1)
                for x in (a, b, c):
                    column[x] += 1
                columns.append(column[1:])
    return np.array(columns).T


def _least_squares(matrix: np.ndarray, target: np.ndarray, rounds: int = 1500) -> np.ndarray:
    """Non-negative x with the least squared distance of matrix @ x from target: projected gradient with momentum."""
    step = 1 / np.linalg.norm(matrix, 2) ** 2
    x = y = np.zeros(matrix.shape[1])
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(y - step * (matrix.T @ (matrix @ y - target)), 0)
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = nxt + (t - 1) / s * (nxt - x)
        x, t = nxt, s
    return x


def _take(left: dict[int, int], lengths: list[int], n: int, longest_first: bool) -> list[tuple[int, int]]:
    """n items out of the lengths of one class, as (length, count)."""
    out = []
    for length in sorted(lengths, reverse=longest_first):
        k = min(n, left.get(length, 0))
        if k:
            out.append((length, k))
            left[length] -= k
            n -= k
        if not n:
            break
    return out


def plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold exactly the items of the histogram (length 1..capacity to count)."""
    left = {n: c for n, c in histogram.items() if c > 0}
    patterns: list[Pattern] = []
    classes = min(CLASSES, capacity)
    width = -(-capacity // classes)
    of_class: dict[int, list[int]] = defaultdict(list)
    for n in left:
        of_class[-(-n // width)].append(n)
    matrix = _combinations(classes)
    total = np.array([sum(left[n] for n in of_class.get(c, ())) for c in range(1, classes + 1)], dtype=float)
    if total.any():
        weight = np.sqrt(np.arange(1, classes + 1) / classes)  # a long item without place costs more than a short one
        solved = _least_squares(matrix * weight[:, None], total / total.sum() * weight) * total.sum()
        free = total.copy()
        for j in np.argsort(-solved, kind="stable"):
            parts = np.flatnonzero(matrix[:, j])
            r = int(min([solved[j] + 1e-6, *(free[p] // matrix[p, j] for p in parts)]))
            if r < 1:
                continue
            rows: list[list[tuple[int, int]]] = []
            for place, p in enumerate(parts[::-1]):
                for _ in range(int(matrix[p, j])):
                    free[p] -= r
                    rows.append(_take(left, of_class[p + 1], r, longest_first=place % 2 == 0))
            patterns += _zip(rows, capacity)
    return _greedy(left, patterns, capacity)


def _zip(rows: list[list[tuple[int, int]]], capacity: int) -> list[Pattern]:
    """Lists of (length, count) of equal total, walked side by side."""
    out, at = [], [[0, row[0][1]] for row in rows]
    while True:
        k = min(a[1] for a in at)
        holds: dict[int, int] = defaultdict(int)
        for row, a in zip(rows, at):
            holds[row[a[0]][0]] += 1
        out.append(Pattern(k, capacity - sum(n * c for n, c in holds.items()), dict(holds)))
        for row, a in zip(rows, at):
            a[1] -= k
            if not a[1]:
                a[0] += 1
                if a[0] == len(row):
                    return out
                a[1] = row[a[0]][1]


def _greedy(left: dict[int, int], patterns: list[Pattern], capacity: int) -> list[Pattern]:
    """The left-over items, longest first, each into the tightest open containers; new ones are opened where none fits."""
    done: list[Pattern] = []
    order: list[tuple[int, int]] = []  # (gap, place)
    every: list[Pattern] = []

    def put(p: Pattern) -> None:
        if p.gap <= 0:
            done.append(p)
        elif p.copies:
            every.append(p)
            insort(order, (p.gap, len(every) - 1))

    for p in patterns:
        put(p)
    for n in sorted((n for n, c in left.items() if c), reverse=True):
        count = left[n]
        while count:
            at = bisect_left(order, (n, -1))
            p = every[order.pop(at)[1]] if at < len(order) else Pattern(-(-count // (capacity // n)), capacity)
            k = p.gap // n
            full = min(p.copies, count // k)
            rest = min(count - full * k, k - 1) if full < p.copies else 0
            used = [(full, k), (1 if rest else 0, rest), (p.copies - full - (1 if rest else 0), 0)]
            for copies, each in used:
                if copies:
                    put(Pattern(copies, p.gap - each * n, p.holds | {n: p.holds.get(n, 0) + each} if each else p.holds))
            count -= full * k + rest
    return done + [every[i] for _, i in order if every[i].holds]


def packed(sizes: DataFrame, capacity: int) -> DataFrame:
    """(container_id, doc_id, piece, n_tokens): every text in one container, or cut where it alone exceeds the capacity.

    sizes: doc_id, n_tokens. A text longer than the capacity gives pieces of the capacity and one rest; pieces
    count from 0. Texts of size 0 take no space and come in container 0. A doc_id that comes several times is
    packed as often. Ranks within a length are formed in RANKED_IN parts by hash with offsets, so a length that
    a large part of the texts has is not left to one task. The patterns are at most a few per length.
    """
    sizes = cut(sizes.select("doc_id", "n_tokens"))
    whole = F.floor(F.col("n_tokens") / capacity).cast("int")
    lengths = F.concat(F.array_repeat(F.lit(capacity).cast("bigint"), whole), F.when(F.col("n_tokens") % capacity > 0, F.array(F.col("n_tokens") % capacity)).otherwise(F.array().cast("array<bigint>")))
    pieces = sizes.where("n_tokens > 0").select("doc_id", F.posexplode(lengths).alias("piece", "length"))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    slots, base, start = [], 0, defaultdict(int)
    for p in plan(histogram, capacity):
        for n, k in p.holds.items():
            slots.append((n, start[n], start[n] + k * p.copies, base, k))
            start[n] += k * p.copies
        base += p.copies
    slots_df = sizes.sparkSession.createDataFrame(pd.DataFrame(slots, columns=["length", "first", "end", "base", "each"]), "length bigint, first bigint, end bigint, base bigint, each bigint")
    parted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANKED_IN)))
    offsets = (
        parted.groupBy("length", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("offset", F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
        .select("length", "part", F.coalesce("offset", F.lit(0)).alias("offset"))
    )
    ranked = (
        parted.withColumn("rank", F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "piece")) - 1)
        .join(offsets, ["length", "part"])
        .withColumn("rank", F.col("rank") + F.col("offset"))
    )
    placed = ranked.join(F.broadcast(slots_df), "length").where("rank >= first and rank < end")
    out = placed.select((F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))).alias("container_id"), "doc_id", "piece", F.col("length").alias("n_tokens"))
    empty = sizes.where("n_tokens <= 0").select(F.lit(0).cast("bigint").alias("container_id"), "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("n_tokens"))
    return out.unionByName(empty)


def usage(containers: DataFrame, capacity: int) -> DataFrame:
    """(capacity, containers, tokens, unused_share) of a packing."""
    each = containers.groupBy("container_id").agg(F.sum("n_tokens").alias("tokens"))
    total = each.agg(F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    return total.select(F.lit(capacity).alias("capacity"), "containers", "tokens", F.when(F.col("containers") > 0, 1 - F.col("tokens") / (F.col("containers") * capacity)).alias("unused_share"))
