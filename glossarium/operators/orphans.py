"""References to records that do not exist: direct orphans, and the rows that inherit them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarium.operators.skew import salted_lookup, union_all
from glossarium.session import cut

DIRECT, INHERITED = "direct", "inherited"


@dataclass(frozen=True)
class ForeignKey:
    """`child`.`column` refers to `parent`.`parent_key`."""

    child: str
    column: str
    parent: str
    parent_key: str = "id"

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}"


@dataclass(frozen=True)
class Keyed:
    """A table with the expression that names a row and, if it has one, its load time."""

    frame: DataFrame
    row_key: Column
    loaded_at: str | None = None


def missing_references(tables: Mapping[str, Keyed], key: ForeignKey) -> DataFrame:
    """(row_key, missing_key) of the rows whose reference is not null and names no row of the parent.

    A row that is delivered several times counts once. Null references are no orphans. An empty parent makes
    every reference an orphan, an empty child gives no rows. The distinct references are formed first, with
    partial aggregation, and only those are compared with the parent; the rows of the missing keys are then
    found by a salted join, as a single dangling key may hold a large part of the rows.
    """
    child = tables[key.child]
    rows = child.frame.select(child.row_key.alias("row_key"), F.col(key.column).alias("missing_key")).where("missing_key is not null")
    present = tables[key.parent].frame.select(F.col(key.parent_key).alias("missing_key"))
    missing = rows.select("missing_key").distinct().join(present, "missing_key", "left_anti")
    return salted_lookup(rows, missing, ["missing_key"], ["row_key"], "left_semi").select("row_key", "missing_key").distinct()


def _order(keys: Sequence[ForeignKey]) -> list[str] | None:
    """Tables so that parents come before children, or None where the references run in a circle."""
    names = list(dict.fromkeys([k.parent for k in keys] + [k.child for k in keys]))
    done: list[str] = []
    while len(done) < len(names):
        ready = [n for n in names if n not in done and all(k.parent in done for k in keys if k.child == n)]
        if not ready:
            return None
        done += ready
    return done


def _step(tables: Mapping[str, Keyed], key: ForeignKey, parents: DataFrame) -> DataFrame:
    """Rows of the child that refer to one of the given parent keys (as text)."""
    child = tables[key.child]
    rows = child.frame.select(child.row_key.alias("row_key"), F.col(key.column).cast("string").alias("ref")).where("ref is not null")
    hit = salted_lookup(rows, parents.select(F.col("row_key").alias("ref")).distinct(), ["ref"], ["row_key"], "left_semi")
    return hit.select(F.lit(key.child).alias("source_table"), F.col("row_key"), F.lit(key.name).alias("reference"), F.lit(INHERITED).alias("kind"), F.lit(None).cast("string").alias("missing_key")).distinct()


def orphan_cascade(tables: Mapping[str, Keyed], keys: Sequence[ForeignKey]) -> DataFrame:
    """(source_table, row_key, reference, kind, missing_key): every orphan reference, direct or inherited.

    A row whose own reference is missing is a direct orphan; a row that refers to an orphan of either kind is
    an inherited one. Semi-joins run down the foreign-key graph: in the order of the graph where it has no
    circle, which is one lazy plan, otherwise round by round, each round only from the rows found last, until
    a round finds nothing new, which ends as no reference is found twice. A row may be listed once per reference.
    The parent's row_key must be the text of the key that its children name. missing_key is the text of the key that
    has no row, null for inherited orphans.
    """
    direct = {
        k.name: missing_references(tables, k).select(F.lit(k.child).alias("source_table"), F.col("row_key"), F.lit(k.name).alias("reference"), F.lit(DIRECT).alias("kind"), F.col("missing_key").cast("string").alias("missing_key"))
        for k in keys
    }
    order = _order(keys)
    if order is not None:
        found: dict[str, list[DataFrame]] = {n: [] for n in order}
        for name in order:
            for k in (k for k in keys if k.child == name):
                found[name].append(direct[k.name])
                if found[k.parent]:
                    found[name].append(_step(tables, k, union_all(found[k.parent])))
        return union_all([f for frames in found.values() for f in frames])
    known = frontier = cut(union_all(list(direct.values())))
    while True:
        steps = [_step(tables, k, frontier.where(F.col("source_table") == k.parent)) for k in keys]
        frontier = cut(union_all(steps).distinct().join(known, ["source_table", "row_key", "reference"], "left_anti"))
        if frontier.isEmpty():
            return known
        known = known.unionByName(frontier)


def orphan_report(tables: Mapping[str, Keyed], keys: Sequence[ForeignKey]) -> DataFrame:
    """(source_table, reference, month, kind, orphan_rows): orphans per table and month of the row's first load.

    Months are `yyyy-MM`; rows without a load time come under null.
    """
    orphans = orphan_cascade(tables, keys)
    loads = []
    for name in dict.fromkeys(k.child for k in keys):
        t = tables[name]
        month = F.date_format(F.min(t.loaded_at), "yyyy-MM") if t.loaded_at else F.lit(None).cast("string")
        loads.append(t.frame.groupBy(t.row_key.alias("row_key")).agg(month.alias("month")).withColumn("source_table", F.lit(name)))
    return (
        orphans.join(union_all(loads), ["source_table", "row_key"])
        .groupBy("source_table", "reference", "month", "kind")
        .agg(F.count(F.lit(1)).alias("orphan_rows"))
    )
