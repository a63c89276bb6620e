"""Synonym strings resolved to the senses they mean: keys, rules, and vectors where the rules leave a tie."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarium.functions.keys import STOP_KEYS, match_keys_column
from glossarium.functions.text import WILDCARD_POS, dot, normalize_pos
from glossarium.operators.relational import contained_pairs, keep_one
from glossarium.operators.skew import salted_lookup
from glossarium.session import cut


def sense_keys(senses: DataFrame) -> DataFrame:
    """(key, pos, sense_id) of senses (sense_id, display_form, slug, pos): keys of the display form and of the slug."""
    names = senses.select("sense_id", normalize_pos("pos").alias("pos"), F.explode(F.array_distinct(F.array_compact(F.array("display_form", "slug")))).alias("name"))
    keyed = names.select("name").distinct().select("name", F.explode(match_keys_column("name")).alias("key"))
    return salted_lookup(names, keyed.groupBy("name").agg(F.collect_set("key").alias("keys")), ["name"], ["sense_id"]).select(F.explode("keys").alias("key"), "pos", "sense_id").distinct()


def compatible_pos(pos: str | Column, found: str | Column) -> Column:
    """Equal, or one of the two is a part of speech that goes with every other."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (pos, found))
    return (a == b) | b.isin(*WILDCARD_POS) | (a.isin(*WILDCARD_POS) & b.isin("n", "v", "a", "r"))


def close_keys(keys: DataFrame) -> DataFrame:
    """(key, other): keys of which one's words contain the other's, similar by 0.6 or more."""
    sets = keys.select("key").distinct().select("key", F.split("key", " ").alias("tokens"))
    pairs = contained_pairs(sets, "key", "tokens", 0.6, 3, sorted(STOP_KEYS))
    return pairs.select(F.col("small").alias("key"), F.col("large").alias("other")).unionByName(pairs.select(F.col("large").alias("key"), F.col("small").alias("other")))


def candidates(relations: DataFrame, index: DataFrame) -> DataFrame:
    """(relation_id, source_sense_id, sense_id): for relations (relation_id, source_sense_id, synonym, pos) every sense
    with the same key, or one close to it, and a compatible part of speech. Relations without part of speech have none."""
    asked = relations.select("relation_id", "source_sense_id", "synonym", normalize_pos("pos").alias("pos")).where("pos <> ''")
    keyed = asked.select("synonym").distinct().select("synonym", F.explode(match_keys_column("synonym")).alias("key"))
    both = keyed.select("key").unionByName(index.select("key")).distinct()
    reach = both.select("key", F.col("key").alias("other")).unionByName(close_keys(both)).join(index.select(F.col("key").alias("other")).distinct(), "other", "left_semi")
    found = keyed.join(reach, "key").select("synonym", "other").distinct()
    senses = index.select(F.col("key").alias("other"), F.col("pos").alias("found_pos"), "sense_id")
    hits = found.join(senses, "other").select("synonym", "found_pos", "sense_id").distinct()
    return asked.join(hits, "synonym").where(compatible_pos("pos", "found_pos")).select("relation_id", "source_sense_id", "sense_id").distinct()


def evidence(found: DataFrame, source_words: DataFrame, synonyms: DataFrame) -> DataFrame:
    """found with `mutual` (a key of the source's word is a key of one of the candidate's synonyms) and `overlap` (how many
    synonyms both have). source_words: sense_id, word; synonyms: sense_id, synonym in key form."""
    keyed = synonyms.select("synonym").distinct().select("synonym", F.explode(match_keys_column("synonym")).alias("key"))
    of_sense = synonyms.join(keyed, "synonym").select("sense_id", "key").distinct()
    words = source_words.select("word").distinct().select("word", F.explode(match_keys_column("word")).alias("key"))
    own = source_words.select(F.col("sense_id").alias("source_sense_id"), "word").join(words, "word").select("source_sense_id", "key").distinct()
    pairs = found.select("source_sense_id", "sense_id").distinct()
    mutual = pairs.join(own, "source_sense_id").join(of_sense, ["sense_id", "key"]).select("source_sense_id", "sense_id").distinct().withColumn("mutual", F.lit(True))
    mine = synonyms.select(F.col("sense_id").alias("source_sense_id"), "synonym")
    overlap = pairs.join(mine, "source_sense_id").join(synonyms, ["sense_id", "synonym"]).groupBy("source_sense_id", "sense_id").agg(F.count(F.lit(1)).alias("overlap"))
    at = ["source_sense_id", "sense_id"]
    return found.join(mutual, at, "left").join(overlap, at, "left").withColumns({"mutual": F.coalesce("mutual", F.lit(False)), "overlap": F.coalesce("overlap", F.lit(0).cast("bigint"))})


def best_candidates(judged: DataFrame, relation: str = "relation_id") -> DataFrame:
    """Of each relation the mutual candidates if there are any, of these the ones with most overlap, ties kept, with
    `needs_vectors`: several are left, or the one that is left has no evidence although there were others."""
    top = judged.groupBy(relation).agg(F.max(F.struct("mutual", "overlap")).alias("top"), F.count(F.lit(1)).alias("candidates"))
    kept = judged.join(top, relation).where((F.col("mutual") == F.col("top.mutual")) & (F.col("overlap") == F.col("top.overlap")))
    left = kept.groupBy(relation).agg(F.count(F.lit(1)).alias("left"))
    doubt = (F.col("left") > 1) | ((F.col("candidates") > 1) & ~F.col("mutual") & (F.col("overlap") == 0))
    return kept.join(left, relation).withColumn("needs_vectors", doubt).drop("top", "left")


def by_vectors(tied: DataFrame, vectors: DataFrame) -> DataFrame:
    """(relation_id, sense_id, sim): the candidate whose vector is nearest to the source's, the smaller id in a tie.
    vectors: sense_id, vector of length 1; candidates without one are never chosen."""
    v = vectors.select("sense_id", "vector")
    scored = tied.join(v.withColumnsRenamed({"sense_id": "source_sense_id", "vector": "sv"}), "source_sense_id").join(v, "sense_id").withColumn("sim", dot("sv", "vector"))
    return keep_one(scored.select("relation_id", "sense_id", "sim", (-F.col("sim")).alias("far")), ["relation_id"], ["far", "sense_id"]).select("relation_id", "sense_id", "sim")


def resolve(relations: DataFrame, senses: DataFrame, synonyms: DataFrame, encode: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(relation_id, sense_id, stage): the sense of each relation that could be resolved, by `single` candidate, `rule`, or
    `vector`. senses: sense_id, display_form, slug, pos, word. encode turns (sense_id) into (sense_id, vector)."""
    found = cut(candidates(relations, cut(sense_keys(senses))))
    judged = cut(best_candidates(cut(evidence(found, senses.select("sense_id", "word"), synonyms))))
    clear = judged.where("not needs_vectors").select("relation_id", "sense_id", F.when(F.col("candidates") == 1, "single").otherwise("rule").alias("stage"))
    if encode is None:
        return clear
    tied = judged.where("needs_vectors").select("relation_id", "source_sense_id", "sense_id")
    asked = tied.select(F.explode(F.array("source_sense_id", "sense_id")).alias("sense_id")).distinct()
    return clear.unionByName(by_vectors(tied, encode(asked)).select("relation_id", "sense_id", F.lit("vector").alias("stage")))


def write_back(synonyms: DataFrame, resolved: DataFrame) -> DataFrame:
    """sense_synonyms with the targets that were found; others keep theirs."""
    new = resolved.select(F.col("relation_id").alias("id"), F.col("sense_id").alias("__new"))
    return synonyms.join(new, "id", "left").withColumn("target_sense_id", F.coalesce("__new", "target_sense_id")).select(*synonyms.columns)


def stage_counts(relations: DataFrame, resolved: DataFrame, stages: Sequence[str] = ("single", "rule", "vector")) -> DataFrame:
    """(stage, n): relations by how they were resolved, the rest as unresolved."""
    joined = relations.select("relation_id").join(resolved.select("relation_id", "stage"), "relation_id", "left")
    return joined.groupBy(F.coalesce("stage", F.lit("unresolved")).alias("stage")).agg(F.count(F.lit(1)).alias("n"))
