"""Spelling variants: British entries moved to the American word, and the table of alternatives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarium.functions.redirects import redirect_type, region_of, target_candidates
from glossarium.functions.text import key_form, map_pos
from glossarium.operators.relational import keep_one


def word_keys(words: DataFrame) -> DataFrame:
    """(key, word_id): slugs and display forms in key form, with blanks and with hyphens; of equal keys the last word."""
    unescaped = lambda c: F.replace(F.replace(F.replace(F.replace(key_form(c), F.lit("&#39;"), F.lit("'")), F.lit("&quot;"), F.lit('"')), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))
    slug, display = unescaped("word"), unescaped("display_form")
    forms = F.array_compact(F.array(slug, F.regexp_replace(slug, "-", " "), display, F.regexp_replace(display, " ", "-")))
    return words.select(F.explode(F.array_distinct(forms)).alias("key"), "id").where("key <> ''").groupBy("key").agg(F.max("id").alias("word_id"))


def parsed_redirects(redirects: DataFrame, words: DataFrame, compat: bool = False) -> DataFrame:
    """(word_id, headword, pos, type, region, target): redirects (word_id, pos, definition) whose target is a known word.

    Of the readings of a target the first one that is a word counts; an arrow keeps its target also when it is none.
    """
    w = words.select(F.col("id").alias("word_id"), key_form(F.coalesce("display_form", "word")).alias("headword"))
    base = redirects.join(w, "word_id").select("word_id", "headword", map_pos("pos", compat).alias("pos"), redirect_type("definition").alias("type"), region_of("definition", compat).alias("region"), target_candidates("definition").alias("options")).where("type is not null").distinct()
    each = base.select("*", F.posexplode("options").alias("at", "option")).withColumn("option", key_form("option"))
    hit = each.join(word_keys(words).select(F.col("key").alias("option")).unionByName(word_keys(words).select(F.regexp_replace("key", "-", " ").alias("option"))).distinct(), "option", "left_semi")
    first = hit.groupBy("word_id", "headword", "pos", "type", "region", "options").agg(F.min_by("option", "at").alias("target"))
    arrows = base.where("type = 'arrow'").join(first.select("word_id", "options"), ["word_id", "options"], "left_anti").withColumn("target", key_form(F.get("options", 0)))
    columns = ["word_id", "headword", "pos", "type", "region", "target"]
    return first.select(*columns).unionByName(arrows.select(*columns)).where("target is not null")


def british_to_american(parsed: DataFrame) -> DataFrame:
    """(uk, pos, us): which word to use instead of which, the smallest of several; chains are followed to their end (two
    steps at most, as a word is American in one redirect and British in another only by mistake)."""
    spelling = parsed.where("type = 'UK spelling' and pos is not null and region is not null")
    uk, us = F.when(F.col("region") == "us", F.col("target")).otherwise(F.col("headword")), F.when(F.col("region") == "us", F.col("headword")).otherwise(F.col("target"))
    direct = spelling.select(uk.alias("uk"), "pos", us.alias("us")).where("uk <> us").groupBy("uk", "pos").agg(F.min("us").alias("us"))
    nxt = direct.select(F.col("uk").alias("us"), "pos", F.col("us").alias("further"))
    return direct.join(nxt, ["us", "pos"], "left").select("uk", "pos", F.when(F.col("further") != F.col("uk"), F.col("further")).otherwise(F.col("us")).alias("us"))


def moved_entries(entries: DataFrame, senses: DataFrame, words: DataFrame, mapping: DataFrame) -> DataFrame:
    """entries with those of a British word under the American word where both exist, without entries that have no
    senses."""
    keys = word_keys(words)
    ids = mapping.join(keys.select(F.col("key").alias("uk"), F.col("word_id").alias("uk_id")), "uk").join(keys.select(F.col("key").alias("us"), F.col("word_id").alias("us_id")), "us")
    move = ids.where("uk_id <> us_id").groupBy("uk_id").agg(F.min("us_id").alias("us_id"))
    kept = with_senses(entries, senses)
    return kept.join(move, kept["word_id"] == move["uk_id"], "left").withColumn("word_id", F.coalesce("us_id", "word_id")).select(*entries.columns)


def renamed_words(words: DataFrame, mapping: DataFrame) -> DataFrame:
    """words with the American form where only the British word exists."""
    keys = word_keys(words)
    only = mapping.join(keys.select(F.col("key").alias("uk"), F.col("word_id").alias("id")), "uk").join(keys.select(F.col("key").alias("us")), "us", "left_anti").groupBy("id").agg(F.min("us").alias("us"))
    out = words.join(only, "id", "left")
    return out.withColumns({"word": F.coalesce(F.regexp_replace("us", " ", "-"), "word"), "display_form": F.coalesce("us", "display_form")}).select(*words.columns)


def alternatives(parsed: DataFrame, mapping: DataFrame, words: DataFrame) -> DataFrame:
    """(word_id, alternative_word, alternative_type): what else each word is called, one type per pair, the first by name."""
    american = (F.col("type") == "UK spelling") & (F.col("region") == "us")
    sides = parsed.select("pos", "type", F.when(american, F.col("headword")).otherwise(F.col("target")).alias("base"), F.when(american, F.col("target")).otherwise(F.col("headword")).alias("alternative_word"))
    moved = sides.join(mapping.withColumnRenamed("uk", "base"), ["base", "pos"], "left").withColumn("base", F.coalesce("us", "base"))
    named = moved.join(word_keys(words).withColumnRenamed("key", "base"), "base").select("word_id", "alternative_word", F.col("type").alias("alternative_type"))
    return keep_one(named, ["word_id", "alternative_word"], ["alternative_type"])


def with_senses(entries: DataFrame, senses: DataFrame) -> DataFrame:
    """Entries that have a sense."""
    return entries.join(senses.select(F.col("entry_id").alias("id")).distinct(), "id", "left_semi")
