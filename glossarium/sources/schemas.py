"""Schemas of the stored tables, and checks of what they may hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


DDL = {
    "words": "id bigint, word string, display_form string, entry_type string, status string, crawled_at timestamp, error_msg string",
    "entries": "id bigint, word_id bigint, entry_order int, headword string, pos string, grammar string, pronunciation_uk string, pronunciation_us string, audio_uk_url string, audio_us_url string, dictionary_source string",
    "entry_inflections": "id bigint, entry_id bigint, form_type string, inflected_form string",
    "senses": "id bigint, entry_id bigint, sense_order int, guideword string, definition string, cefr_level string, grammar string, domain string, labels string, phrase_title string",
    "sense_synonyms": "id bigint, sense_id bigint, synonym string, slug string, is_antonym int, target_sense_id bigint",
    "examples": "id bigint, sense_id bigint, example_order int, example string, is_extra int, collocation string",
    "collocations": "id bigint, word_id bigint, collocation string, example string, source string",
    "topics": "id bigint, slug string, title string, url string",
    "word_topics": "word_id bigint, topic_id bigint",
    "word_alternatives": "word_id bigint, alternative_word string, alternative_type string",
    "temp_redirects": "word_id bigint, pos string, definition string",
    "unified_senses": "id bigint, word string, pos string, definition string, cambridge_sense_id bigint",
    "unified_sense_wordnet_links": "unified_sense_id bigint, wordnet_id string",
    "response_cache": "key string, content string",
    "word_pos_alignment_status": "word string, pos string, status string",
    "conceptnet_sense_mappings": "conceptnet_uri string, wordnet_id string",
    "conceptnet_relations": "start_concept string, relation string, end_concept string, weight double",
    "wordnet_sentiment": "wordnet_id string, pos_score double, neg_score double, obj_score double",
}
# What enumerated columns may hold; null is always allowed.
ALLOWED = {
    "entry_type": ("word", "phrasal_verb", "idiom", "phrase", "expression"),
    "pos": ("noun", "verb", "adjective", "adverb", "other"),
    "form_type": ("plural", "past_tense", "past_participle", "present_participle", "third_person_singular"),
    "source": ("dictionary", "wordnet", "conceptnet"),
    "cefr_level": ("A1", "A2", "B1", "B2", "C1", "C2"),
}


def schema(name: str) -> T.StructType:
    return _schema(DDL[name])


def violations(df: DataFrame, table: str, unique: tuple[str, ...] = (), required: tuple[str, ...] = ()) -> DataFrame:
    """(table_name, rule, n): how many rows break each rule: allowed values, required columns, unique keys."""
    found = [df.where(F.col(c).isNotNull() & ~F.col(c).isin(*v)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{c} allowed").alias("rule"), "n") for c, v in ALLOWED.items() if c in df.columns]
    found += [df.where(F.col(c).isNull()).agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{c} required").alias("rule"), "n") for c in required]
    if unique:
        repeated = df.groupBy(*unique).agg((F.count(F.lit(1)) - 1).alias("k")).agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"))
        found.append(repeated.select(F.lit(f"{', '.join(unique)} unique").alias("rule"), "n"))
    return reduce(lambda a, b: a.unionByName(b), found).select(F.lit(table).alias("table_name"), "rule", "n")
