"""The consolidated lexicon: words, entries, inflections, senses, definitions, synonyms, examples, topics and relations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarium.functions.text import CEFR_LEVELS, CONCEPT_RELATIONS, SYNSET_RELATIONS, any_pos_enum, display_name, guess_entry_type, inflection_types, key_form, pos_compatible, pos_enum, slugify
from glossarium.operators.relational import first_nonempty, keep_one, surrogate_ids, unique_slugs
from glossarium.session import cut

DICTIONARY, LEXICON, CONCEPTS = "dictionary", "wordnet", "conceptnet"


def build_words(words: DataFrame, unified: DataFrame) -> DataFrame:
    """(id, slug, word, entry_type, source_word_id, key): dictionary words in order of id, then words that only unified
    senses have, by name. Equal slugs get numbers. `key` is how a word is looked up; of equal keys the last id counts."""
    own = words.select(F.col("id").alias("source_word_id"), display_name("display_form", "word").alias("word"), slugify("word").alias("slug"), "entry_type")
    own = keep_one(own, ["source_word_id"], ["word", "slug"]).withColumn("key", key_form("word"))
    new = unified.where("word is not null").select("word", any_pos_enum("pos").alias("pos"), key_form("word").alias("key")).join(own.select("key").distinct(), "key", "left_anti")
    new = keep_one(new, ["key"], ["word", "pos"]).select(F.lit(None).cast("bigint").alias("source_word_id"), "word", slugify("word").alias("slug"), guess_entry_type("word", "pos").alias("entry_type"), "key")
    every = own.withColumn("late", F.lit(0)).unionByName(new.withColumn("late", F.lit(1)))
    numbered = surrogate_ids(every, ["late", "source_word_id", "key"]).drop("late")
    return cut(unique_slugs(numbered, "slug", "id").select("id", F.col("unique_slug").alias("slug"), "word", "entry_type", "source_word_id", "key"))


def word_lookup(built: DataFrame) -> DataFrame:
    """(key, word_id)."""
    return built.groupBy("key").agg(F.max("id").alias("word_id"))


def build_entries(entries: DataFrame, built: DataFrame, unified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (id, word_id, pos, four sound columns) by word and part of speech, and the map (source_entry_id, entry_id).
    Sounds are the first that are filled, in order of the source entries; unified senses add entries without any."""
    sounds = ["pronunciation_uk", "pronunciation_us", "audio_uk_url", "audio_us_url"]
    w = built.where("source_word_id is not null").select(F.col("source_word_id").alias("word_id"), F.col("id").alias("final_word_id"))
    own = entries.join(w, "word_id").select(F.col("id").alias("source_entry_id"), F.col("final_word_id").alias("word_id"), pos_enum("pos").alias("pos"), *sounds)
    merged = first_nonempty(own, ["word_id", "pos"], sounds, "source_entry_id")
    asked = unified.select(key_form("word").alias("key"), any_pos_enum("pos").alias("pos")).join(word_lookup(built), "key").select("word_id", "pos").distinct()
    more = asked.join(merged.select("word_id", "pos"), ["word_id", "pos"], "left_anti").select("word_id", "pos", *[F.lit(None).cast("string").alias(c) for c in sounds])
    final = cut(surrogate_ids(merged.unionByName(more), ["word_id", "pos"]).select("id", "word_id", "pos", *sounds))
    return final, own.select("source_entry_id", "word_id", "pos").distinct().join(final.select("word_id", "pos", F.col("id").alias("entry_id")), ["word_id", "pos"]).select("source_entry_id", "entry_id")


def build_inflections(inflections: DataFrame, entry_map: DataFrame, built_entries: DataFrame) -> DataFrame:
    """(entry_id, form_type, inflected_form), each once; labels that are no inflection are left out."""
    e = entry_map.join(built_entries.select(F.col("id").alias("entry_id"), "pos"), "entry_id")
    rows = inflections.select(F.col("entry_id").alias("source_entry_id"), "form_type", "inflected_form").join(e, "source_entry_id")
    return rows.select("entry_id", F.explode(inflection_types("form_type", "pos")).alias("form_type"), "inflected_form").distinct()


def build_senses(unified: DataFrame, senses: DataFrame, built_entries: DataFrame, built_words: DataFrame) -> DataFrame:
    """(id, entry_id, word, pos, definition, cefr_level, guideword, grammar, domain, labels, source, unified_id,
    source_sense_id) of every unified sense in order of id; levels outside the scale become null."""
    meta = keep_one(senses.select(F.col("id").alias("source_sense_id"), "cefr_level", "guideword", "grammar", "domain", "labels", F.lit(True).alias("known")), ["source_sense_id"], ["cefr_level", "guideword", "grammar", "domain", "labels"])
    u = keep_one(unified.select(F.col("id").alias("unified_id"), "word", any_pos_enum("pos").alias("pos"), "definition", F.col("cambridge_sense_id").alias("source_sense_id")), ["unified_id"], ["word", "pos", "definition", "source_sense_id"])
    placed = u.withColumn("key", key_form("word")).join(word_lookup(built_words), "key").join(built_entries.select(F.col("id").alias("entry_id"), "word_id", "pos"), ["word_id", "pos"])
    full = placed.join(meta, "source_sense_id", "left")
    known = F.coalesce("known", F.lit(False))
    out = full.select(
        "unified_id", "entry_id", "word", "pos", "definition", F.when(F.col("cefr_level").isin(*CEFR_LEVELS), F.col("cefr_level")).alias("cefr_level"), "guideword", "grammar", "domain",
        F.when(known, F.col("labels")).otherwise(F.lit("[]")).alias("labels"), F.when(known, DICTIONARY).otherwise(LEXICON).alias("source"), "source_sense_id",
    )
    return cut(surrogate_ids(out, ["unified_id"]))


def sense_map(built_senses: DataFrame) -> DataFrame:
    """(source_sense_id, sense_id, pos): one dictionary sense may have become several."""
    return built_senses.where("source_sense_id is not null").select("source_sense_id", F.col("id").alias("sense_id"), "pos")


def synset_senses(built_senses: DataFrame, links: DataFrame) -> DataFrame:
    """(synset_id, sense_id, word_key, pos) of every link of a unified sense, each once."""
    return built_senses.select(F.col("id").alias("sense_id"), key_form("word").alias("word_key"), "pos", F.col("unified_id").alias("unified_sense_id")).join(links.select("unified_sense_id", F.col("wordnet_id").alias("synset_id")).distinct(), "unified_sense_id").drop("unified_sense_id")


def build_definitions(built_senses: DataFrame, senses: DataFrame, links: DataFrame, synsets: DataFrame) -> DataFrame:
    """(sense_id, definition, source, wordnet_id): the original definition of the dictionary, and those of the synsets."""
    original = keep_one(senses.where("coalesce(definition, '') <> ''").select(F.col("id").alias("source_sense_id"), "definition"), ["source_sense_id"], ["definition"])
    own = built_senses.select(F.col("id").alias("sense_id"), "source_sense_id").join(original, "source_sense_id").select("sense_id", "definition", F.lit(DICTIONARY).alias("source"), F.lit(None).cast("string").alias("wordnet_id"))
    given = keep_one(synsets.where("coalesce(definition, '') <> ''").select("synset_id", "definition"), ["synset_id"], ["definition"])
    more = synset_senses(built_senses, links).join(given, "synset_id").select("sense_id", "definition", F.lit(LEXICON).alias("source"), F.col("synset_id").alias("wordnet_id"))
    return own.unionByName(more)


def build_synonyms(synonyms: DataFrame, built_senses: DataFrame) -> DataFrame:
    """(sense_id, target_word, target_sense_id, is_antonym, source): dictionary synonyms at every sense they belong to.

    Of a target that became several senses the first with a compatible part of speech is meant; a relation whose
    target is known but never compatible is dropped.
    """
    m = sense_map(built_senses)
    left = synonyms.join(m.select(F.col("source_sense_id").alias("sense_id"), F.col("sense_id").alias("final"), F.col("pos").alias("own_pos")), "sense_id")
    targets = m.select(F.col("source_sense_id").alias("target_sense_id"), F.col("sense_id").alias("option"), F.col("pos").alias("option_pos"))
    pairs = left.select("final", "own_pos", "target_sense_id").distinct().join(targets, "target_sense_id")
    chosen = pairs.groupBy("final", "own_pos", "target_sense_id").agg(F.min(F.when(pos_compatible("own_pos", "option_pos"), F.col("option"))).alias("target"))
    joined = left.join(chosen.withColumn("known", F.lit(True)), ["final", "own_pos", "target_sense_id"], "left").where("known is null or target is not null")
    return joined.select(F.col("final").alias("sense_id"), F.col("synonym").alias("target_word"), F.col("target").alias("target_sense_id"), "is_antonym", F.lit(DICTIONARY).alias("source"))


def build_lexicon_synonyms(built_senses: DataFrame, links: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Every other lemma of a sense's synsets as synonym, with the first sense of that lemma and synset where there is one."""
    at = synset_senses(built_senses, links)
    sibling = at.groupBy("synset_id", F.col("word_key").alias("lemma_key")).agg(F.min("sense_id").alias("target_sense_id"))
    pairs = at.join(lemmas.select("synset_id", "lemma", key_form("lemma").alias("lemma_key")), "synset_id").where("lemma_key <> word_key")
    return pairs.join(sibling, ["synset_id", "lemma_key"], "left").select("sense_id", F.col("lemma").alias("target_word"), "target_sense_id", F.lit(0).alias("is_antonym"), F.lit(LEXICON).alias("source"))


def build_lexicon_antonyms(built_senses: DataFrame, links: DataFrame, sense_relations: DataFrame) -> DataFrame:
    """Antonyms of lexicon senses (src_lemma, src_synset, rel, tgt_lemma, tgt_synset), one per unordered pair of senses, and one
    per sense and word where the other sense is not known."""
    at = synset_senses(built_senses, links)
    sibling = at.groupBy(F.col("synset_id").alias("tgt_synset"), F.col("word_key").alias("tgt_key")).agg(F.min("sense_id").alias("target_sense_id"))
    rel = sense_relations.where("rel = 'antonym'").select(F.col("src_synset").alias("synset_id"), key_form("src_lemma").alias("word_key"), "tgt_lemma", key_form("tgt_lemma").alias("tgt_key"), "tgt_synset")
    rows = at.join(rel, ["synset_id", "word_key"]).join(sibling, ["tgt_synset", "tgt_key"], "left")
    known = F.col("target_sense_id").isNotNull()
    low = F.when(known, F.least("sense_id", "target_sense_id")).otherwise(F.col("sense_id")).cast("string")
    high = F.when(known, F.greatest("sense_id", "target_sense_id").cast("string")).otherwise(F.col("tgt_lemma"))
    one = keep_one(rows.select(low.alias("a"), high.alias("b"), "sense_id", "tgt_lemma", "target_sense_id"), ["a", "b"], ["sense_id", "tgt_lemma", "target_sense_id"])
    return one.select("sense_id", F.col("tgt_lemma").alias("target_word"), "target_sense_id", F.lit(1).alias("is_antonym"), F.lit(LEXICON).alias("source"))


def build_examples(examples: DataFrame, built_senses: DataFrame, links: DataFrame, lexicon_examples: DataFrame) -> DataFrame:
    """(sense_id, example_text, collocation, source): dictionary examples at every sense they became, and those of synsets."""
    own = examples.join(sense_map(built_senses).select(F.col("source_sense_id").alias("sense_id"), F.col("sense_id").alias("final")), "sense_id").select(F.col("final").alias("sense_id"), F.col("example").alias("example_text"), "collocation", F.lit(DICTIONARY).alias("source"))
    more = synset_senses(built_senses, links).join(lexicon_examples, "synset_id").select("sense_id", F.col("example").alias("example_text"), F.lit(None).cast("string").alias("collocation"), F.lit(LEXICON).alias("source"))
    return own.unionByName(more)


def build_collocations(collocations: DataFrame, built_words: DataFrame) -> DataFrame:
    w = built_words.where("source_word_id is not null").select(F.col("source_word_id").alias("word_id"), F.col("id").alias("final"))
    return collocations.join(w, "word_id").select(F.col("final").alias("word_id"), "collocation", "example")


def build_sense_topics(word_topics: DataFrame, built_words: DataFrame, built_entries: DataFrame, built_senses: DataFrame) -> DataFrame:
    """(sense_id, topic_id): the topics of a word at every one of its senses, each once."""
    w = built_words.where("source_word_id is not null").select(F.col("source_word_id").alias("word_id"), F.col("id").alias("final"))
    e = built_entries.select(F.col("id").alias("entry_id"), F.col("word_id").alias("final"))
    s = built_senses.select(F.col("id").alias("sense_id"), "entry_id")
    return word_topics.join(w, "word_id").join(e, "final").join(s, "entry_id").select("sense_id", "topic_id").distinct()


def mapped_relation(rel: str, names: Mapping[str, str]):
    """Relation type of a relation name, null for names outside the table; a leading /r/ does not count."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.element_at(table, F.regexp_replace(rel, "^/r/", ""))


def _edges(pairs: DataFrame, source: str) -> DataFrame:
    kept = pairs.where("source_sense_id <> target_sense_id and relation_type is not null")
    return kept.select("source_sense_id", "target_sense_id", "relation_type", F.lit(source).alias("source")).distinct()


def build_relations(built_senses: DataFrame, links: DataFrame, synset_relations: DataFrame, sense_relations: DataFrame, concept_relations: DataFrame, concept_senses: DataFrame) -> DataFrame:
    """(source_sense_id, target_sense_id, relation_type, source) without loops, each once.

    Synset relations (src, rel, tgt) hold between all senses of both synsets, sense relations between senses of the
    named lemmas, and concept relations (start_concept, relation, end_concept) between the senses of the synsets the
    concepts are mapped to (conceptnet_uri, wordnet_id).
    """
    at = synset_senses(built_senses, links)
    s = at.select(F.col("synset_id").alias("src"), F.col("sense_id").alias("source_sense_id"), F.col("word_key").alias("src_key"))
    t = at.select(F.col("synset_id").alias("tgt"), F.col("sense_id").alias("target_sense_id"), F.col("word_key").alias("tgt_key"))
    synset = synset_relations.select("src", "tgt", mapped_relation("rel", SYNSET_RELATIONS).alias("relation_type")).where("relation_type is not null").join(s, "src").join(t, "tgt")
    named = sense_relations.select(F.col("src_synset").alias("src"), key_form("src_lemma").alias("src_key"), F.col("tgt_synset").alias("tgt"), key_form("tgt_lemma").alias("tgt_key"), mapped_relation("rel", SYNSET_RELATIONS).alias("relation_type")).where("relation_type is not null")
    sense = named.join(s, ["src", "src_key"]).join(t, ["tgt", "tgt_key"])
    c = concept_senses.select("conceptnet_uri", "wordnet_id").distinct()
    concept = (
        concept_relations.select("start_concept", "end_concept", mapped_relation("relation", CONCEPT_RELATIONS).alias("relation_type")).where("relation_type is not null")
        .join(c.select(F.col("conceptnet_uri").alias("start_concept"), F.col("wordnet_id").alias("src")), "start_concept")
        .join(c.select(F.col("conceptnet_uri").alias("end_concept"), F.col("wordnet_id").alias("tgt")), "end_concept")
        .join(s, "src").join(t, "tgt")
    )
    return _edges(synset, LEXICON).unionByName(_edges(sense, LEXICON)).distinct().unionByName(_edges(concept, CONCEPTS))


def star_schema(words: DataFrame, entries: DataFrame, senses: DataFrame) -> dict[str, DataFrame]:
    """dim_words, dim_entries, dim_calendar and fact_senses of the dictionary tables."""
    day = F.to_date("loaded_at")
    dates = senses.select(day.alias("date")).where("date is not null").distinct()
    calendar = dates.select(F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"), "date", F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"))
    fact = senses.select(F.col("id").alias("sense_id"), "entry_id", F.date_format("loaded_at", "yyyyMMdd").cast("int").alias("date_key"), "cefr_level", F.length("definition").alias("definition_length"))
    return {
        "dim_words": words.select(F.col("id").alias("word_id"), "word", "display_form", "entry_type").distinct(),
        "dim_entries": entries.select(F.col("id").alias("entry_id"), "word_id", pos_enum("pos").alias("pos"), "dictionary_source").distinct(),
        "dim_calendar": calendar,
        "fact_senses": fact,
    }
