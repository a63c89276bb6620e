"""Queries that run the relational, alignment and consolidation operators over the dictionary and alignment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.functions import text as tx
from glossarium.functions.keys import match_keys_column
from glossarium.operators import alignment as al
from glossarium.operators import batching as ba
from glossarium.operators import consolidate as co
from glossarium.operators import relational as re
from glossarium.operators import synonyms as sy
from glossarium.sources.tables import load
from glossarium.streaming.events import event_stream, run_to_table, velocity



def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


def _dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Senses with their entry and word, each id once."""
    s = load(spark, d, "senses", "id", "entry_id", "definition", "phrase_title").distinct().withColumnRenamed("id", "sense_id")
    e = load(spark, d, "entries", "id", "word_id", "pos", "dictionary_source").distinct().withColumnRenamed("id", "entry_id")
    w = load(spark, d, "words", "id", "word", "display_form").groupBy(F.col("id").alias("word_id")).agg(F.min("word").alias("word"), F.min("display_form").alias("display_form"))
    return s.join(e, "entry_id").join(w, "word_id")


_DICT = """
WITH s AS (SELECT DISTINCT id AS sense_id, entry_id, definition, phrase_title FROM senses),
e AS (SELECT DISTINCT id AS entry_id, word_id, pos, dictionary_source FROM entries),
w AS (SELECT id AS word_id, min(word) AS word, min(display_form) AS display_form FROM words GROUP BY id),
d AS (SELECT * FROM s JOIN e USING (entry_id) JOIN w USING (word_id))
"""


def lookup_senses(spark: SparkSession, d: str) -> DataFrame:
    """Senses, outside phrases and in one dictionary, of the first word of the alphabet that has such."""
    rows = _dictionary(spark, d).where("dictionary_source = 'Harwick Learner''s Dictionary' and (phrase_title is null or phrase_title = '')")
    return rows.where(F.col("display_form") == rows.agg(F.min("display_form")).scalar()).select("sense_id", "pos", "definition")


def polysemous_words(spark: SparkSession, d: str) -> DataFrame:
    """The hundred words with most senses, three or more, that the other lexicon has too."""
    counts = _dictionary(spark, d).where("phrase_title is null or phrase_title = ''").groupBy("display_form").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    other = load(spark, d, "wn_synset", "lemmas").select(F.explode(F.split("lemmas", r"\|")).alias("display_form")).distinct()
    return counts.join(other, "display_form", "left_semi").orderBy(F.desc("n"), "display_form").limit(100)


def four_way_join(spark: SparkSession, d: str) -> DataFrame:
    """Open synonym relations with the word and part of speech they belong to, counted."""
    open_ = load(spark, d, "sense_synonyms", "id", "sense_id", "is_antonym", "target_sense_id").where("is_antonym = 0 and target_sense_id is null").select("id", "sense_id").distinct()
    return open_.join(_dictionary(spark, d).select("sense_id", "pos", "word_id"), "sense_id").groupBy("pos").agg(_n(), F.countDistinct("word_id").alias("words"))


def double_mapping_join(spark: SparkSession, d: str) -> DataFrame:
    """Resolved synonym relations mapped to unified senses at both ends, without loops, each once."""
    m = load(spark, d, "unified_senses", "id", "cambridge_sense_id").where("cambridge_sense_id is not null").distinct()
    rel = load(spark, d, "sense_synonyms", "sense_id", "target_sense_id", "is_antonym").where("target_sense_id is not null").distinct()
    a = m.select(F.col("cambridge_sense_id").alias("sense_id"), F.col("id").alias("source_id"))
    b = m.select(F.col("cambridge_sense_id").alias("target_sense_id"), F.col("id").alias("target_id"))
    return rel.join(a, "sense_id").join(b, "target_sense_id").where("source_id <> target_id").select("source_id", "target_id", "is_antonym").distinct()


def fanout_join(spark: SparkSession, d: str) -> DataFrame:
    """How many synonym rows each sense has that became unified senses, counted over all of these."""
    u = load(spark, d, "unified_senses", "id", "cambridge_sense_id").where("cambridge_sense_id is not null").distinct()
    syn = load(spark, d, "sense_synonyms", "id", "sense_id").distinct().groupBy("sense_id").agg(_n())
    return u.join(syn.withColumnRenamed("sense_id", "cambridge_sense_id"), "cambridge_sense_id").select(F.col("id").alias("unified_id"), "n")


def anti_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Senses that no unified sense names."""
    named = load(spark, d, "unified_senses", "cambridge_sense_id").select(F.col("cambridge_sense_id").alias("id"))
    return load(spark, d, "senses", "id", "entry_id").distinct().join(named, "id", "left_anti")


def semi_has_children(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents", "doc_id", "doc_type").join(load(spark, d, "doc_labels", "doc_id"), "doc_id", "left_semi")


def disjunctive_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The word each unified sense's word names, by slug or by display form."""
    names = load(spark, d, "unified_senses", "word").where("word is not null").distinct()
    return re.lookup_either(names, "word", load(spark, d, "words", "id", F.col("word").alias("slug"), "display_form"), ["slug", "display_form"], "id").select("word", F.col("id").alias("word_id"))


def fuzzy_token_join(spark: SparkSession, d: str) -> DataFrame:
    """Display forms of which one's words contain the other's, similar by 0.6 or more."""
    names = load(spark, d, "words", "display_form").where("display_form is not null").select(F.lower("display_form").alias("name")).distinct()
    sets = names.select("name", F.filter(F.array_distinct(F.split("name", r"[^\p{L}\p{N}]+")), lambda t: t != "").alias("tokens"))
    return re.contained_pairs(sets, "name", "tokens").select("small", "large", F.round("jaccard", 6).alias("jaccard"))


def match_key_join(spark: SparkSession, d: str) -> DataFrame:
    """(key, n_words, n_lemmas) of match keys that words and lexicon lemmas share."""
    words = load(spark, d, "words", "display_form").where("display_form is not null").distinct().select(F.explode(match_keys_column("display_form")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n_words"))
    lemmas = load(spark, d, "wn_synset", "lemmas").select(F.explode(F.split("lemmas", r"\|")).alias("lemma")).distinct().select(F.explode(match_keys_column("lemma")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n_lemmas"))
    return words.join(lemmas, "key")


def first_nonempty_per_group(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "entries", "id", "word_id", "pos", "pronunciation_uk", "audio_uk_url").distinct().withColumn("pos", tx.pos_enum("pos"))
    return re.first_nonempty(rows, ["word_id", "pos"], ["pronunciation_uk", "audio_uk_url"], "id")


def surrogate_ids(spark: SparkSession, d: str) -> DataFrame:
    words = load(spark, d, "words", "id", "word").distinct()
    return re.surrogate_ids(words, ["id", "word"], "new_id")


def slug_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Slugs made from display forms, made unique in order of id."""
    words = load(spark, d, "words", "id", "display_form").where("display_form is not null").groupBy("id").agg(F.min("display_form").alias("display_form"))
    return re.unique_slugs(words.select("id", tx.slugify("display_form").alias("slug")), "slug", "id")


def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return re.keep_one(load(spark, d, "events", "user_id", "event_id", "event_type", "value"), ["user_id"], ["event_id"], last=True)


def upsert_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return re.keep_one(load(spark, d, "events", "user_id", "event_id", "event_type", "value"), ["user_id"], ["event_id"])


def latest_senses(spark: SparkSession, d: str) -> DataFrame:
    """Re-delivered senses: the last delivery of each id."""
    rows = load(spark, d, "senses", "id", "entry_id", "definition", "loaded_at")
    return re.keep_one(rows, ["id"], ["loaded_at", "entry_id", "definition"], last=True).select("id", "entry_id", "definition", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded"))


def dedup_unordered_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Resolved antonym relations, one per unordered pair of senses."""
    rel = load(spark, d, "sense_synonyms", "id", "sense_id", "target_sense_id", "is_antonym").where("is_antonym = 1 and target_sense_id is not null")
    return re.unordered_pairs(rel.select("id", "sense_id", "target_sense_id").distinct(), "sense_id", "target_sense_id", "id")


def dedup_composite(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "entry_inflections", "entry_id", "form_type", "inflected_form").distinct()


def consolidated_inflections(spark: SparkSession, d: str) -> DataFrame:
    """Inflections by type, whole forms only, each once per entry."""
    e = load(spark, d, "entries", "id", "pos").distinct().select(F.col("id").alias("entry_id"), tx.pos_enum("pos").alias("pos"))
    rows = load(spark, d, "entry_inflections", "entry_id", "form_type", "inflected_form").where("coalesce(inflected_form, '') <> '' and not (inflected_form like '-%' and inflected_form like '%-')").join(e, "entry_id")
    return rows.select("entry_id", F.explode(tx.inflection_types("form_type", "pos")).alias("form_type"), "inflected_form").distinct()


def consolidated_words(spark: SparkSession, d: str) -> DataFrame:
    words = load(spark, d, "words", "id", "word", "display_form", "entry_type")
    return co.build_words(words, load(spark, d, "unified_senses", "word", "pos")).select("id", "slug", "word", "entry_type", "source_word_id")


def consolidated_senses(spark: SparkSession, d: str) -> DataFrame:
    """Unified senses with the data of their dictionary sense, by source and level, counted."""
    words, unified = load(spark, d, "words", "id", "word", "display_form", "entry_type"), load(spark, d, "unified_senses")
    built = co.build_words(words, unified)
    entries, _ = co.build_entries(load(spark, d, "entries").distinct(), built, unified)
    senses = co.build_senses(unified, load(spark, d, "senses"), entries, built)
    return senses.groupBy("source", "cefr_level").agg(_n())


def consolidated_definitions(spark: SparkSession, d: str) -> DataFrame:
    """Definitions of unified senses from both sources, counted per unified sense."""
    unified = load(spark, d, "unified_senses", "id", "cambridge_sense_id").groupBy("id").agg(F.min("cambridge_sense_id").alias("source_sense_id"))
    stand_in = unified.select("id", F.col("id").alias("unified_id"), "source_sense_id", F.lit("").alias("word"), F.lit("").alias("pos"))
    out = co.build_definitions(stand_in, load(spark, d, "senses", "id", "definition"), load(spark, d, "unified_sense_wordnet_links"), load(spark, d, "wn_synset", "synset_id", "definition"))
    return out.groupBy("sense_id", "source").agg(_n())


def lexicon_synonyms(spark: SparkSession, d: str) -> DataFrame:
    """Lemmas of linked synsets other than the sense's own word, with the sibling sense where there is one."""
    u = load(spark, d, "unified_senses", "id", "word").where("word is not null").groupBy("id").agg(F.min("word").alias("word"))
    stand_in = u.select("id", F.col("id").alias("unified_id"), "word", F.lit("").alias("pos"))
    lemmas = load(spark, d, "wn_synset", "synset_id", "lemmas").select("synset_id", F.explode(F.split("lemmas", r"\|")).alias("lemma")).distinct()
    return co.build_lexicon_synonyms(stand_in, load(spark, d, "unified_sense_wordnet_links", "unified_sense_id", "wordnet_id"), lemmas).select("sense_id", "target_word", "target_sense_id")


def hierarchical_candidate(spark: SparkSession, d: str) -> DataFrame:
    """Per sense its best synonym rows: resolved ones first, then the longest, ties kept."""
    rows = load(spark, d, "sense_synonyms", "id", "sense_id", "synonym", "target_sense_id").where("synonym is not null").distinct()
    judged = rows.select(F.col("sense_id").alias("relation_id"), "id", F.col("target_sense_id").isNotNull().alias("mutual"), F.length("synonym").cast("bigint").alias("overlap"))
    return sy.best_candidates(judged).select(F.col("relation_id").alias("sense_id"), "id", "candidates", "needs_vectors")


def embedding_argmax(spark: SparkSession, d: str) -> DataFrame:
    """Nearest other vector of every twentieth vector, searched among all."""
    e = load(spark, d, "embeddings", "vec_id", "embedding")
    return re.nearest(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding").select("source", "target", F.round("sim", 5).alias("sim"))


def centroid_norm(spark: SparkSession, d: str) -> DataFrame:
    """Unit mean vector of each label, by position."""
    parts = load(spark, d, "embeddings", "label", "embedding").select("label", F.posexplode("embedding").alias("place", "x")).groupBy("label", "place").agg(F.avg(F.col("x").cast("double")).alias("m"))
    size = parts.groupBy("label").agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("size"))
    return parts.join(size, "label").select("label", "place", F.round(F.col("m") / F.col("size"), 5).alias("x"))


def lpt_batches(spark: SparkSession, d: str) -> DataFrame:
    """Documents balanced over batches of eight on average, by length."""
    docs = load(spark, d, "documents", "doc_id", "text").select("doc_id", F.length("text").alias("size"))
    return ba.batch_report(ba.balanced_batches(docs, "doc_id", "size", 8))


def fixed_chunks(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents", "doc_id").distinct()
    return ba.chunks(docs, ["doc_id"], 50).groupBy("chunk").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), _n())


def difficulty_mul_add(spark: SparkSession, d: str) -> DataFrame:
    """Per unified sense word: how many rows it has, how many links, and both costs."""
    u = load(spark, d, "unified_senses", "id", "word").where("word is not null").distinct()
    links = load(spark, d, "unified_sense_wordnet_links", "unified_sense_id", "wordnet_id").distinct().select(F.col("unified_sense_id").alias("id"), "wordnet_id")
    counts = u.join(links, "id", "left").groupBy("word").agg(F.countDistinct("id").alias("n_left"), F.count("wordnet_id").alias("n_right"))
    return counts.withColumns({"mul": ba.difficulty("n_left", "n_right"), "add": ba.difficulty("n_left", "n_right", "add")})


def batch_stats_popstd(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "lineitem", "l_orderkey", "l_quantity").select((F.col("l_orderkey") % 16).alias("batch"), F.col("l_quantity").alias("weight"))
    return ba.batch_report(rows)


def json_weight_default(spark: SparkSession, d: str) -> DataFrame:
    """A number of each event's JSON, 1.0 where the type has none."""
    props = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.regexp_replace("props", '"k"', '"weight"'))
    return load(spark, d, "events", "event_id", "event_type", "props").select("event_id", tx.json_weight(props).alias("weight"))


def render_prompt(spark: SparkSession, d: str) -> DataFrame:
    """Numbered definitions of each entry in order of sense id."""
    s = load(spark, d, "senses", "id", "entry_id", "definition").where("definition is not null").distinct()
    lines = s.groupBy("entry_id").agg(F.array_sort(F.collect_list(F.struct("id", "definition"))).alias("l"))
    return lines.select("entry_id", tx.numbered_lines(F.transform("l", lambda x: x["definition"])).alias("prompt"))


def cache_key(spark: SparkSession, d: str) -> DataFrame:
    """Content address of each document's text."""
    return load(spark, d, "documents", "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("key"))


def unified_export(spark: SparkSession, d: str) -> DataFrame:
    """Per word and part of speech the number of unified senses and the ordered ids of their links."""
    u = load(spark, d, "unified_senses", "id", "word", "pos").where("word is not null and pos is not null").distinct()
    links = load(spark, d, "unified_sense_wordnet_links", "unified_sense_id", "wordnet_id").distinct()
    joined = u.join(links.withColumnRenamed("unified_sense_id", "id"), "id", "left").groupBy(F.concat("word", F.lit("_"), "pos").alias("task_id"))
    return joined.agg(F.countDistinct("id").alias("senses"), F.array_join(F.array_sort(F.collect_set("wordnet_id")), ",").alias("links"))


def _clusters(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = load(spark, d, "embeddings", "vec_id", "label").select((F.col("vec_id") % 7).alias("task"), F.col("vec_id").cast("string").alias("item"), "label")
    gold = e.groupBy("task", F.col("label").alias("cluster")).agg(F.collect_list("item").alias("items"))
    predicted = e.groupBy("task", F.pmod(F.col("label") + F.when(F.col("item").endswith("3"), 1).otherwise(0), F.lit(10)).alias("cluster")).agg(F.collect_list("item").alias("items"))
    return gold, predicted


def clustering_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Clusters by label against clusters in which every vector whose number ends in 3 is one label off."""
    m = al.clustering_metrics(*_clusters(spark, d))
    return m.select("task", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def eval_report(spark: SparkSession, d: str) -> DataFrame:
    return al.evaluation_report(al.clustering_metrics(*_clusters(spark, d)))


def sentiment_default(spark: SparkSession, d: str) -> DataFrame:
    """Scores of linked synsets, known for adjectives only, defaults for the others, counted."""
    ids = load(spark, d, "unified_sense_wordnet_links", "wordnet_id")
    scores = load(spark, d, "wn_synset", "synset_id", "pos").where("pos in ('a', 's')").select("synset_id", F.lit(0.25).alias("pos_score"), F.lit(0.125).alias("neg_score"), F.lit(0.625).alias("obj_score"))
    return al.with_sentiment(ids, scores).groupBy("mapped").agg(_n(), F.sum("pos_score").alias("pos_score"), F.sum("neg_score").alias("neg_score"), F.sum("obj_score").alias("obj_score"))


def alignment_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Synsets that could be meant by each word and part of speech, counted."""
    groups = al.sense_groups(load(spark, d, "words", "id", "display_form").distinct(), load(spark, d, "entries", "id", "word_id", "pos").distinct(), load(spark, d, "senses", "id", "entry_id", "definition", "phrase_title").distinct())
    lexicon = load(spark, d, "wn_synset", "synset_id", "pos", "lemmas").select("synset_id", "pos", F.explode(F.split("lemmas", r"\|")).alias("lemma"))
    return al.candidate_synsets(al.tasks(groups), lexicon).groupBy("word", "pos").agg(_n())


def bypass_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Senses without unified sense, each one of its own."""
    done = load(spark, d, "unified_senses", "cambridge_sense_id").where("cambridge_sense_id is not null").select(F.col("cambridge_sense_id").alias("sense_id")).distinct()
    rest = load(spark, d, "senses", "id", "definition").distinct().select(F.col("id").alias("sense_id"), "definition").join(done, "sense_id", "left_anti")
    kept = done.select("sense_id", F.lit("unified").alias("origin"))
    return kept.unionByName(rest.select("sense_id", F.lit("bypass").alias("origin")))


def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    """Words and parts of speech of unified senses of which no sense is linked yet."""
    u = load(spark, d, "unified_senses", "id", "word", "pos").where("word is not null and pos is not null").distinct()
    linked = u.join(load(spark, d, "unified_sense_wordnet_links", "unified_sense_id").select(F.col("unified_sense_id").alias("id")), "id", "left_semi")
    return al.pending(u.select("word", "pos").distinct(), linked.select("word", "pos", F.lit("aligned").alias("status")).distinct())


def synonym_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Open synonym relations by how they could be resolved."""
    base = _dictionary(spark, d).select("sense_id", "word_id", "word", "display_form", "pos")
    rel = load(spark, d, "sense_synonyms", "id", "sense_id", "synonym", "is_antonym", "target_sense_id").where("is_antonym = 0 and target_sense_id is null and synonym is not null").select("id", "sense_id", "synonym").distinct()
    relations = rel.join(base.select("sense_id", "pos"), "sense_id").select(F.col("id").alias("relation_id"), F.col("sense_id").alias("source_sense_id"), "synonym", "pos")
    senses = base.select("sense_id", "display_form", F.col("word").alias("slug"), "pos", tx.display_name("display_form", "word").alias("word"))
    own = load(spark, d, "sense_synonyms", "sense_id", "synonym", "is_antonym").where("is_antonym = 0 and synonym is not null").select("sense_id", tx.key_form("synonym").alias("synonym")).distinct()
    return sy.stage_counts(relations, sy.resolve(relations, senses, own))


def topic_propagation(spark: SparkSession, d: str) -> DataFrame:
    """Subjects of documents at every entry of the document's headword, each once."""
    labels = load(spark, d, "doc_labels", "doc_id", "subject").distinct()
    docs = load(spark, d, "documents", "doc_id", "headword").where("headword is not null")
    entries = load(spark, d, "entries", "id", "headword").where("headword is not null").distinct()
    return labels.join(docs, "doc_id").select("headword", "subject").distinct().join(entries, "headword").select(F.col("id").alias("entry_id"), "subject").distinct()


def relation_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Typed relations between unified senses that share a synset, and their part of speech as relation name."""
    links = load(spark, d, "unified_sense_wordnet_links", "unified_sense_id", "wordnet_id").distinct()
    names = {"n": "hypernym", "v": "entailment", "a": "similar_to", "r": "derivationally_related"}
    typed = links.join(load(spark, d, "wn_synset", "synset_id", "pos").select(F.col("synset_id").alias("wordnet_id"), co.mapped_relation("pos", names).alias("relation_type")), "wordnet_id").where("relation_type is not null")
    a = typed.select("wordnet_id", "relation_type", F.col("unified_sense_id").alias("source_sense_id"))
    b = typed.select("wordnet_id", F.col("unified_sense_id").alias("target_sense_id"))
    return a.join(b, "wordnet_id").where("source_sense_id <> target_sense_id").select("source_sense_id", "target_sense_id", "relation_type").distinct()


def star_schema_fact(spark: SparkSession, d: str) -> DataFrame:
    star = co.star_schema(load(spark, d, "words"), load(spark, d, "entries"), load(spark, d, "senses"))
    return star["fact_senses"].groupBy("date_key", "cefr_level").agg(_n(), F.sum(F.col("definition_length").cast("bigint")).alias("total_length"))


def stream_velocity(spark: SparkSession, d: str) -> DataFrame:
    """Events per ten minutes, counted by a stream over the table."""
    return run_to_table(spark, velocity(event_stream(spark, f"{d}/events.parquet")))


def accent_strip(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "words", "id", "display_form").where("display_form is not null").select("id", tx.strip_accents("display_form").alias("plain")).distinct()


def url_slug(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "entries", "id", "audio_uk_url").where("audio_uk_url is not null").select("id", tx.url_slug("audio_uk_url").alias("file")).distinct()


def pos_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Every part of speech as written, with its letter, its class and the type of a two-word entry of it."""
    p = load(spark, d, "entries", "pos").where("pos is not null").distinct()
    return p.select("pos", tx.map_pos("pos").alias("letter"), tx.pos_enum("pos").alias("pos_class"), tx.guess_entry_type(F.lit("give up"), tx.pos_enum("pos")).alias("entry_type"))


def title_classify(spark: SparkSession, d: str) -> DataFrame:
    """Type and display form of words whose title is their display form and type."""
    rows = load(spark, d, "words", "id", "word", "display_form", "entry_type").where("display_form is not null").distinct()
    title = F.concat("display_form", F.lit(" "), F.when(F.col("entry_type") == "word", "definition").otherwise(F.regexp_replace("entry_type", "_", " ")), F.lit(" | Dictionary"))
    return rows.select("id", tx.title_type("word", title).alias("title_type"), tx.title_display("word", title).alias("display"))


_LETTER = "CASE WHEN {0} LIKE '%pronoun%' THEN NULL WHEN {0} LIKE '%noun%' THEN 'n' WHEN {0} LIKE '%adv%' THEN 'r' WHEN {0} LIKE '%verb%' THEN 'v' WHEN {0} LIKE '%adj%' THEN 'a' END"
_CLASS = "CASE {0} WHEN 'n' THEN 'noun' WHEN 'v' THEN 'verb' WHEN 'r' THEN 'adverb' WHEN 'a' THEN 'adjective' WHEN 's' THEN 'adjective' ELSE CASE WHEN {0} LIKE '%pronoun%' THEN 'other' WHEN {0} LIKE '%noun%' THEN 'noun' WHEN {0} LIKE '%adv%' THEN 'adverb' WHEN {0} LIKE '%verb%' THEN 'verb' WHEN {0} LIKE '%adj%' THEN 'adjective' ELSE 'other' END END"
_KEY = r"regexp_replace(regexp_replace(lower({0}), '^\s+', ''), '\s+$', '')"
_SLUG = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(" + _KEY + r", '[^\p{{L}}\p{{N}}_\s\x{{A0}}\-]', '', 'g'), '[\s\x{{A0}}_]+', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g')"
_P = "coalesce(" + _KEY.format("pos") + ", '')"
_METRICS = """
WITH e AS (SELECT vec_id % 7 AS task, CAST(vec_id AS VARCHAR) AS item, label FROM embeddings),
g AS (SELECT task, label AS c, list(item) AS items FROM e GROUP BY ALL),
p AS (SELECT task, (label + CASE WHEN item LIKE '%3' THEN 1 ELSE 0 END) % 10 AS c, list(item) AS items FROM e GROUP BY ALL),
j AS (SELECT g.task, g.c AS gc, p.c AS pc, len(list_intersect(g.items, p.items))::DOUBLE AS b, len(g.items) + len(p.items) - len(list_intersect(g.items, p.items)) AS u FROM g JOIN p USING (task)),
m AS (SELECT task, (SELECT avg(x) FROM (SELECT max(b / u) AS x FROM j WHERE j.task = t.task GROUP BY pc)) AS precision,
 (SELECT avg(x) FROM (SELECT max(b / u) AS x FROM j WHERE j.task = t.task GROUP BY gc)) AS recall FROM (SELECT DISTINCT task FROM e) t),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m)
"""
_UPSERT = "SELECT user_id, {0}(event_id, event_id) AS event_id, {0}(event_type, event_id) AS event_type, {0}(value, event_id) AS value FROM events GROUP BY user_id"

QUERIES = {
    f.__name__: f
    for f in (
        lookup_senses, polysemous_words, four_way_join, double_mapping_join, fanout_join, anti_orphans, semi_has_children, disjunctive_lookup, fuzzy_token_join, match_key_join, first_nonempty_per_group,
        surrogate_ids, slug_collisions, upsert_last_wins, upsert_first_wins, latest_senses, dedup_unordered_pairs, dedup_composite, consolidated_inflections, consolidated_words, consolidated_senses,
        consolidated_definitions, lexicon_synonyms, hierarchical_candidate, embedding_argmax, centroid_norm, lpt_batches, fixed_chunks, difficulty_mul_add, batch_stats_popstd, json_weight_default, render_prompt,
        cache_key, unified_export, clustering_metrics, eval_report, sentiment_default, alignment_candidates, bypass_backfill, resume_pending, synonym_resolution, topic_propagation, relation_mapping,
        star_schema_fact, stream_velocity, accent_strip, url_slug, pos_mapping, title_classify,
    )
}
SQL = {
    "lookup_senses": _DICT + ", r AS (SELECT * FROM d WHERE dictionary_source = 'Harwick Learner''s Dictionary' AND (phrase_title IS NULL OR phrase_title = '')) SELECT sense_id, pos, definition FROM r WHERE display_form = (SELECT min(display_form) FROM r)",
    "polysemous_words": _DICT + r"""SELECT display_form, count(*) AS n FROM d WHERE (phrase_title IS NULL OR phrase_title = '') AND display_form IN (SELECT unnest(string_split(lemmas, '|')) FROM wn_synset)
GROUP BY display_form HAVING count(*) >= 3 ORDER BY n DESC, display_form LIMIT 100""",
    "four_way_join": _DICT + "SELECT pos, count(*) AS n, count(DISTINCT word_id) AS words FROM (SELECT DISTINCT id, sense_id FROM sense_synonyms WHERE is_antonym = 0 AND target_sense_id IS NULL) JOIN d USING (sense_id) GROUP BY pos",
    "double_mapping_join": """WITH m AS (SELECT DISTINCT id, cambridge_sense_id AS c FROM unified_senses WHERE cambridge_sense_id IS NOT NULL)
SELECT DISTINCT a.id AS source_id, b.id AS target_id, is_antonym FROM sense_synonyms r JOIN m a ON r.sense_id = a.c JOIN m b ON r.target_sense_id = b.c WHERE a.id <> b.id""",
    "fanout_join": """WITH u AS (SELECT DISTINCT id, cambridge_sense_id AS c FROM unified_senses WHERE cambridge_sense_id IS NOT NULL), s AS (SELECT sense_id, count(*) AS n FROM (SELECT DISTINCT id, sense_id FROM sense_synonyms) GROUP BY sense_id)
SELECT u.id AS unified_id, n FROM u JOIN s ON u.c = s.sense_id""",
    "anti_orphans": "SELECT DISTINCT id, entry_id FROM senses WHERE id NOT IN (SELECT cambridge_sense_id FROM unified_senses WHERE cambridge_sense_id IS NOT NULL)",
    "semi_has_children": "SELECT doc_id, doc_type FROM documents WHERE doc_id IN (SELECT doc_id FROM doc_labels)",
    "disjunctive_lookup": """WITH k AS (SELECT word AS name, id FROM words UNION ALL SELECT display_form, id FROM words WHERE display_form IS NOT NULL), m AS (SELECT name, min(id) AS id FROM k GROUP BY name)
SELECT u.word, m.id AS word_id FROM (SELECT DISTINCT word FROM unified_senses WHERE word IS NOT NULL) u LEFT JOIN m ON m.name = u.word""",
    "fuzzy_token_join": r"""WITH n AS (SELECT DISTINCT lower(display_form) AS name FROM words WHERE display_form IS NOT NULL),
s AS (SELECT name, list_distinct(list_filter(string_split_regex(name, '[^\p{L}\p{N}]+'), lambda t: t <> '')) AS t FROM n),
k AS (SELECT name, t, unnest(list_filter(t, lambda x: length(x) >= 3)) AS w FROM s),
c AS (SELECT DISTINCT a.name AS small, b.name AS large, a.t AS ta, b.t AS tb FROM k a JOIN k b USING (w) WHERE a.name <> b.name AND len(a.t) <= len(b.t) AND (len(a.t) < len(b.t) OR a.name < b.name))
SELECT small, large, round(len(ta)::DOUBLE / len(tb), 6) AS jaccard FROM c WHERE len(list_intersect(ta, tb)) = len(ta) AND len(ta) >= 0.6 * len(tb) - 1e-9""",
    "first_nonempty_per_group": f"""WITH r AS (SELECT DISTINCT id, word_id, {_CLASS.format(_P)} AS pos, pronunciation_uk, audio_uk_url FROM entries)
SELECT word_id, pos, arg_min(pronunciation_uk, id) FILTER (coalesce(pronunciation_uk, '') <> '') AS pronunciation_uk, arg_min(audio_uk_url, id) FILTER (coalesce(audio_uk_url, '') <> '') AS audio_uk_url FROM r GROUP BY word_id, pos""",
    "surrogate_ids": "SELECT id, word, row_number() OVER (ORDER BY id, word) AS new_id FROM (SELECT DISTINCT id, word FROM words)",
    "slug_collisions": f"""WITH r AS (SELECT id, {_SLUG.format('min(display_form)')} AS slug FROM words WHERE display_form IS NOT NULL GROUP BY id), k AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY id) AS n FROM r)
SELECT id, slug, CASE WHEN n = 1 THEN slug ELSE slug || '-' || (n - 1) END AS unique_slug FROM k""",
    "title_classify": r"""WITH r AS (SELECT DISTINCT id, word, display_form || ' ' || CASE WHEN entry_type = 'word' THEN 'definition' ELSE replace(entry_type, '_', ' ') END || ' | Dictionary' AS t FROM words WHERE display_form IS NOT NULL),
d AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(t, '(?is)\s*\b(phrasal verb|idiom|phrase|definition)\b.*$', ''), '^\s+', ''), '\s+$', '') AS cut FROM r)
SELECT id, CASE WHEN regexp_matches(lower(t), '\bphrasal verb\b') THEN 'phrasal_verb' WHEN regexp_matches(lower(t), '\bidiom\b') THEN 'idiom' WHEN regexp_matches(lower(t), '\bphrase\b') THEN 'phrase'
 WHEN word NOT LIKE '%-%' AND regexp_full_match(replace(word, '''', ''), '\p{L}+') THEN 'word' ELSE 'expression' END AS title_type, CASE WHEN cut <> '' THEN cut ELSE replace(word, '-', ' ') END AS display FROM d""",
    "upsert_last_wins": _UPSERT.format("arg_max"),
    "upsert_first_wins": _UPSERT.format("arg_min"),
    "latest_senses": """SELECT id, entry_id, definition, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded FROM senses
QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, entry_id DESC, definition DESC NULLS LAST) = 1""",
    "dedup_unordered_pairs": """SELECT id, sense_id, target_sense_id FROM sense_synonyms WHERE is_antonym = 1 AND target_sense_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY least(sense_id, target_sense_id), greatest(sense_id, target_sense_id) ORDER BY id) = 1""",
    "dedup_composite": "SELECT DISTINCT entry_id, form_type, inflected_form FROM entry_inflections",
    "consolidated_inflections": f"""WITH e AS (SELECT DISTINCT id AS entry_id, {_CLASS.format(_P)} AS pos FROM entries),
r AS (SELECT entry_id, pos, coalesce({_KEY.format('form_type')}, '') AS f, inflected_form FROM entry_inflections JOIN e USING (entry_id) WHERE coalesce(inflected_form, '') <> '' AND NOT (inflected_form LIKE '-%' AND inflected_form LIKE '%-')),
m AS (SELECT entry_id, inflected_form, unnest(CASE WHEN f = 'plural' THEN ['plural'] WHEN f IN ('past tense', 'past') THEN ['past_tense'] WHEN f = 'past participle' THEN ['past_participle'] WHEN f = 'present participle' THEN ['present_participle']
 WHEN f = 'past tense and past participle' THEN ['past_tense', 'past_participle'] WHEN f = 'singular' AND pos = 'verb' THEN ['third_person_singular'] ELSE []::VARCHAR[] END) AS form_type FROM r)
SELECT DISTINCT entry_id, form_type, inflected_form FROM m""",
    "consolidated_definitions": """WITH u AS (SELECT id, min(cambridge_sense_id) AS c FROM unified_senses GROUP BY id), s AS (SELECT id, min(definition) AS d FROM senses WHERE coalesce(definition, '') <> '' GROUP BY id)
SELECT u.id AS sense_id, 'dictionary' AS source, count(*) AS n FROM u JOIN s ON u.c = s.id GROUP BY u.id
UNION ALL SELECT u.id, 'wordnet', count(*) FROM u JOIN (SELECT DISTINCT unified_sense_id, wordnet_id FROM unified_sense_wordnet_links) l ON l.unified_sense_id = u.id JOIN wn_synset w ON w.synset_id = l.wordnet_id WHERE coalesce(w.definition, '') <> '' GROUP BY u.id""",
    "lexicon_synonyms": f"""WITH u AS (SELECT id, min(word) AS word FROM unified_senses WHERE word IS NOT NULL GROUP BY id), a AS (SELECT DISTINCT u.id AS sense_id, {_KEY.format('u.word')} AS k, l.wordnet_id AS y FROM u JOIN unified_sense_wordnet_links l ON l.unified_sense_id = u.id),
m AS (SELECT DISTINCT synset_id AS y, unnest(string_split(lemmas, '|')) AS lemma FROM wn_synset), b AS (SELECT y, k, min(sense_id) AS t FROM a GROUP BY y, k)
SELECT a.sense_id, m.lemma AS target_word, b.t AS target_sense_id FROM a JOIN m USING (y) LEFT JOIN b ON b.y = a.y AND b.k = {_KEY.format('m.lemma')} WHERE {_KEY.format('m.lemma')} <> a.k""",
    "hierarchical_candidate": """WITH r AS (SELECT DISTINCT sense_id, id, target_sense_id IS NOT NULL AS m, length(synonym) AS o FROM sense_synonyms WHERE synonym IS NOT NULL),
t AS (SELECT *, rank() OVER (PARTITION BY sense_id ORDER BY m DESC, o DESC) AS k, count(*) OVER (PARTITION BY sense_id) AS candidates FROM r), b AS (SELECT *, count(*) OVER (PARTITION BY sense_id) AS l FROM t WHERE k = 1)
SELECT sense_id, id, candidates, l > 1 OR (candidates > 1 AND NOT m AND o = 0) AS needs_vectors FROM b""",
    "embedding_argmax": """WITH s AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT a.vec_id AS source, b.vec_id AS target, list_dot_product(a.v, b.v) AS sim FROM s a JOIN s b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT source, target, round(sim, 5) AS sim FROM p QUALIFY row_number() OVER (PARTITION BY source ORDER BY sim DESC, target) = 1""",
    "centroid_norm": """WITH p AS (SELECT label, CAST(i - 1 AS INTEGER) AS place, avg(embedding[i]::DOUBLE) AS m FROM embeddings, generate_series(1, 64) g(i) GROUP BY label, i), z AS (SELECT label, sqrt(sum(m * m)) AS size FROM p GROUP BY label)
SELECT label, place, round(m / size, 5) AS x FROM p JOIN z USING (label)""",
    "fixed_chunks": "SELECT chunk, min(doc_id) AS first, max(doc_id) AS last, count(*) AS n FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS chunk FROM (SELECT DISTINCT doc_id FROM documents)) GROUP BY chunk",
    "difficulty_mul_add": """WITH u AS (SELECT DISTINCT id, word FROM unified_senses WHERE word IS NOT NULL), l AS (SELECT DISTINCT unified_sense_id AS id, wordnet_id FROM unified_sense_wordnet_links)
SELECT word, count(DISTINCT id) AS n_left, count(wordnet_id) AS n_right, count(DISTINCT id) * count(wordnet_id) AS mul, count(DISTINCT id) + count(wordnet_id) AS "add" FROM u LEFT JOIN l USING (id) GROUP BY word""",
    "batch_stats_popstd": """WITH b AS (SELECT l_orderkey % 16 AS batch, count(*) AS tasks, sum(l_quantity) AS load FROM lineitem GROUP BY 1)
SELECT count(*) AS batches, min(tasks) AS min_tasks, max(tasks) AS max_tasks, min(load) AS min_load, max(load) AS max_load, round(avg(tasks), 6) AS avg_tasks, round(stddev_pop(tasks), 6) AS std_tasks, round(avg(load), 6) AS avg_load, round(stddev_pop(load), 6) AS std_load FROM b""",
    "json_weight_default": "SELECT event_id, CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE coalesce(CAST(json_extract_string(props, '$.k') AS DOUBLE), 1.0) END AS weight FROM events",
    "render_prompt": "SELECT entry_id, string_agg('[' || i || '] ' || definition, chr(10) ORDER BY i) AS prompt FROM (SELECT entry_id, definition, row_number() OVER (PARTITION BY entry_id ORDER BY id, definition) AS i FROM (SELECT DISTINCT id, entry_id, definition FROM senses WHERE definition IS NOT NULL)) GROUP BY entry_id",
    "cache_key": "SELECT doc_id, sha256(text) AS key FROM documents",
    "unified_export": """SELECT word || '_' || pos AS task_id, count(DISTINCT id) AS senses, coalesce(string_agg(DISTINCT wordnet_id, ',' ORDER BY wordnet_id), '') AS links
FROM (SELECT DISTINCT id, word, pos FROM unified_senses WHERE word IS NOT NULL AND pos IS NOT NULL) u LEFT JOIN unified_sense_wordnet_links l ON l.unified_sense_id = u.id GROUP BY 1""",
    "clustering_metrics": _METRICS + "SELECT task, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f",
    "eval_report": _METRICS + "SELECT count(*) AS tasks, round(avg(precision) * 100, 4) AS precision, round(avg(recall) * 100, 4) AS recall, round(avg(f1) * 100, 4) AS f1 FROM f",
    "sentiment_default": """WITH i AS (SELECT DISTINCT wordnet_id FROM unified_sense_wordnet_links WHERE wordnet_id LIKE 'oewn-%'), s AS (SELECT i.wordnet_id, w.synset_id IS NOT NULL AS mapped FROM i LEFT JOIN wn_synset w ON w.synset_id = i.wordnet_id AND w.pos IN ('a', 's'))
SELECT mapped, count(*) AS n, sum(CASE WHEN mapped THEN 0.25 ELSE 0 END)::DOUBLE AS pos_score, sum(CASE WHEN mapped THEN 0.125 ELSE 0 END)::DOUBLE AS neg_score, sum(CASE WHEN mapped THEN 0.625 ELSE 1 END)::DOUBLE AS obj_score FROM s GROUP BY mapped""",
    "bypass_backfill": """SELECT DISTINCT cambridge_sense_id AS sense_id, 'unified' AS origin FROM unified_senses WHERE cambridge_sense_id IS NOT NULL
UNION ALL SELECT id, 'bypass' FROM (SELECT DISTINCT id, definition FROM senses) WHERE id NOT IN (SELECT cambridge_sense_id FROM unified_senses WHERE cambridge_sense_id IS NOT NULL)""",
    "resume_pending": """SELECT DISTINCT word, pos FROM unified_senses u WHERE word IS NOT NULL AND pos IS NOT NULL AND NOT EXISTS (SELECT 1 FROM unified_senses v JOIN unified_sense_wordnet_links l ON l.unified_sense_id = v.id WHERE v.word = u.word AND v.pos = u.pos)""",
    "topic_propagation": "SELECT DISTINCT e.id AS entry_id, subject FROM doc_labels JOIN documents USING (doc_id) JOIN entries e USING (headword)",
    "relation_mapping": """WITH t AS (SELECT DISTINCT unified_sense_id AS u, wordnet_id, CASE pos WHEN 'n' THEN 'hypernym' WHEN 'v' THEN 'entailment' WHEN 'a' THEN 'similar_to' WHEN 'r' THEN 'derivationally_related' END AS relation_type FROM unified_sense_wordnet_links JOIN wn_synset ON synset_id = wordnet_id)
SELECT DISTINCT a.u AS source_sense_id, b.u AS target_sense_id, a.relation_type FROM t a JOIN t b USING (wordnet_id) WHERE a.u <> b.u AND a.relation_type IS NOT NULL""",
    "star_schema_fact": "SELECT CAST(strftime(loaded_at, '%Y%m%d') AS INTEGER) AS date_key, cefr_level, count(*) AS n, CAST(sum(length(definition)) AS BIGINT) AS total_length FROM senses GROUP BY 1, 2",
    "stream_velocity": "SELECT substr(strftime(ts, '%Y-%m-%d %H:%M'), 1, 15) || '0' AS bucket, count(*) AS events FROM events GROUP BY 1",
    "accent_strip": "SELECT DISTINCT id, strip_accents(display_form) AS plain FROM words WHERE display_form IS NOT NULL",
    "url_slug": "SELECT DISTINCT id, regexp_extract(audio_uk_url, '([^/]*)/*$', 1) AS file FROM entries WHERE audio_uk_url IS NOT NULL",
    "pos_mapping": f"SELECT DISTINCT pos, {_LETTER.format(_P)} AS letter, {_CLASS.format(_P)} AS pos_class, CASE WHEN {_CLASS.format(_P)} = 'verb' THEN 'phrasal_verb' ELSE 'phrase' END AS entry_type FROM entries WHERE pos IS NOT NULL",
}
