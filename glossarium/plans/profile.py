"""Profiling queries over the dictionary tables: progress, distributions, descriptions and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.functions.text import CEFR_ORDER, blank, source_category, ten_minutes
from glossarium.operators.relational import describe, in_order, row_counts, share_of_total
from glossarium.operators.skew import union_all
from glossarium.sources.tables import load

TABLES = ("words", "entries", "entry_inflections", "senses", "sense_synonyms", "unified_senses", "unified_sense_wordnet_links", "wn_synset", "documents", "doc_labels", "subjects", "eval_items", "canonical_terms")
# What the names of dictionaries have in common.
SOURCES = {"%learner%": "Learner", "%american%": "American", "%business%": "Business", "%thesaurus%": "Thesaurus", "%legal%": "Specialist", "%medical%": "Specialist"}


def _n(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def status_distribution(spark: SparkSession, d: str) -> DataFrame:
    return share_of_total(load(spark, d, "words", "status").groupBy("status").agg(_n()), "n")


def progress_by_type(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "words", "entry_type", "status").groupBy("entry_type").agg(_n("total"), F.count_if(F.col("status") == "done").alias("done"))


def error_summary(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "words", "error_msg").where(~blank("error_msg")).groupBy("error_msg").agg(_n())


def pending_words(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "words", "id", "word", "entry_type", "status").where("status = 'pending'").select("id", "word", "entry_type").distinct()


def velocity_10min(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "words", "crawled_at").where("crawled_at is not null").groupBy(ten_minutes("crawled_at").alias("bucket")).agg(_n())


def table_row_counts(spark: SparkSession, d: str) -> DataFrame:
    return row_counts({t: load(spark, d, t) for t in TABLES})


def entry_type_distribution(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "words", "entry_type").groupBy("entry_type").agg(_n())


def pos_top15(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(blank("pos"), "Unknown/Unclassified").otherwise(F.col("pos"))
    return load(spark, d, "entries", "pos").groupBy(kind.alias("pos")).agg(_n()).orderBy(F.desc("n"), "pos").limit(15)


def ordered_level_distribution(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(blank("cefr_level"), "Not Annotated").otherwise(F.upper(F.trim("cefr_level")))
    counts = load(spark, d, "senses", "cefr_level").groupBy(level.alias("level")).agg(_n())
    return in_order(counts, "level", CEFR_ORDER).withColumn("place", F.col("place").cast("bigint"))


def source_category_case(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "entries", "dictionary_source").groupBy(source_category("dictionary_source", SOURCES).alias("category")).agg(_n())


def grammar_top12(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "senses", "grammar").where("grammar is not null and grammar <> ''").groupBy("grammar").agg(_n()).orderBy(F.desc("n"), "grammar").limit(12)


def senses_per_entry_describe(spark: SparkSession, d: str) -> DataFrame:
    return describe(load(spark, d, "senses", "entry_id").groupBy("entry_id").agg(_n("n_senses")), "n_senses")


def synonyms_per_sense_describe(spark: SparkSession, d: str) -> DataFrame:
    return describe(load(spark, d, "sense_synonyms", "sense_id").groupBy("sense_id").agg(_n("n_synonyms")), "n_synonyms")


def relation_polarity_counts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "sense_synonyms", "is_antonym").groupBy(F.when(F.col("is_antonym") == 1, "Antonym").otherwise("Synonym").alias("relation")).agg(_n())


def top_topics(spark: SparkSession, d: str) -> DataFrame:
    labels = load(spark, d, "doc_labels", "doc_id", "subject").join(load(spark, d, "subjects"), "subject")
    return labels.groupBy("subject", "title").agg(_n()).orderBy(F.desc("n"), "title").limit(20)


_REFERENCES = (
    ("entries", "word_id", "words", "id"),
    ("entry_inflections", "entry_id", "entries", "id"),
    ("senses", "entry_id", "entries", "id"),
    ("sense_synonyms", "sense_id", "senses", "id"),
    ("sense_synonyms", "target_sense_id", "senses", "id"),
    ("unified_senses", "cambridge_sense_id", "senses", "id"),
    ("unified_sense_wordnet_links", "unified_sense_id", "unified_senses", "id"),
    ("unified_sense_wordnet_links", "wordnet_id", "wn_synset", "synset_id"),
    ("doc_labels", "doc_id", "documents", "doc_id"),
    ("doc_labels", "subject", "subjects", "subject"),
)


def referential_audit(spark: SparkSession, d: str) -> DataFrame:
    """Orphans of every reference; keys are counted before they are compared, so hot keys are one row each."""

    def audit(child: str, column: str, parent: str, key: str) -> DataFrame:
        refs = load(spark, d, child, column).where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(_n())
        lost = refs.join(load(spark, d, parent, key).select(F.col(key).alias("k")), "k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
        return lost.select(F.lit(f"{child}.{column}").alias("reference"), "orphans", F.when(F.col("orphans") == 0, "PASS").otherwise("FAIL").alias("result"))

    return union_all([audit(*r) for r in _REFERENCES])


def unreachable_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of which the document or the subject is missing."""
    labels = load(spark, d, "doc_labels", "doc_id", "subject").distinct()
    docs = load(spark, d, "documents", "doc_id").select("doc_id", F.lit(1).alias("has_doc"))
    subjects = load(spark, d, "subjects", "subject").select("subject", F.lit(1).alias("has_subject"))
    return labels.join(docs, "doc_id", "left").join(subjects, "subject", "left").where("has_doc is null or has_subject is null").select("doc_id", "subject")


def _audit_sql() -> str:
    one = "SELECT '{0}.{1}' AS reference, count(*) AS orphans, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM {0} WHERE {1} IS NOT NULL AND {1} NOT IN (SELECT {3} FROM {2} WHERE {3} IS NOT NULL)"
    return " UNION ALL ".join(one.format(*r) for r in _REFERENCES)


def _describe_sql(table: str, key: str, name: str) -> str:
    return f"""WITH c AS (SELECT count(*) AS {name} FROM {table} GROUP BY {key})
SELECT count(*) AS n, round(avg({name}), 6) AS mean, round(stddev_samp({name}), 6) AS std, min({name}) AS "min",
 quantile_cont({name}, 0.25) AS p25, quantile_cont({name}, 0.5) AS p50, quantile_cont({name}, 0.75) AS p75, max({name}) AS "max" FROM c"""


def _blank(c: str) -> str:
    return rf"coalesce(regexp_replace({c}, '\s+', '', 'g'), '') = ''"


QUERIES = {
    f.__name__: f
    for f in (
        status_distribution, progress_by_type, error_summary, pending_words, velocity_10min, table_row_counts, entry_type_distribution, pos_top15, ordered_level_distribution, source_category_case,
        grammar_top12, senses_per_entry_describe, synonyms_per_sense_describe, relation_polarity_counts, top_topics, referential_audit, unreachable_labels,
    )
}
SQL = {
    "status_distribution": "SELECT status, count(*) AS n, round_even(100.0::DOUBLE * count(*) / (SELECT count(*) FROM words), 2) AS pct FROM words GROUP BY status",
    "progress_by_type": "SELECT entry_type, count(*) AS total, CAST(count_if(status = 'done') AS BIGINT) AS done FROM words GROUP BY entry_type",
    "error_summary": f"SELECT error_msg, count(*) AS n FROM words WHERE NOT ({_blank('error_msg')}) GROUP BY error_msg",
    "pending_words": "SELECT DISTINCT id, word, entry_type FROM words WHERE status = 'pending'",
    "velocity_10min": "SELECT substr(strftime(crawled_at, '%Y-%m-%d %H:%M'), 1, 15) || '0' AS bucket, count(*) AS n FROM words WHERE crawled_at IS NOT NULL GROUP BY 1",
    "table_row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES),
    "entry_type_distribution": "SELECT entry_type, count(*) AS n FROM words GROUP BY entry_type",
    "pos_top15": f"SELECT CASE WHEN {_blank('pos')} THEN 'Unknown/Unclassified' ELSE pos END AS pos, count(*) AS n FROM entries GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15",
    "ordered_level_distribution": f"""WITH c AS (SELECT CASE WHEN {_blank('cefr_level')} THEN 'Not Annotated' ELSE upper(trim(cefr_level)) END AS level, count(*) AS n FROM senses GROUP BY 1)
SELECT level, n, CAST(nullif(list_position({list(CEFR_ORDER)!r}, level), 0) AS BIGINT) AS place FROM c""",
    "source_category_case": "SELECT CASE " + " ".join(f"WHEN dictionary_source ILIKE '{p}' THEN '{v}'" for p, v in SOURCES.items()) + " ELSE 'Other' END AS category, count(*) AS n FROM entries GROUP BY 1",
    "grammar_top12": "SELECT grammar, count(*) AS n FROM senses WHERE grammar IS NOT NULL AND grammar <> '' GROUP BY grammar ORDER BY n DESC, grammar LIMIT 12",
    "senses_per_entry_describe": _describe_sql("senses", "entry_id", "n_senses"),
    "synonyms_per_sense_describe": _describe_sql("sense_synonyms", "sense_id", "n_synonyms"),
    "relation_polarity_counts": "SELECT CASE WHEN is_antonym = 1 THEN 'Antonym' ELSE 'Synonym' END AS relation, count(*) AS n FROM sense_synonyms GROUP BY 1",
    "top_topics": "SELECT subject, title, count(*) AS n FROM doc_labels JOIN subjects USING (subject) GROUP BY subject, title ORDER BY n DESC, title LIMIT 20",
    "referential_audit": _audit_sql(),
    "unreachable_labels": "SELECT DISTINCT doc_id, subject FROM doc_labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) OR subject NOT IN (SELECT subject FROM subjects)",
}
