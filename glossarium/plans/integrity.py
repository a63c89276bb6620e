"""Queries over references between the dictionary and alignment tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.operators.orphans import DIRECT, ForeignKey, Keyed, orphan_cascade, orphan_report
from glossarium.sources.tables import load

KEYS = (
    ForeignKey("sense_synonyms", "target_sense_id", "senses"),
    ForeignKey("unified_senses", "cambridge_sense_id", "senses"),
    ForeignKey("unified_sense_wordnet_links", "unified_sense_id", "unified_senses"),
)
#: All references of the lexicon, down which orphans are inherited.
GRAPH = (
    ForeignKey("entries", "word_id", "words"),
    ForeignKey("entry_inflections", "entry_id", "entries"),
    ForeignKey("senses", "entry_id", "entries"),
    ForeignKey("sense_synonyms", "sense_id", "senses"),
    *KEYS,
)


def lexicon_tables(spark: SparkSession, sf_dir: str) -> dict[str, Keyed]:
    by_id = F.col("id").cast("string")
    return {
        "words": Keyed(load(spark, sf_dir, "words", "id", "crawled_at"), by_id, "crawled_at"),
        "entries": Keyed(load(spark, sf_dir, "entries", "id", "word_id"), by_id),
        "entry_inflections": Keyed(load(spark, sf_dir, "entry_inflections", "id", "entry_id"), by_id),
        "senses": Keyed(load(spark, sf_dir, "senses", "id", "entry_id", "loaded_at"), by_id, "loaded_at"),
        "sense_synonyms": Keyed(load(spark, sf_dir, "sense_synonyms", "id", "sense_id", "target_sense_id", "loaded_at"), by_id, "loaded_at"),
        "unified_senses": Keyed(load(spark, sf_dir, "unified_senses", "id", "cambridge_sense_id", "loaded_at"), by_id, "loaded_at"),
        "unified_sense_wordnet_links": Keyed(
            load(spark, sf_dir, "unified_sense_wordnet_links", "unified_sense_id", "wordnet_id", "loaded_at"),
            F.concat(F.coalesce(F.col("unified_sense_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("wordnet_id", F.lit(""))),
            "loaded_at",
        ),
    }


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The direct orphans of the cascade; what it would inherit is not computed, as nothing asks for it."""
    found = orphan_cascade(lexicon_tables(spark, sf_dir), KEYS).where(F.col("kind") == DIRECT)
    return found.select("source_table", "row_key", F.col("missing_key").cast("bigint").alias("missing_key"))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, reference and month of load over all references, direct and inherited."""
    return orphan_report(lexicon_tables(spark, sf_dir), GRAPH)


_FOUND = """
SELECT DISTINCT 'sense_synonyms' AS source_table, CAST(id AS VARCHAR) AS row_key, target_sense_id AS missing_key
FROM sense_synonyms WHERE target_sense_id IS NOT NULL AND target_sense_id NOT IN (SELECT id FROM senses)
UNION ALL
SELECT DISTINCT 'unified_senses', CAST(id AS VARCHAR), cambridge_sense_id
FROM unified_senses WHERE cambridge_sense_id IS NOT NULL AND cambridge_sense_id NOT IN (SELECT id FROM senses)
UNION ALL
SELECT DISTINCT 'unified_sense_wordnet_links', unified_sense_id || '|' || wordnet_id, unified_sense_id
FROM unified_sense_wordnet_links WHERE unified_sense_id IS NOT NULL AND unified_sense_id NOT IN (SELECT id FROM unified_senses)
"""

_ROW_KEY = {"unified_sense_wordnet_links": "coalesce(CAST(unified_sense_id AS VARCHAR), '') || '|' || coalesce(wordnet_id, '')"}
_LOADED = {"words": "crawled_at", "senses": "loaded_at", "sense_synonyms": "loaded_at", "unified_senses": "loaded_at", "unified_sense_wordnet_links": "loaded_at"}


def _report_sql() -> str:
    """One step per table, parents first: its direct orphans, those inherited from the steps before, and both with months."""
    steps, found = [], []
    for table in ("words", "entries", "entry_inflections", "senses", "sense_synonyms", "unified_senses", "unified_sense_wordnet_links"):
        key, month = _ROW_KEY.get(table, "CAST(id AS VARCHAR)"), _LOADED.get(table)
        parts = [f"SELECT '' AS k, '' AS reference, '' AS kind FROM {table} WHERE false"]
        for fk in (k for k in GRAPH if k.child == table):
            parts.append(f"SELECT DISTINCT {key}, '{fk.name}', 'direct' FROM {table} WHERE {fk.column} IS NOT NULL AND {fk.column} NOT IN (SELECT id FROM {fk.parent})")
            parts.append(f"SELECT DISTINCT {key}, '{fk.name}', 'inherited' FROM {table} WHERE CAST({fk.column} AS VARCHAR) IN (SELECT k FROM o_{fk.parent})")
        steps.append(f"o_{table} AS ({' UNION ALL '.join(parts)})")
        loaded = f"strftime(min({month}), '%Y-%m')" if month else "CAST(NULL AS VARCHAR)"
        steps.append(f"m_{table} AS (SELECT {key} AS k, {loaded} AS month FROM {table} GROUP BY 1)")
        found.append(f"SELECT '{table}' AS source_table, reference, month, kind FROM o_{table} JOIN m_{table} USING (k)")
    return f"WITH {', '.join(steps)} SELECT source_table, reference, month, kind, count(*) AS orphan_rows FROM ({' UNION ALL '.join(found)}) GROUP BY ALL"


_REPORT = _report_sql()

QUERIES = {"p6_found": p6_found, "p6_report": p6_report}
SQL = {"p6_found": _FOUND, "p6_report": _REPORT}
