"""Readers and writers of the file formats around the lexicon."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossarium.functions.text import json_weight, synset_of_url
from glossarium.operators.relational import keep_one, upsert

CLUSTERS = "map<string,array<struct<definition:string,cambridge_sense_ids:array<bigint>,wordnet_synset_ids:array<string>>>>"
# Relations of the concept graph that are kept.
KEPT_RELATIONS = ("/r/UsedFor", "/r/CapableOf", "/r/HasProperty", "/r/PartOf", "/r/MadeOf", "/r/Causes", "/r/Synonym", "/r/Antonym")


def ragged_words(lines: DataFrame, column: str = "value") -> DataFrame:
    """(word, display_form, entry_type) from tab-separated lines of one to three columns; the slug stands for what is
    missing, and the type is then "word". Blank lines are left out; of equal slugs the first by display form stays."""
    parts = F.split(F.trim(column), "\t")
    rows = lines.where(F.trim(column) != "").select(parts.alias("p"))
    out = rows.select(
        F.col("p")[0].alias("word"),
        F.when(F.size("p") >= 3, F.get("p", 1)).otherwise(F.col("p")[0]).alias("display_form"),
        F.when(F.size("p") >= 3, F.get("p", 2)).when(F.size("p") == 2, F.get("p", 1)).otherwise("word").alias("entry_type"),
    )
    return keep_one(out, ["word"], ["display_form", "entry_type"])


def read_ragged_words(spark: SparkSession, path: str) -> DataFrame:
    return ragged_words(spark.read.text(path))


def load_words(registry: DataFrame, listed: DataFrame) -> DataFrame:
    """The word registry (word, display_form, entry_type, status) after a list was loaded: new words are pending; known ones
    get the listed type, and the listed display form where theirs was only the slug."""
    new = listed.join(registry.select("word"), "word", "left_anti").withColumn("status", F.lit("pending"))
    shown = registry.join(listed.select("word", F.col("display_form").alias("__d"), F.col("entry_type").alias("__t")), "word", "left")
    known = shown.withColumns({"display_form": F.coalesce(F.nullif("display_form", F.col("word")), "__d", "display_form"), "entry_type": F.coalesce("__t", "entry_type")}).drop("__d", "__t")
    return known.unionByName(new, allowMissingColumns=True)


def concept_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(relation, start, end, metadata) of edge lines with at least five columns."""
    parts = F.split(F.trim(column), "\t")
    return lines.where(F.size(parts) >= 5).select(parts[1].alias("relation"), parts[2].alias("start"), parts[3].alias("end"), parts[4].alias("metadata"))


def read_concept_edges(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Edges of a (gzipped) file; a gzip file is one split, so its lines are spread before anything is done with them."""
    lines = spark.read.text(path)
    return concept_lines(lines.repartition(partitions or spark.sparkContext.defaultParallelism))


def concept_relations(edges: DataFrame) -> DataFrame:
    """(start_concept, relation, end_concept, weight): kept relations between English concepts, no loops."""
    english = F.col("start").startswith("/c/en/") & F.col("end").startswith("/c/en/")
    kept = edges.where(F.col("relation").isin(*KEPT_RELATIONS) & english & (F.col("start") != F.col("end")))
    return kept.select(F.col("start").alias("start_concept"), "relation", F.col("end").alias("end_concept"), json_weight("metadata").alias("weight"))


def concept_senses(edges: DataFrame) -> DataFrame:
    """(conceptnet_uri, wordnet_id): concepts with an address in the lexicon; of several the last by address stays."""
    named = edges.where((F.col("relation") == "/r/ExternalURL") & F.col("start").startswith("/c/en/") & F.col("start").endswith("/wn") & F.col("end").contains("wordnet-rdf"))
    return keep_one(named.select(F.col("start").alias("conceptnet_uri"), synset_of_url("end").alias("wordnet_id")).where("wordnet_id is not null"), ["conceptnet_uri"], ["wordnet_id"], last=True)


def read_word_array(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(place, word) of a JSON array of strings, or of its first `limit` elements."""
    text = spark.read.text(path, wholetext=True)
    out = text.select(F.posexplode(F.from_json("value", "array<string>")).alias("place", "word"))
    return out.where(F.col("place") < limit) if limit is not None else out


def clusters_of(json_text: DataFrame, column: str = "value") -> DataFrame:
    """(task_id, word, pos, cluster, definition, sense_ids, synset_ids) of a JSON object of tasks; `word_pos` is cut at its last
    underscore."""
    tasks = json_text.select(F.explode(F.from_json(column, CLUSTERS)).alias("task_id", "senses"))
    rows = tasks.select("task_id", F.posexplode("senses").alias("cluster", "s"))
    return rows.select(
        "task_id", F.regexp_extract("task_id", "^(.*)_([^_]*)$", 1).alias("word"), F.regexp_extract("task_id", "^(.*)_([^_]*)$", 2).alias("pos"), "cluster",
        "s.definition", F.col("s.cambridge_sense_ids").alias("sense_ids"), F.col("s.wordnet_synset_ids").alias("synset_ids"),
    )


def sense_key(sense_id: str):
    """Key of a lexicon sense as the sentiment list writes it, from its id: five letters less, `__` is %, `.` is :."""
    return F.regexp_replace(F.regexp_replace(F.substring(sense_id, 6, 1_000_000), "__", "%"), r"\.", ":")


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the columns of the schema: missing ones are added as null, further ones are kept behind them."""
    own = set(df.columns)
    listed = [F.col(f.name).cast(f.dataType) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*[c.alias(f.name) for c, f in zip(listed, schema)], *[c for c in df.columns if c not in schema.names])


def write_words(df: DataFrame, path: str) -> None:
    """Words as tab-separated lines in order of the slug, range-partitioned: part files in order make one sorted file."""
    df.select("word", "display_form", "entry_type").repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").csv(path, sep="\t", quote="")


def append_history(record: DataFrame, path: str) -> None:
    """One more record of an evaluation history."""
    record.withColumn("timestamp", F.current_timestamp()).write.mode("append").json(path)


def overwrite_keys(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], buckets: int = 16) -> None:
    """Replace, in a Parquet table at path, all rows whose key is among the new ones; repeating it changes nothing.

    The table is kept in buckets by hash of the key, and only the buckets that new rows fall into are rewritten: by
    dynamic partition overwrite, from a copy that is read in full before.
    """
    from glossarium.session import cut

    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    incoming = new.withColumn("bucket", bucket)
    try:
        old = spark.read.parquet(path)
    except Exception as missing:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
            raise
        old = None
    if old is not None:
        touched = old.join(F.broadcast(incoming.select("bucket").distinct()), "bucket", "left_semi").select(*incoming.columns)
        incoming = cut(upsert(touched, incoming, keys))
    incoming.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def table_statistics(spark: SparkSession, name: str) -> None:
    """Statistics for the optimizer, on the table and its columns."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def catalog_columns(spark: SparkSession) -> DataFrame:
    """(table_name, column_name, data_type) of every table and view of the session."""
    rows = [(t.name, c.name, c.dataType) for t in spark.catalog.listTables() for c in spark.catalog.listColumns(t.name)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
