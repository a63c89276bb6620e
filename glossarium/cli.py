"""Command line: collect, crawl, synonyms, align, evaluate, import-concepts, import-sentiment and build, each over stored tables.

Pages are read from a landed table (url, html), not from the network; the model and the encoder are named as
`module:function` and are imported.
"""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.functions import pages as pg
from glossarium.functions import redirects as rd
from glossarium.functions import text as tx
from glossarium.operators import alignment as al
from glossarium.operators import batching as ba
from glossarium.operators import consolidate as co
from glossarium.operators import relational as re
from glossarium.operators import synonyms as sy
from glossarium.operators import variants as va
from glossarium.session import build_session, cut
from glossarium.sources import files as fi
from glossarium.sources import schemas as sc

SYSTEM = "Group the numbered senses of both inventories by meaning. Answer with one JSON object."


def _read(spark: SparkSession, db: str, name: str) -> DataFrame:
    """A stored table, or an empty one of its schema; columns that are missing are added as null."""
    try:
        return fi.evolve(spark.read.parquet(f"{db}/{name}"), sc.schema(name))
    except Exception as missing:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], sc.schema(name))


def _write(df: DataFrame, db: str, name: str) -> None:
    cut(df).write.mode("overwrite").parquet(f"{db}/{name}")


def _load(path: str):
    """A function named `module:function`; its module travels to the workers with it."""
    name, _, function = path.partition(":")
    module = importlib.import_module(name)
    cloudpickle.register_pickle_by_value(module)
    return getattr(module, function)


def collect(spark: SparkSession, args: argparse.Namespace) -> None:
    """Word list from landed list pages: the last page in order that names a slug gives its title."""
    pages = spark.read.parquet(args.pages)
    found = pages.select("url", F.inline(pg.entry_links("html")))
    last = re.keep_one(found, ["slug"], ["url"], last=True)
    words = last.select(F.col("slug").alias("word"), tx.title_display("slug", "title").alias("display_form"), tx.title_type("slug", "title").alias("entry_type"))
    fi.write_words(words, args.output)


def crawl(spark: SparkSession, args: argparse.Namespace) -> None:
    """Registry and entries from landed word pages, then redirects and variants."""
    registry = _read(spark, args.db, "words")
    if args.words:
        listed = fi.read_ragged_words(spark, args.words)
        loaded = fi.load_words(registry.drop("id"), listed)
        _write(re.surrogate_ids(loaded, ["word"]).select(*sc.schema("words").names), args.db, "words")
        registry = _read(spark, args.db, "words")
    if args.stats:
        registry.groupBy("entry_type", "status").count().orderBy("entry_type", "status").show(100, truncate=False)
    if args.load_only or args.stats or not args.pages:
        return
    parsed = cut(spark.read.parquet(args.pages).join(registry.select(F.col("id").alias("word_id"), "word"), "word").select("word_id", F.explode(pg.parse_page_column("html")).alias("e")))
    entries = re.surrogate_ids(parsed.select("word_id", "e.*"), ["word_id", "entry_order"])
    entries = cut(entries.withColumnRenamed("id", "entry_id"))
    flat = entries.select("entry_id", "word_id", "pos", F.explode("senses").alias("s"))
    redirect = rd.is_redirect("s.definition")
    senses = cut(re.surrogate_ids(flat.where(~redirect).select("entry_id", "s.*"), ["entry_id", "sense_order"]))
    kept = flat.where(redirect).select("word_id", "pos", F.col("s.definition").alias("definition")).distinct()
    table = entries.withColumnRenamed("entry_id", "id").select(*sc.schema("entries").names)
    stored = senses.withColumn("labels", F.to_json("labels")).select(*sc.schema("senses").names)
    variants = va.parsed_redirects(kept, registry)
    mapping = cut(va.british_to_american(variants))
    _write(va.moved_entries(table, stored, registry, mapping), args.db, "entries")
    _write(stored, args.db, "senses")
    _write(va.alternatives(variants, mapping, registry), args.db, "word_alternatives")
    synonyms = senses.select(F.col("id").alias("sense_id"), F.inline("synonyms"))
    _write(fi.evolve(re.surrogate_ids(synonyms, ["sense_id", "slug", "synonym"]), sc.schema("sense_synonyms")), args.db, "sense_synonyms")
    examples = senses.select(F.col("id").alias("sense_id"), F.posexplode("examples").alias("example_order", "x")).select("sense_id", "example_order", F.col("x.text").alias("example"), "x.is_extra", "x.collocation")
    _write(fi.evolve(re.surrogate_ids(examples, ["sense_id", "example_order"]), sc.schema("examples")), args.db, "examples")
    _write(fi.evolve(re.surrogate_ids(entries.select("entry_id", F.inline("inflections")), ["entry_id", "form_type", "inflected_form"]), sc.schema("entry_inflections")), args.db, "entry_inflections")
    topics = entries.select("word_id", F.inline("topics"))
    ids = cut(re.surrogate_ids(re.keep_one(topics.select("slug", "title", "url"), ["slug"], ["title", "url"]), ["slug"]))
    _write(ids.select(*sc.schema("topics").names), args.db, "topics")
    _write(topics.join(ids.select("slug", F.col("id").alias("topic_id")), "slug").select("word_id", "topic_id").distinct(), args.db, "word_topics")
    done = registry.join(entries.select(F.col("word_id").alias("id")).distinct().withColumn("__done", F.lit(True)), "id", "left")
    marked = va.renamed_words(done.withColumn("status", F.when(F.col("__done"), "done").otherwise(F.col("status"))).withColumn("crawled_at", F.when(F.col("__done"), F.current_timestamp()).otherwise(F.col("crawled_at"))).select(*sc.schema("words").names), mapping)
    seen = topics.select(F.explode("related_slugs").alias("word")).distinct().join(registry.select("word"), "word", "left_anti").select("word", F.regexp_replace("word", "-", " ").alias("display_form"), F.lit("word").alias("entry_type"), F.lit("seen").alias("status"))
    top = marked.agg(F.max("id")).first()[0] or 0
    new = fi.evolve(re.surrogate_ids(seen, ["word"]).withColumn("id", F.col("id") + top), sc.schema("words"))
    _write(marked.unionByName(new), args.db, "words")


def synonyms(spark: SparkSession, args: argparse.Namespace) -> None:
    """Resolve synonym strings to senses; --dry-run only counts."""
    s, e, w, table = (_read(spark, args.db, n) for n in ("senses", "entries", "words", "sense_synonyms"))
    base = cut(s.select(F.col("id").alias("sense_id"), "entry_id").join(e.select(F.col("id").alias("entry_id"), "word_id", "pos"), "entry_id").join(w.select(F.col("id").alias("word_id"), F.col("word").alias("slug"), "display_form"), "word_id"))
    open_ = table.where("is_antonym = 0") if args.rebuild else table.where("is_antonym = 0 and target_sense_id is null")
    relations = open_.join(base.select("sense_id", "pos"), "sense_id").select(F.col("id").alias("relation_id"), F.col("sense_id").alias("source_sense_id"), "synonym", "pos")
    own = table.where("is_antonym = 0").select("sense_id", tx.key_form("synonym").alias("synonym")).where("synonym is not null").distinct()
    encode = _load(args.encoder) if args.encoder else None
    found = cut(sy.resolve(relations, base.withColumn("word", tx.display_name("display_form", "slug")), own, encode))
    sy.stage_counts(relations, found).show(truncate=False)
    if not args.dry_run:
        _write(sy.write_back(table, found), args.db, "sense_synonyms")


def align(spark: SparkSession, args: argparse.Namespace) -> None:
    """Unified senses of all pending tasks; tasks without candidates and without answer stay one by one."""
    words, entries, senses = (_read(spark, args.db, n) for n in ("words", "entries", "senses"))
    lexicon = spark.read.parquet(f"{args.lexicon}/wn_sense")
    synsets = spark.read.parquet(f"{args.lexicon}/wn_synset")
    groups = cut(al.sense_groups(words, entries, senses))
    todo = al.pending(al.tasks(groups), _read(spark, args.db, "word_pos_alignment_status"))
    if args.limit:
        todo = todo.orderBy("word", "pos").limit(args.limit)
    todo = cut(todo)
    groups = groups.join(todo, ["word", "pos"], "left_semi")
    found = cut(al.candidate_synsets(todo, lexicon.join(synsets.select("synset_id", "pos"), "synset_id") if "pos" not in lexicon.columns else lexicon))
    rendered = cut(al.rendered_tasks(groups, found, synsets))
    cost = {"mul": ba.difficulty(F.size("sense_ids"), F.size("synset_ids")), "add": ba.difficulty(F.size("sense_ids"), F.size("synset_ids"), "add"), "token": ba.token_difficulty("prompt")}[args.difficulty_method]
    weighed = rendered.withColumn("task_id", F.concat("word", F.lit("_"), "pos")).withColumn("cost", cost)
    batches = cut(ba.balanced_batches(weighed, "task_id", "cost", args.batch_size))
    ba.batch_report(batches).show(truncate=False)
    prompts = weighed.join(batches.select(F.col("id").alias("task_id"), "batch"), "task_id").groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list("prompt")), "\n\n").alias("prompt"))
    cache = cut(_read(spark, args.db, "response_cache"))
    answers = cut(al.answers(prompts, cache, _load(args.model), SYSTEM, args.reasoning_effort))
    _write(answers.where("content is not null").unionByName(cache.select("key", "content")).dropDuplicates(["key"]), args.db, "response_cache")
    parsed = cut(al.parsed_answers(answers))
    # Tasks that the model was asked and whose answer failed stay pending and are asked again by the next run.
    failed = weighed.join(parsed.select("task_id").distinct(), "task_id", "left_anti").select("word", "pos").distinct()
    done = cut(todo.join(failed, ["word", "pos"], "left_anti"))
    unified = cut(al.backfill(groups.join(done, ["word", "pos"], "left_semi"), al.resolved(parsed, rendered)))
    numbered = cut(re.surrogate_ids(unified.withColumn("cambridge_sense_id", F.get("sense_ids", 0)), ["word", "pos", "definition", "cambridge_sense_id"]))
    old = _read(spark, args.db, "unified_senses")
    top = old.agg(F.max("id")).first()[0] or 0
    new = numbered.withColumn("id", F.col("id") + top)
    replaced = cut(old.join(new.select("word", "pos").distinct(), ["word", "pos"], "left_semi").select(F.col("id").alias("unified_sense_id")).distinct())
    _write(re.upsert(old, new.select(*sc.schema("unified_senses").names), ["word", "pos"]), args.db, "unified_senses")
    links = new.select(F.col("id").alias("unified_sense_id"), F.explode("synset_ids").alias("wordnet_id")).distinct()
    kept = _read(spark, args.db, "unified_sense_wordnet_links").join(replaced, "unified_sense_id", "left_anti")
    _write(kept.unionByName(links, allowMissingColumns=True), args.db, "unified_sense_wordnet_links")
    _write(re.upsert(_read(spark, args.db, "word_pos_alignment_status"), done.withColumn("status", F.lit("aligned")), ["word", "pos"]), args.db, "word_pos_alignment_status")
    if args.output:
        al.export(new).write.mode("overwrite").json(args.output)


def evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Predicted against gold clusters, both JSON objects of tasks; the report is appended to a history."""

    def clusters(path: str) -> DataFrame:
        c = fi.clusters_of(spark.read.text(path, wholetext=True))
        items = F.concat(F.transform("sense_ids", lambda i: F.concat(F.lit("d:"), i.cast("string"))), F.transform("synset_ids", lambda i: F.concat(F.lit("w:"), i)))
        return c.select(F.col("task_id").alias("task"), "cluster", items.alias("items"))

    gold = clusters(args.gt)
    if args.limit:
        gold = gold.join(gold.select("task").distinct().orderBy("task").limit(args.limit), "task", "left_semi")
    predicted = clusters(args.predicted).join(gold.select("task").distinct(), "task", "left_semi")
    report = al.evaluation_report(al.clustering_metrics(gold, predicted))
    report.show(truncate=False)
    if args.history:
        fi.append_history(report, args.history)


def import_concepts(spark: SparkSession, args: argparse.Namespace) -> None:
    edges = cut(fi.read_concept_edges(spark, args.edges))
    _write(fi.concept_senses(edges), args.db, "conceptnet_sense_mappings")
    _write(fi.concept_relations(edges), args.db, "conceptnet_relations")


def import_sentiment(spark: SparkSession, args: argparse.Namespace) -> None:
    scores = al.with_sentiment(_read(spark, args.db, "unified_sense_wordnet_links"), spark.read.parquet(args.scores))
    _write(scores.drop("mapped"), args.db, "wordnet_sentiment")


def build(spark: SparkSession, args: argparse.Namespace) -> None:
    """The consolidated tables from all stored ones."""
    t = {n: _read(spark, args.db, n) for n in sc.DDL}
    lexicon = lambda n, ddl: spark.read.parquet(f"{args.lexicon}/{n}") if args.lexicon else spark.createDataFrame([], ddl)
    synsets, lemmas = lexicon("wn_synset", "synset_id string, definition string"), lexicon("wn_sense", "synset_id string, lemma string")
    words = co.build_words(t["words"], t["unified_senses"])
    entries, entry_map = co.build_entries(t["entries"], words, t["unified_senses"])
    senses = co.build_senses(t["unified_senses"], t["senses"], entries, words)
    links = t["unified_sense_wordnet_links"]
    rel = lexicon("wn_sense_rel", "src_lemma string, src_synset string, rel string, tgt_lemma string, tgt_synset string")
    out = {
        "words": words.drop("key"),
        "entries": entries,
        "entry_inflections": co.build_inflections(t["entry_inflections"], entry_map, entries),
        "senses": senses,
        "alternative_definitions": co.build_definitions(senses, t["senses"], links, synsets),
        "synonyms_antonyms": co.build_synonyms(t["sense_synonyms"], senses).unionByName(co.build_lexicon_synonyms(senses, links, lemmas)).unionByName(co.build_lexicon_antonyms(senses, links, rel)),
        "examples": co.build_examples(t["examples"], senses, links, lexicon("wn_example", "synset_id string, ord int, example string")),
        "collocations": co.build_collocations(t["collocations"], words),
        "topics": t["topics"].select("id", "slug", "title"),
        "sense_topics": co.build_sense_topics(t["word_topics"], words, entries, senses),
        "semantic_relations": co.build_relations(senses, links, lexicon("wn_synset_rel", "src string, rel string, tgt string"), rel, t["conceptnet_relations"], t["conceptnet_sense_mappings"]),
    }
    for name, df in out.items():
        df.write.mode("overwrite").parquet(f"{args.output}/{name}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="glossarium")
    sub = p.add_subparsers(dest="command", required=True)

    def command(function, *options: tuple) -> None:
        c = sub.add_parser(function.__name__.replace("_", "-"), help=(function.__doc__ or "").split("\n")[0])
        for names, settings in options:
            c.add_argument(*names, **settings)
        c.set_defaults(run=function)

    db = (("--db",), {"default": "data/tables"})
    model = [(("--model",), {"required": True}), (("--reasoning-effort",), {"default": "none"}), (("--limit",), {"type": int})]
    command(collect, (("--pages",), {"required": True}), (("--output",), {"default": "data/words"}))
    command(crawl, db, (("--words",), {}), (("--pages",), {}), (("--load-only",), {"action": "store_true"}), (("--stats",), {"action": "store_true"}))
    command(synonyms, db, (("--encoder",), {}), (("--dry-run",), {"action": "store_true"}), (("--rebuild",), {"action": "store_true"}))
    command(align, db, *model, (("--lexicon",), {"required": True}), (("--output",), {}), (("--batch-size",), {"type": int, "default": 8}), (("--difficulty-method",), {"choices": ["mul", "add", "token"], "default": "token"}))
    command(evaluate, (("--gt",), {"required": True}), (("--predicted",), {"required": True}), (("--limit",), {"type": int}), (("--history",), {}))
    command(import_concepts, db, (("--edges",), {"required": True}))
    command(import_sentiment, db, (("--scores",), {"required": True}))
    command(build, db, (("--lexicon",), {}), (("--output",), {"required": True}))
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(f"glossarium {args.command}"), args)


if __name__ == "__main__":
    main()
