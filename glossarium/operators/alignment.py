"""Alignment of two sense inventories: tasks, candidates, requests, answers, checkpoints and their evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarium.functions.keys import match_keys_column
from glossarium.functions.text import cache_key, effective_pos, effective_word, f1, key_form, map_pos, model_text, numbered_lines, ratio
from glossarium.operators.skew import salted_lookup

ANY_POS = ("n", "v", "a", "r")
#: Parts of speech whose words are looked up under every letter.
WIDE_POS = ("idiom", "phrase", "collocation")
ANSWER = "array<struct<task_id:string,unified_senses:array<struct<definition:string,cambridge_senses:array<string>,wordnet_synsets:array<string>>>>>"


def sense_groups(words: DataFrame, entries: DataFrame, senses: DataFrame) -> DataFrame:
    """(word, pos, sense_id, definition): each sense under its effective word and part of speech."""
    w = words.select(F.col("id").alias("word_id"), "display_form")
    e = entries.select(F.col("id").alias("entry_id"), "word_id", "pos")
    s = senses.select(F.col("id").alias("sense_id"), "entry_id", "definition", "phrase_title")
    return s.join(e, "entry_id").join(w, "word_id").select(effective_word("phrase_title", "display_form").alias("word"), effective_pos("pos").alias("pos"), "sense_id", "definition").where("word is not null")


def tasks(groups: DataFrame) -> DataFrame:
    """(word, pos) of all groups, each once."""
    return groups.select("word", "pos").distinct()


def pending(all_tasks: DataFrame, status: DataFrame, done: str = "aligned") -> DataFrame:
    """Tasks that the status table (word, pos, status) does not list as done."""
    return all_tasks.join(status.where(F.col("status") == done).select("word", "pos"), ["word", "pos"], "left_anti")


def search_letters(pos: str, compat: bool = False):
    """array<string> of the letters a task is looked up under; phrasal verbs under v unless compat."""
    p = key_form(pos)
    wide = p.isin(*WIDE_POS)
    letter = map_pos(pos) if not compat else F.when(p == "phrasal verb", F.lit(None)).otherwise(map_pos(pos, compat=True))
    return F.when(wide, F.array(*[F.lit(x) for x in ANY_POS])).when(letter.isNotNull(), F.array(letter)).otherwise(F.array().cast("array<string>"))


def candidate_synsets(all_tasks: DataFrame, lexicon: DataFrame, compat: bool = False) -> DataFrame:
    """(word, pos, synset_id): synsets that share a match key and a letter with the task.

    lexicon: lemma, pos, synset_id; satellites count as adjectives. Keys are made once per distinct word and lemma. The
    lexicon side is reduced to the keys that tasks have before it is joined.
    """
    words = all_tasks.select("word").distinct().select("word", F.explode(match_keys_column("word")).alias("key"))
    asked = all_tasks.select("word", "pos", F.explode(search_letters("pos", compat)).alias("letter")).join(words, "word")
    lemmas = lexicon.select("lemma").distinct().select("lemma", F.explode(match_keys_column("lemma")).alias("key"))
    lemmas = lemmas.join(words.select("key").distinct(), "key", "left_semi")
    letter = F.when(F.col("pos") == "s", "a").otherwise(F.col("pos"))
    held = lexicon.select("lemma", letter.alias("letter"), "synset_id").join(lemmas, "lemma").select("key", "letter", "synset_id").distinct()
    return asked.join(held, ["key", "letter"]).select("word", "pos", "synset_id").distinct()


def bypass(groups: DataFrame, candidates: DataFrame) -> DataFrame:
    """Senses of tasks without candidates, each a unified sense of its own: (word, pos, definition, sense_ids, synset_ids)."""
    alone = groups.join(candidates.select("word", "pos").distinct(), ["word", "pos"], "left_anti")
    return alone.select("word", "pos", "definition", F.array("sense_id").alias("sense_ids"), F.array().cast("array<string>").alias("synset_ids"))


def backfill(groups: DataFrame, answered: DataFrame) -> DataFrame:
    """Rows of the answered tasks, and of every task without answer its senses one by one."""
    return answered.unionByName(bypass(groups, answered.select("word", "pos")))


def rendered_tasks(groups: DataFrame, candidates: DataFrame, synsets: DataFrame) -> DataFrame:
    """(word, pos, sense_ids, synset_ids, prompt): the numbered choices of each task that has candidates.

    Senses are numbered by id, synsets by id; what stands at number i of the prompt is element i of the arrays.
    """
    left = groups.groupBy("word", "pos").agg(F.array_sort(F.collect_list(F.struct("sense_id", "definition"))).alias("s"))
    right = candidates.join(synsets.select("synset_id", "definition"), "synset_id").groupBy("word", "pos").agg(F.array_sort(F.collect_list(F.struct("synset_id", "definition"))).alias("y"))
    text = lambda c: numbered_lines(F.transform(c, lambda x: F.coalesce(x["definition"], F.lit(""))))
    prompt = F.concat(
        F.lit('<task id="'), F.col("word"), F.lit("_"), F.col("pos"), F.lit('">\n<target_word>'), F.col("word"), F.lit("</target_word>\n<dictionary_senses>\n"), text("s"),
        F.lit("\n</dictionary_senses>\n<lexicon_synsets>\n"), text("y"), F.lit("\n</lexicon_synsets>\n</task>"),
    )
    return left.join(right, ["word", "pos"]).select(
        "word", "pos", F.transform("s", lambda x: x["sense_id"]).alias("sense_ids"), F.transform("y", lambda x: x["synset_id"]).alias("synset_ids"), prompt.alias("prompt")
    )


def answers(requests: DataFrame, cache: DataFrame, model: Callable[[str, str], str], system: str, effort: str = "none", retries: int = 3) -> DataFrame:
    """(key, content): the model's answer to every request (column prompt), from the cache (key, content) where it has it.

    The model is any function of system and user text; it is asked in Arrow batches, each distinct request once, and
    at most `retries` times. What still fails has a null answer and is asked again by the next run.
    """
    keyed = requests.select(cache_key(F.lit(system), "prompt", F.lit(effort)).alias("key"), "prompt").dropDuplicates(["key"])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for prompt in batch["prompt"]:
                answer = None
                for _ in range(retries):
                    try:
                        answer = model(system, prompt)
                        break
                    except Exception:  # noqa: BLE001  whatever the model raises counts as no answer
                        continue
                out.append(answer)
            yield pd.DataFrame({"key": batch["key"], "content": out})

    known = cache.where("content is not null").select("key", "content")
    new = keyed.join(known, "key", "left_anti").mapInPandas(ask, "key string, content string")
    return known.join(keyed, "key", "left_semi").unionByName(new)


def parsed_answers(content: DataFrame, text: str = "content") -> DataFrame:
    """(task_id, place, definition, left, right): one row per unified sense of every readable answer.

    An answer is an object with `results`, a list, or a single object, possibly with reasoning and code fences around
    it; what cannot be read gives no rows. left and right are the numbers named, as integers: text and fractions are
    cut to whole numbers, what is no number is dropped, repeats count once.
    """
    v = F.try_parse_json(model_text(text))
    items = F.coalesce(
        F.try_variant_get(v, "$.results", ANSWER),
        F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", ANSWER)),
        F.array(F.try_variant_get(v, "$", ANSWER[len("array<") : -1])),
    )
    number = lambda a: F.array_distinct(F.filter(F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: x.try_cast("double").cast("int")), lambda x: x.isNotNull()))
    flat = content.select(F.explode(items).alias("t")).where("t.task_id is not null").select("t.task_id", F.posexplode("t.unified_senses").alias("place", "u")).where("u is not null")
    return flat.select("task_id", "place", F.trim(F.coalesce("u.definition", F.lit(""))).alias("definition"), number(F.col("u.cambridge_senses")).alias("left"), number(F.col("u.wordnet_synsets")).alias("right"))


def resolved(parsed: DataFrame, rendered: DataFrame) -> DataFrame:
    """(word, pos, definition, sense_ids, synset_ids): the numbers of parsed answers replaced by what they stand for;
    unknown tasks and numbers are dropped."""
    ids = lambda numbers, values: F.array_distinct(F.transform(F.filter(numbers, lambda i: (i >= 1) & (i <= F.size(values))), lambda i: F.get(F.col(values), i - 1)))
    known = rendered.select(F.concat("word", F.lit("_"), "pos").alias("task_id"), "word", "pos", "sense_ids", "synset_ids")
    return parsed.join(known, "task_id").select("word", "pos", "definition", ids("left", "sense_ids").alias("sense_ids"), ids("right", "synset_ids").alias("synset_ids"))


def clustering_metrics(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """(task, precision, recall, f1) of clusters (task, cluster, items) by best Jaccard match.

    Items of both inventories stand in one array, marked so that they differ. Precision is the mean over predicted
    clusters of the best Jaccard index with a gold one, recall the mean over gold ones. A task with clusters on one
    side only scores 0. Only clusters that share an item are compared; the others score 0 with each other.
    """
    g = gold.select("task", F.col("cluster").alias("gc"), F.array_distinct("items").alias("gi"))
    p = predicted.select("task", F.col("cluster").alias("pc"), F.array_distinct("items").alias("pi"))
    meet = g.select("task", "gc", F.explode("gi").alias("item")).join(p.select("task", "pc", F.explode("pi").alias("item")), ["task", "item"]).groupBy("task", "gc", "pc").agg(F.count(F.lit(1)).alias("both"))
    sized = meet.join(g.select("task", "gc", F.size("gi").alias("gn")), ["task", "gc"]).join(p.select("task", "pc", F.size("pi").alias("pn")), ["task", "pc"])
    scored = sized.withColumn("j", F.col("both") / (F.col("gn") + F.col("pn") - F.col("both")))

    def side(clusters: DataFrame, c: str, name: str) -> DataFrame:
        best = scored.groupBy("task", c).agg(F.max("j").alias("j"))
        return clusters.join(best, ["task", c], "left").groupBy("task").agg(F.avg(F.coalesce("j", F.lit(0.0))).alias(name))

    both = side(p, "pc", "precision").join(side(g, "gc", "recall"), "task", "full_outer")
    filled = both.select("task", F.coalesce("precision", F.lit(0.0)).alias("precision"), F.coalesce("recall", F.lit(0.0)).alias("recall"))
    return filled.withColumn("f1", f1("precision", "recall"))


def evaluation_report(metrics: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """One row: tasks, macro means in percent, and the share of tasks (in percent) that needed no request."""
    out = metrics.agg(F.count(F.lit(1)).alias("tasks"), *[F.round(F.avg(c) * 100, 4).alias(c) for c in ("precision", "recall", "f1")])
    if asked is None:
        return out
    calls = asked.select("task").distinct().agg(F.count(F.lit(1))).scalar()
    return out.withColumn("calls", calls).withColumn("bypass_pct", F.round((1 - ratio("calls", "tasks")) * 100, 4))


def export(unified: DataFrame) -> DataFrame:
    """(task_id, json): per word and part of speech its unified senses with both lists of ids, in order of id."""
    one = F.struct("id", F.col("definition"), F.coalesce(F.array_sort("sense_ids"), F.array().cast("array<bigint>")).alias("dictionary_sense_ids"), F.coalesce(F.array_sort("synset_ids"), F.array().cast("array<string>")).alias("synset_ids"))
    rows = unified.groupBy(F.concat("word", F.lit("_"), "pos").alias("task_id")).agg(F.array_sort(F.collect_list(one)).alias("s"))
    return rows.select("task_id", F.to_json(F.transform("s", lambda x: F.struct(x["definition"].alias("definition"), x["dictionary_sense_ids"].alias("dictionary_sense_ids"), x["synset_ids"].alias("synset_ids")))).alias("json"))


def with_sentiment(synset_ids: DataFrame, scores: DataFrame) -> DataFrame:
    """(wordnet_id, pos_score, neg_score, obj_score, mapped): the scores of each synset, objective where it has none."""
    s = scores.select(F.col("synset_id").alias("wordnet_id"), "pos_score", "neg_score", "obj_score")
    joined = synset_ids.where(F.col("wordnet_id").startswith("oewn-")).select("wordnet_id").distinct().join(s, "wordnet_id", "left")
    return joined.select("wordnet_id", *[F.coalesce(c, F.lit(d)).alias(c) for c, d in (("pos_score", 0.0), ("neg_score", 0.0), ("obj_score", 1.0))], F.col("obj_score").isNotNull().alias("mapped"))


def enriched_synonyms(synonyms: DataFrame, unified: DataFrame, links: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(sense_id, synonym): a sense's own synonyms and the lemmas of the synsets it is unified with, in key form."""
    own = synonyms.where("is_antonym = 0").select("sense_id", key_form("synonym").alias("synonym"))
    linked = unified.where("cambridge_sense_id is not null").select(F.col("id").alias("unified_sense_id"), F.col("cambridge_sense_id").alias("sense_id")).join(links.select("unified_sense_id", F.col("wordnet_id").alias("synset_id")), "unified_sense_id")
    more = salted_lookup(linked.select("sense_id", "synset_id"), lemmas.groupBy("synset_id").agg(F.collect_set(key_form("lemma")).alias("l")), ["synset_id"], ["sense_id"])
    return own.unionByName(more.select("sense_id", F.explode("l").alias("synonym"))).where("synonym <> ''").distinct()
