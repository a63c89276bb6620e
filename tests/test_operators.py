import random

import pytest
from pyspark.sql import functions as F

from glossarium.operators import alignment as al
from glossarium.operators import batching as ba
from glossarium.operators import consolidate as co
from glossarium.operators import relational as re
from glossarium.operators import synonyms as sy
from glossarium.operators import variants as va
from glossarium.operators.orphans import ForeignKey, Keyed, missing_references, orphan_cascade, orphan_report


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ranked_matches_sorting(spark):
    data = [(random.Random(i).choice("aab"), i) for i in range(300)] + [(None, 1000), (None, 1001)]
    got = re.ranked(spark.createDataFrame(data, "k string, v int"), ["k"], ["v"]).collect()
    want = {}
    for k, v in sorted(data, key=lambda x: x[1]):
        want[v] = want.get(("n", k), 0) + 1
        want["n", k] = want[v]
    assert all(want[r["v"]] == r["rank"] for r in got) and len(got) == len(data)
    assert [r["id"] for r in re.surrogate_ids(spark.createDataFrame([(5,), (3,)], "v int"), ["v"]).orderBy("v").collect()] == [1, 2]
    assert re.surrogate_ids(spark.createDataFrame([], "v int"), ["v"]).count() == 0


@pytest.mark.parametrize("slugs", [["x", "x-1", "x"], ["a", "a", "a"], ["x", "x", "x-1"], ["b"], []])
def test_unique_slugs(spark, slugs):
    got = {r["id"]: r["unique_slug"] for r in re.unique_slugs(spark.createDataFrame(list(enumerate(slugs)), "id int, slug string"), "slug", "id").collect()}
    taken, want = set(), {}
    for i, s in enumerate(slugs):
        name, k = s, 0
        while name in taken:
            k += 1
            name = f"{s}-{k}"
        taken.add(name)
        want[i] = name
    assert got == want


def test_first_nonempty_and_keep_one(spark):
    df = spark.createDataFrame([(1, 1, None, "z"), (1, 2, "", "y"), (1, 3, "b", None), (2, 1, None, None)], "k int, o int, v string, w string")
    assert rows(re.first_nonempty(df, ["k"], ["v", "w"], "o")) == [(1, "b", "z"), (2, None, None)]
    assert rows(re.keep_one(df.select("k", "o"), ["k"], ["o"], last=True)) == [(1, 3), (2, 1)]
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(re.upsert(old, new, ["k"])) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(re.upsert(old, new, ["k"], replace=False)) == [(1, "a"), (2, "b"), (3, "d")]


def test_contained_pairs_against_brute_force(spark):
    rnd = random.Random(3)
    sets = [(i, sorted(rnd.sample(["red", "blue", "green", "of", "big", "small", "cat"], rnd.randint(0, 5)))) for i in range(60)]
    got = {(a, b) for a, b, _ in rows(re.contained_pairs(spark.createDataFrame(sets, "id int, t array<string>"), "id", "t"))}
    want = set()
    for i, a in sets:
        for j, b in sets:
            if i != j and set(a) <= set(b) and (len(a) < len(b) or i < j) and a and len(a) >= 0.6 * len(b) and any(len(t) >= 3 for t in a):
                want.add((i, j))
    assert got == want


def test_nearest_and_shares(spark):
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.9, 0.1]), (4, [0.0, 1.0])], "vec_id int, embedding array<float>")
    assert [(r["source"], r["target"]) for r in re.nearest(e.where("vec_id = 1"), e, "vec_id", "embedding").collect()] == [(1, 2)]
    assert rows(re.share_of_total(spark.createDataFrame([("a", 1), ("b", 3)], "k string, n bigint"), "n")) == [("a", 1, 25.0), ("b", 3, 75.0)]
    assert re.describe(spark.createDataFrame([(1,), (2,), (3,), (4,)], "v int"), "v").first()["p25"] == 1.75


def test_longest_first(spark):
    assert ba.assign_longest_first([(5, "a"), (4, "b"), (3, "c"), (3, "d")], 2) == {"a": 0, "b": 1, "d": 1, "c": 0}
    tasks = spark.createDataFrame([(i, float(i % 17)) for i in range(103)], "id bigint, w double")
    out = ba.balanced_batches(tasks, "id", "w", 8)
    loads = [r["s"] for r in out.groupBy("batch").agg(F.sum("weight").alias("s")).collect()]
    assert out.count() == 103 and len(loads) == 13 and max(loads) - min(loads) <= 16
    dealt = ba.balanced_batches(tasks, "id", "w", 8, group=40)
    assert dealt.count() == 103 and dealt.select("id").distinct().count() == 103
    assert ba.balanced_batches(tasks.limit(0), "id", "w", 8).count() == 0


def test_token_difficulty(spark):
    df = spark.createDataFrame([("one two, three",), ("",)], "t string")
    assert [r[0] for r in df.select(ba.token_difficulty("t")).collect()] == [4, 0]
    with pytest.raises(ValueError):
        ba.difficulty("a", "b", "other")


def test_orphans(spark):
    a = spark.createDataFrame([(1, None), (2, 9), (2, 9), (3, 1), (4, 2)], "id bigint, ref bigint")
    tables = {"a": Keyed(a, F.col("id").cast("string"))}
    key = ForeignKey("a", "ref", "a")
    assert rows(missing_references(tables, key)) == [("2", 9)]
    assert rows(orphan_cascade(tables, [key])) == [("a", "2", "a.ref", "direct", "9"), ("a", "4", "a.ref", "inherited", None)]
    top = {"p": Keyed(spark.createDataFrame([(1, None)], "id bigint, up bigint"), F.col("id").cast("string")), "c": Keyed(spark.createDataFrame([(7, 1, "2025-01-02"), (8, 5, None)], "id bigint, p bigint, at string").withColumn("at", F.to_timestamp("at")), F.col("id").cast("string"), "at")}
    assert rows(orphan_report(top, [ForeignKey("c", "p", "p")])) == [("c", "c.p", None, "direct", 1)]
    empty = {"p": Keyed(spark.createDataFrame([], "id bigint"), F.col("id").cast("string")), "c": top["c"]}
    assert missing_references(empty, ForeignKey("c", "p", "p")).count() == 2
    assert missing_references({"p": top["p"], "c": Keyed(top["c"].frame.limit(0), F.col("id").cast("string"))}, ForeignKey("c", "p", "p")).count() == 0


def test_orphan_cascade_runs_down_three_levels_and_round_a_circle(spark):
    by_id = F.col("id").cast("string")
    table = lambda rows, *refs: Keyed(spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{r} bigint" for r in refs)), by_id)
    tables = {"p": table([(1, None)], "x"), "c": table([(10, 1), (11, 7), (12, None)], "p"), "g": table([(20, 10), (21, 11)], "c"), "h": table([(30, 20), (31, 21), (32, 99)], "g")}
    chain = [ForeignKey("c", "p", "p"), ForeignKey("g", "c", "c"), ForeignKey("h", "g", "g")]
    expected = [("c", "11", "direct", "7"), ("g", "21", "inherited", None), ("h", "31", "inherited", None), ("h", "32", "direct", "99")]
    found = lambda t, k: sorted((r["source_table"], r["row_key"], r["kind"], r["missing_key"]) for r in orphan_cascade(t, k).collect())
    assert found(tables, chain) == expected
    # c refers to h as well, so the references run in a circle: 10 hangs on the orphan 31, and 20 and 30 on 10
    circle = tables | {"c": table([(10, 1, 31), (11, 7, 30), (12, None, None)], "p", "h")}
    more = {("c", "10", "inherited", None), ("g", "20", "inherited", None), ("h", "30", "inherited", None), ("c", "11", "inherited", None)}
    assert set(found(circle, [*chain, ForeignKey("c", "h", "h")])) == set(expected) | more


def test_orphan_hot_key_and_chain(spark):
    hot = spark.createDataFrame([(i, 99 if i % 3 == 0 else 1) for i in range(900)], "id bigint, p bigint")
    tables = {"p": Keyed(spark.createDataFrame([(1,)], "id bigint"), F.col("id").cast("string")), "c": Keyed(hot, F.col("id").cast("string")), "g": Keyed(hot.select(F.col("id").alias("id"), F.col("id").alias("c")), F.col("id").cast("string"))}
    found = orphan_cascade(tables, [ForeignKey("c", "p", "p"), ForeignKey("g", "c", "c")])
    assert found.groupBy("source_table", "kind").count().orderBy("source_table").collect() == [("c", "direct", 300), ("g", "inherited", 300)]


def test_clustering_metrics(spark):
    s = "task string, cluster int, items array<string>"
    gold = spark.createDataFrame([("t", 0, ["c1", "wA"]), ("t", 1, ["c2"]), ("only_gold", 0, ["x"])], s)
    predicted = spark.createDataFrame([("t", 0, ["c1"]), ("t", 1, ["c2"]), ("only_pred", 0, ["x"])], s)
    assert rows(al.clustering_metrics(gold, predicted)) == [("only_gold", 0.0, 0.0, 0.0), ("only_pred", 0.0, 0.0, 0.0), ("t", 0.75, 0.75, 0.75)]


def test_answers_are_cached_and_retried(spark):
    requests = spark.createDataFrame([("p1",), ("p1",), ("bad",)], "prompt string")
    empty = spark.createDataFrame([], "key string, content string")

    def model(system, prompt):
        if prompt == "bad":
            raise RuntimeError
        return f"{system}:{prompt}"

    first = al.answers(requests, empty, model, "s").collect()
    assert sorted((r["content"] or "") for r in first) == ["", "s:p1"]
    cache = spark.createDataFrame([r for r in first], "key string, content string")
    again = al.answers(requests, cache, lambda s, p: "new", "s").collect()
    assert sorted(r["content"] for r in again) == ["new", "s:p1"]


def test_alignment_flow(spark):
    words = spark.createDataFrame([(1, "seed"), (2, "give up")], "id bigint, display_form string")
    entries = spark.createDataFrame([(10, 1, "noun"), (11, 2, "phrasal verb")], "id bigint, word_id bigint, pos string")
    senses = spark.createDataFrame([(100, 10, "part of a plant", None), (101, 10, "a player", ""), (102, 11, "stop", None)], "id bigint, entry_id bigint, definition string, phrase_title string")
    lexicon = spark.createDataFrame([("seed", "n", "y1"), ("seeds", "n", "y2"), ("give_up", "v", "y3")], "lemma string, pos string, synset_id string")
    groups = al.sense_groups(words, entries, senses)
    found = al.candidate_synsets(al.tasks(groups), lexicon)
    assert rows(found) == [("give up", "phrasal verb", "y3"), ("seed", "noun", "y1")]
    assert [r[0] for r in rows(al.candidate_synsets(al.tasks(groups), lexicon, compat=True))] == ["seed"]
    rendered = al.rendered_tasks(groups, found, spark.createDataFrame([("y1", "a grain"), ("y3", "quit")], "synset_id string, definition string"))
    assert "[2] a player" in rendered.where("word = 'seed'").first()["prompt"]
    content = spark.createDataFrame([('{"task_id":"seed_noun","unified_senses":[{"definition":"d","cambridge_senses":[1,7],"wordnet_synsets":[1]}]}',), ("junk",)], "content string")
    done = al.resolved(al.parsed_answers(content), rendered)
    assert rows(done) == [("seed", "noun", "d", [100], ["y1"])]
    full = al.backfill(groups, done)
    assert full.count() == 2
    status = spark.createDataFrame([("seed", "noun", "aligned")], "word string, pos string, status string")
    assert rows(al.pending(al.tasks(groups), status)) == [("give up", "phrasal verb")]
    exported = al.export(full.withColumn("id", F.lit(1)))
    assert exported.count() == 2


def test_synonym_rules(spark):
    judged = spark.createDataFrame([(1, 10, True, 2), (1, 11, False, 9), (2, 20, False, 0), (2, 21, False, 0), (3, 30, False, 0)], "relation_id int, sense_id int, mutual boolean, overlap bigint")
    best = sy.best_candidates(judged)
    assert {(r["relation_id"], r["sense_id"]): r["needs_vectors"] for r in best.collect()} == {(1, 10): False, (2, 20): True, (2, 21): True, (3, 30): False}
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (21, [1.0, 0.0])], "sense_id int, vector array<double>")
    tied = best.where("needs_vectors").select("relation_id", F.lit(0).alias("source_sense_id"), "sense_id")
    assert rows(sy.by_vectors(tied, vectors)) == [(2, 21, 1.0)]


def test_synonym_resolution(spark):
    senses = spark.createDataFrame([(1, "big", "big", "adjective", "big"), (2, "large", "large", "adjective", "large"), (3, "butter bean soup", "butter-bean-soup", "noun", "butter bean soup")], "sense_id bigint, display_form string, slug string, pos string, word string")
    relations = spark.createDataFrame([(7, 1, "Large", "adjective"), (8, 1, "nothing", "adjective"), (9, 1, "butter bean", "phrase"), (10, 1, "large", None)], "relation_id bigint, source_sense_id bigint, synonym string, pos string")
    own = spark.createDataFrame([(1, "large"), (2, "big")], "sense_id bigint, synonym string")
    got = sy.resolve(relations, senses, own)
    assert rows(got) == [(7, 2, "single"), (9, 3, "single")]
    assert dict(rows(sy.stage_counts(relations, got))) == {"single": 2, "unresolved": 2}
    table = spark.createDataFrame([(7, 1, "Large", None, 0, None), (8, 1, "nothing", None, 0, 5)], "id bigint, sense_id bigint, synonym string, slug string, is_antonym int, target_sense_id bigint")
    assert [r["target_sense_id"] for r in sy.write_back(table, got).orderBy("id").collect()] == [2, 5]


def test_variants(spark):
    words = spark.createDataFrame([(1, "color", "color"), (2, "colour", "colour"), (3, "grey", "grey")], "id bigint, word string, display_form string")
    redirects = spark.createDataFrame([(2, "noun", "UK spelling of color"), (3, "adjective", "UK spelling of color")], "word_id bigint, pos string, definition string")
    parsed = va.parsed_redirects(redirects, words)
    mapping = va.british_to_american(parsed)
    assert rows(mapping) == [("colour", "n", "color"), ("grey", "a", "color")]
    entries = spark.createDataFrame([(10, 1), (11, 2), (12, 1)], "id bigint, word_id bigint")
    senses = spark.createDataFrame([(100, 10), (101, 11)], "id bigint, entry_id bigint")
    assert rows(va.moved_entries(entries, senses, words, mapping)) == [(10, 1), (11, 1)]
    only = spark.createDataFrame([("grey", "a", "gray")], "uk string, pos string, us string")
    assert rows(va.renamed_words(words, only))[2] == (3, "gray", "gray")


def test_consolidation(spark):
    words = spark.createDataFrame([(1, "seed", "seed", "word"), (2, "seed!", None, "word")], "id bigint, word string, display_form string, entry_type string")
    unified = spark.createDataFrame([(1, "seed", "n", "u1", 100), (2, "SEED ", "noun", "u2", 100), (3, "new thing", "v", "u3", None)], "id bigint, word string, pos string, definition string, cambridge_sense_id bigint")
    entries = spark.createDataFrame([(10, 1, "noun", None, "u", "", "a"), (11, 1, "noun", "p", "v", "b", "c")], "id bigint, word_id bigint, pos string, pronunciation_uk string, pronunciation_us string, audio_uk_url string, audio_us_url string")
    senses = spark.createDataFrame([(100, "B2", "g", None, None, "[]", "orig"), (101, "X", None, None, None, None, "other")], "id bigint, cefr_level string, guideword string, grammar string, domain string, labels string, definition string")
    links = spark.createDataFrame([(1, "oewn-1-n"), (1, "oewn-1-n"), (2, "oewn-1-n"), (3, "oewn-2-v")], "unified_sense_id bigint, wordnet_id string")
    built = co.build_words(words, unified)
    assert [(r["slug"], r["word"], r["entry_type"]) for r in built.orderBy("id").collect()] == [("seed", "seed", "word"), ("seed-1", "seed!", "word"), ("new-thing", "new thing", "phrasal_verb")]
    final, entry_map = co.build_entries(entries, built, unified)
    assert final.where("pos = 'noun'").first()["pronunciation_uk"] == "p" and final.count() == 2 and entry_map.count() == 2
    out = co.build_senses(unified, senses, final, built)
    assert [(r["source"], r["cefr_level"]) for r in out.orderBy("id").collect()] == [("dictionary", "B2"), ("dictionary", "B2"), ("wordnet", None)]
    synsets = spark.createDataFrame([("oewn-1-n", "grain"), ("oewn-2-v", "")], "synset_id string, definition string")
    assert co.build_definitions(out, senses, links, synsets).count() == 4
    lemmas = spark.createDataFrame([("oewn-1-n", "seed"), ("oewn-1-n", "grain")], "synset_id string, lemma string")
    assert sorted(r["target_word"] for r in co.build_lexicon_synonyms(out, links, lemmas).collect()) == ["grain", "grain"]
    synonyms = spark.createDataFrame([(1, 100, "kernel", 0, 100), (2, 100, "pip", 0, None)], "id bigint, sense_id bigint, synonym string, is_antonym int, target_sense_id bigint")
    assert co.build_synonyms(synonyms, out).count() == 4
    nothing = spark.createDataFrame([], "src_lemma string, src_synset string, rel string, tgt_lemma string, tgt_synset string")
    anti = spark.createDataFrame([("seed", "oewn-1-n", "antonym", "new thing", "oewn-2-v"), ("new thing", "oewn-2-v", "antonym", "seed", "oewn-1-n")], nothing.schema)
    assert co.build_lexicon_antonyms(out, links, anti).count() == 2
    assert co.build_relations(out, links, spark.createDataFrame([("oewn-1-n", "hypernym", "oewn-2-v"), ("oewn-1-n", "unknown", "oewn-2-v")], "src string, rel string, tgt string"), nothing, spark.createDataFrame([("/c/a", "/r/UsedFor", "/c/b", 1.0)], "start_concept string, relation string, end_concept string, weight double"), spark.createDataFrame([("/c/a", "oewn-1-n"), ("/c/b", "oewn-2-v")], "conceptnet_uri string, wordnet_id string")).groupBy("source").count().orderBy("source").collect() == [("conceptnet", 2), ("wordnet", 2)]
    examples = spark.createDataFrame([(100, "A seed.", None)], "sense_id bigint, example string, collocation string")
    assert co.build_examples(examples, out, links, spark.createDataFrame([("oewn-2-v", "do it")], "synset_id string, example string")).count() == 3
    topics = spark.createDataFrame([(1, 5), (1, 5)], "word_id bigint, topic_id bigint")
    assert co.build_sense_topics(topics, built, final, out).count() == 2
    assert co.build_collocations(spark.createDataFrame([(1, "sow seeds", "x"), (9, "y", "z")], "word_id bigint, collocation string, example string"), built).count() == 1
    infl = spark.createDataFrame([(10, "plural", "seeds"), (10, "plural", "seeds"), (11, "singular", "x")], "entry_id bigint, form_type string, inflected_form string")
    assert [(r["form_type"], r["inflected_form"]) for r in co.build_inflections(infl, entry_map, final).collect()] == [("plural", "seeds")]


def test_sentiment(spark):
    ids = spark.createDataFrame([("oewn-1-n",), ("oewn-1-n",), ("oewn-2-n",), ("other",)], "wordnet_id string")
    scores = spark.createDataFrame([("oewn-1-n", 0.5, 0.25, 0.25)], "synset_id string, pos_score double, neg_score double, obj_score double")
    assert rows(al.with_sentiment(ids, scores)) == [("oewn-1-n", 0.5, 0.25, 0.25, True), ("oewn-2-n", 0.0, 0.0, 1.0, False)]
