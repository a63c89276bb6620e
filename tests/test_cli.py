import json

from glossarium import cli
from glossarium.plans.fixtures import CRAWL, ENTRY_PAGE


def model(system, prompt):
    return json.dumps({"results": [{"task_id": "seed_noun", "unified_senses": [{"definition": "seed of a plant", "cambridge_senses": [1], "wordnet_synsets": [1]}]}]})


def broken(system, prompt):
    raise ValueError("no answer")


def test_whole_pipeline(spark, tmp_path):
    db, run = str(tmp_path / "db"), lambda *a: cli.main([str(x) for x in a], spark)
    spark.createDataFrame([("u1", CRAWL)], "url string, html string").write.parquet(str(tmp_path / "lists"))
    run("collect", "--pages", tmp_path / "lists", "--output", tmp_path / "words")
    spark.createDataFrame([("seed", ENTRY_PAGE)], "word string, html string").write.parquet(str(tmp_path / "pages"))
    run("crawl", "--db", db, "--words", tmp_path / "words", "--load-only")
    run("crawl", "--db", db, "--pages", tmp_path / "pages")
    words = {r["word"]: r["status"] for r in spark.read.parquet(f"{db}/words").collect()}
    assert words == {"seed": "done", "give-up": "pending", "sow": "seen"}
    assert spark.read.parquet(f"{db}/examples").count() == 2
    run("synonyms", "--db", db, "--dry-run")
    run("synonyms", "--db", db)
    lexicon = str(tmp_path / "lexicon")
    spark.createDataFrame([("oewn-00000001-n", "n", "a grain")], "synset_id string, pos string, definition string").write.parquet(f"{lexicon}/wn_synset")
    spark.createDataFrame([("seed", "oewn-00000001-n")], "lemma string, synset_id string").write.parquet(f"{lexicon}/wn_sense")
    spark.createDataFrame([("oewn-00000001-n", 0, "A seed.")], "synset_id string, ord int, example string").write.parquet(f"{lexicon}/wn_example")
    spark.createDataFrame([("oewn-00000001-n", "hypernym", "oewn-00000001-n")], "src string, rel string, tgt string").write.parquet(f"{lexicon}/wn_synset_rel")
    spark.createDataFrame([], "src_lemma string, src_synset string, rel string, tgt_lemma string, tgt_synset string").write.parquet(f"{lexicon}/wn_sense_rel")
    run("align", "--db", db, "--model", f"{__name__}:broken", "--lexicon", lexicon, "--difficulty-method", "mul")
    assert "aligned" not in {r["status"] for r in spark.read.parquet(f"{db}/word_pos_alignment_status").where("word = 'seed'").collect()}
    for _ in range(2):
        run("align", "--db", db, "--model", f"{__name__}:model", "--lexicon", lexicon, "--difficulty-method", "mul", "--output", tmp_path / "export")
    assert [(r["word"], r["definition"], r["cambridge_sense_id"]) for r in spark.read.parquet(f"{db}/unified_senses").collect()] == [("seed", "seed of a plant", 1)]
    assert spark.read.parquet(f"{db}/response_cache").count() == 1
    (tmp_path / "edges.tsv").write_text("u\t/r/UsedFor\t/c/en/a\t/c/en/b\t{}\n")
    run("import-concepts", "--db", db, "--edges", tmp_path / "edges.tsv")
    spark.createDataFrame([("oewn-00000001-n", 0.5, 0.0, 0.5)], "synset_id string, pos_score double, neg_score double, obj_score double").write.parquet(str(tmp_path / "scores"))
    run("import-sentiment", "--db", db, "--scores", tmp_path / "scores")
    run("build", "--db", db, "--lexicon", lexicon, "--output", tmp_path / "final")
    final = lambda n: spark.read.parquet(str(tmp_path / "final" / n)).count()
    assert (final("senses"), final("alternative_definitions"), final("examples"), final("sense_topics"), final("semantic_relations")) == (1, 2, 3, 1, 0)
    gold = {"seed_noun": [{"definition": "d", "cambridge_sense_ids": [1], "wordnet_synset_ids": ["oewn-00000001-n"]}]}
    (tmp_path / "gold.json").write_text(json.dumps(gold))
    run("evaluate", "--gt", tmp_path / "gold.json", "--predicted", tmp_path / "gold.json", "--history", tmp_path / "history")
    assert spark.read.json(str(tmp_path / "history")).first()["f1"] == 100.0
