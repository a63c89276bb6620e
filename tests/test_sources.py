import gzip

from pyspark.sql import functions as F

from glossarium.sources import files as fi
from glossarium.sources import schemas as sc
from glossarium.streaming import events as ev


def test_ragged_and_registry(spark, tmp_path):
    path = tmp_path / "words.tsv"
    path.write_text("alpha\tAlpha\tword\nbeta\tidiom\n\ngamma\n")
    listed = fi.read_ragged_words(spark, str(path))
    assert sorted(map(tuple, listed.collect())) == [("alpha", "Alpha", "word"), ("beta", "beta", "idiom"), ("gamma", "gamma", "word")]
    registry = spark.createDataFrame([("alpha", "alpha", "word", "done"), ("x", "X", "word", "done")], "word string, display_form string, entry_type string, status string")
    loaded = {r["word"]: tuple(r) for r in fi.load_words(registry, listed).collect()}
    assert loaded["alpha"] == ("alpha", "Alpha", "word", "done") and loaded["gamma"][3] == "pending" and loaded["x"][1] == "X"
    fi.write_words(listed, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), sep="\t").count() == 3


def test_concept_edges(spark, tmp_path):
    lines = ["u\t/r/UsedFor\t/c/en/a\t/c/en/b\t{\"weight\": 2.0}", "u\t/r/UsedFor\t/c/en/a\t/c/en/a\t{}", "u\t/r/UsedFor\t/c/fr/a\t/c/en/b\t{}", "short\tline", "u\t/r/ExternalURL\t/c/en/a/n/wn\thttp://wordnet-rdf.x/wn31/100001740-n\t{}", "u\t/r/Causes\t/c/en/a\t/c/en/b\tbroken"]
    path = tmp_path / "edges.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines))
    edges = fi.read_concept_edges(spark, str(path), 2)
    assert sorted(tuple(r) for r in fi.concept_relations(edges).collect()) == [("/c/en/a", "/r/Causes", "/c/en/b", 1.0), ("/c/en/a", "/r/UsedFor", "/c/en/b", 2.0)]
    assert [tuple(r) for r in fi.concept_senses(edges).collect()] == [("/c/en/a/n/wn", "oewn-00001740-n")]


def test_json_inputs(spark, tmp_path):
    path = tmp_path / "w.json"
    path.write_text('["a", "b b",\n "c"]')
    assert [r["word"] for r in fi.read_word_array(spark, str(path), 2).orderBy("place").collect()] == ["a", "b b"]
    text = spark.createDataFrame([('{"give_up_verb": [{"definition": "d", "cambridge_sense_ids": [1], "wordnet_synset_ids": ["y"]}]}',)], "value string")
    assert tuple(fi.clusters_of(text).first()) == ("give_up_verb", "give_up", "verb", 0, "d", [1], ["y"])
    assert spark.createDataFrame([("oewn-abandon__2.40.00..",)], "s string").select(fi.sense_key("s")).first()[0] == "abandon%2:40:00::"


def test_overwrite_keys_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2")], "k int, v string")
    second = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    fi.overwrite_keys(spark, path, first, ["k"])
    for _ in range(2):
        fi.overwrite_keys(spark, path, second, ["k"])
        assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_schema_tools(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 5)], "id int, word string, extra int")
    wide = fi.evolve(df, sc.schema("sense_synonyms"))
    assert wide.columns == ["id", "sense_id", "synonym", "slug", "is_antonym", "target_sense_id", "word", "extra"]
    bad = spark.createDataFrame([(1, "A1"), (1, "Z9"), (None, None)], "id int, cefr_level string")
    found = {r["rule"]: r["n"] for r in sc.violations(bad, "senses", ("id",), ("id",)).collect()}
    assert found == {"cefr_level allowed": 1, "id required": 1, "id unique": 1}
    fi.append_history(spark.createDataFrame([("m", 1.0)], "model string, f1 double"), str(tmp_path / "h"))
    fi.append_history(spark.createDataFrame([("m", 2.0)], "model string, f1 double"), str(tmp_path / "h"))
    assert spark.read.json(str(tmp_path / "h")).count() == 2
    df.createOrReplaceTempView("some_view")
    assert fi.catalog_columns(spark).where("table_name = 'some_view'").count() == 3


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(500).select(F.col("id"), (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts"))
    rows.coalesce(3).write.parquet(str(tmp_path / "e"))
    got = {r["bucket"]: r["events"] for r in ev.run_to_table(spark, ev.velocity(ev.event_stream(spark, str(tmp_path / "e")))).collect()}
    assert sum(got.values()) == 500 and set(got.values()) == {10} and "2024-01-01 00:10" in got


def test_stream_writer(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, v string").parquet(str(tmp_path / "in"))
    ev.write_stream(stream, str(tmp_path / "table"), ["k"], once=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2
