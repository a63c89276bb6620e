import pickle
import random
import time
import tracemalloc
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossarium.llm import canonical, fingerprint, leaks, lookalikes, near, packing, retrieval, subjects


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- problem 1 ---------------------------------------------------------------------------------------------------

TEXTS = [
    ("plain ascii text", "plain ascii text"), ("café", "café"), ("ﬁre ｗｉｄｅ", "fire wide"), ("zero​width﻿", "zerowidth"), ("no break　space", "no break space"), ("grаin intо", "grain into"),
    ("dirpipanυn", "dirpipanun"), ("слово ψυχή", "слово ψυχή"), ("en – dash", "en – dash"), ("𝐛𝐨𝐥𝐝", "bold"), ("q̣̇", "q̣̇"), ("q̣̇", "q̣̇"), ("é̩", "é̩"), ("", ""),
    ("한국", "한국"), (unicodedata.normalize("NFD", "한국"), "한국"), ("​", ""),
]


def test_consistent_texts(spark):
    df = spark.createDataFrame([(i, "text", a) for i, (a, _) in enumerate(TEXTS)] + [(99, "text", None)], "id int, kind string, text string")
    got = {r["id"]: r["text"] for r in lookalikes.consistent_texts(df, ["id"]).collect()}
    assert got == {i: b for i, (_, b) in enumerate(TEXTS)} | {99: None}
    changed = {r["id"] for r in lookalikes.inconsistent_rows(df, ["id"]).collect()}
    assert changed == {i for i, (a, b) in enumerate(TEXTS) if a != b}


def test_phonetic_texts(spark):
    pairs = [("/'siːd/", "/ˈsiːd/"), ("/ɡəʊ:/", "/ɡəʊː/"), ("/gǝʊ/", "/ɡəʊ/"), ("/n̩/", "/n̩/"), ("/θɪŋ/", "/θɪŋ/"), ("/tʰ/", "/tʰ/"), ("／ˈkӕt／", "/ˈkæt/"), ("/Λp/", "/ʌp/")]
    df = spark.createDataFrame([(i, "ipa", a, "x") for i, (a, _) in enumerate(pairs)], "id int, kind string, text string, token string")
    assert {r["id"]: r["text"] for r in lookalikes.consistent_texts(df, ["id"]).collect()} == {i: b for i, (_, b) in enumerate(pairs)}


def test_consistent_texts_of_many_kinds(spark):
    rnd = random.Random(5)
    alphabet = "abé é́̈ﬁＡ①…－ñÅÅ 	 xyz"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(150)] + ["é" * 20_000, "x" * 50_000 + "ﬁ"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("kind", F.lit("text"))
    for i, text in rows(lookalikes.consistent_texts(df, ["id"]).select("id", "text")):
        spaced = "".join(" " if c.isspace() else c for c in texts[i])
        assert text == unicodedata.normalize("NFKC", spaced), i
    assert lookalikes.inconsistent_rows(df.limit(0), ["id"]).count() == 0


# -- problem 2 ---------------------------------------------------------------------------------------------------

TERMS = [(1, "pos", "noun"), (2, "pos", "verb"), (3, "pos", "adverb"), (4, "pos", "phrasal verb"), (5, "form", "past participle"), (6, "form", "past tense and past participle"), (7, "syn", "hidden lantern"), (8, "syn", "hidden pattern"), (9, "syn", "meticulous"), (10, "syn", "carry through")]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcd", max_size=9), st.text(alphabet="abcd", max_size=9))
def test_edit_metrics(a, b):
    table = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, table[0] = table[0], i
        for j, d in enumerate(b, 1):
            last, table[j] = table[j], min(table[j] + 1, table[j - 1] + 1, last + (c != d))
    assert canonical.levenshtein(a, b, 99) == table[-1]
    assert canonical.edits(a, b) <= table[-1] <= 2 * canonical.edits(a, b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=6), max_size=25), st.text(alphabet="abc", max_size=6), st.integers(0, 3))
def test_tree_finds_all_within(keys, asked, radius):
    want = sorted({(d, k) for k in keys if (d := canonical.levenshtein(asked, k, 99)) <= radius})
    assert sorted(canonical.BKTree(keys).within(asked, radius)) == want


@pytest.mark.parametrize(
    ("kind", "value", "term"),
    [
        ("pos", "NOUN ", 1), ("pos", "noum", 1), ("pos", "nuon", 1), ("pos", "n.", 1), ("pos", "noun [C]", 1), ("pos", "adv.", 3), ("pos", "phr v", 4), ("pos", "phrasal-verb", 4), ("pos", "n/a", 0), ("pos", "letter of alphabet", 0), ("pos", "", 0), ("pos", "???", 0),
        ("form", "participle, past", 5), ("form", "p.p.", 5), ("form", "past participle & past tense", 6), ("form", "past tense + pp", 6), ("syn", "to_hidden lantern (formal)", 7), ("syn", "hid.den  pattren", 8), ("syn", "silent lantern", 0),
        ("syn", "very meticulous", 9), ("syn", "metticulous", 9), ("syn", "CARRYTHROUGH", 10), ("syn", "hidden accordion", 0), ("other", "noun", 0), ("syn", "x" * 5000, 0), ("syn", "hidden " * 500, 0),
    ],
)
def test_typed_values(kind, value, term):
    assert canonical.Matcher(TERMS, ("pos", "form")).find(kind, value)[1] == term


def test_canonical_terms_sharded(spark):
    values = spark.createDataFrame([("pos", v, 1) for v in ("noum", "noum", "verbs", "zzz", None, "")] + [(None, "noun", 1)], "kind string, value string, term_id int")
    terms = spark.createDataFrame(TERMS, "term_id int, kind string, canonical string")
    want = [("pos", "", 0), ("pos", "noum", 1), ("pos", "verbs", 2), ("pos", "zzz", 0)]
    assert rows(canonical.canonical_terms(values, terms, ("pos",))) == want
    assert rows(canonical.canonical_terms(values, terms, ("pos",), shard_entries=2)) == want
    assert all(t == 0 for _, _, t in rows(canonical.canonical_terms(values, terms.limit(0), ("pos",))))
    assert rows(canonical.canonical_terms(values.limit(0), terms, ("pos",))) == []


def test_shards_know_the_words_of_the_whole_list(spark):
    terms = spark.createDataFrame([(1, "t", "gran"), (2, "t", "grain seed"), (3, "t", "grainy"), (4, "t", "one two three four")], "term_id bigint, kind string, canonical string")
    typed = ["grain", "gran", "garin seed", "graniy", "four three two one", "four three two onne", "one two three four (a long label of very many words that stands in brackets)"]
    values = spark.createDataFrame([("t", v) for v in typed], "kind string, value string")
    found = [{r["value"]: r["term_id"] for r in canonical.canonical_terms(values, terms, shard_entries=n).collect()} for n in (1, 2, 20_000)]
    assert found[0] == found[1] == found[2] == dict(zip(typed, [0, 1, 2, 3, 4, 4, 4]))


# -- problem 3 ---------------------------------------------------------------------------------------------------


def test_hidden_copies(spark):
    data = [(5, "s", "Red, blue"), (3, "s", "BLUE;red!"), (9, "t", "blue|red"), (4, "s", "red red, blue"), (6, "s", "redred/blue"), (7, "s", None), (8, "s", " -- "), (None, "s", "red,blue"), (10, None, "red,blue"), (5, "s", "Red, blue"), (11, "s", "réd, blue"), (12, "s", ""), (13, "s", "...")]
    df = spark.createDataFrame(data, "id bigint, scope string, value string").withColumn("keep_id", F.lit("clash"))
    found = fingerprint.hidden_copies(df, "id", ["scope"], ["value"])
    assert rows(found) == [("s", 3, 5), ("s", 4, 6)]
    assert rows(fingerprint.copy_counts(found, ["scope"])) == [("s", 3, 2), ("s", 4, 2)]
    assert fingerprint.hidden_copies(df.limit(0), "id", ["scope"], ["value"]).count() == 0


def test_hidden_copies_hot_group_and_fields(spark):
    hot = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("a, b")).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("x"), F.lit("Y").alias("y"))
    found = fingerprint.hidden_copies(hot, "id", [], ["x", "y"], salts=4)
    assert found.count() == 999 and found.select("keep_id").distinct().collect()[0][0] == 0
    swapped = spark.createDataFrame([(1, "a", "b"), (2, "b", "a")], "id int, x string, y string")
    assert fingerprint.hidden_copies(swapped, "id", [], ["x", "y"]).count() == 0
    long = spark.createDataFrame([(1, "a;" * 3000), (2, "A," * 3000), (3, "a;" * 2999)], "id int, x string")
    assert rows(fingerprint.hidden_copies(long, "id", [], ["x"])) == [(1, 2)]


# -- problem 4 ---------------------------------------------------------------------------------------------------


def _records(rnd, n, vocabulary, k):
    return [(i, [int(t) for t in rnd.sample(vocabulary, min(k, len(vocabulary)))]) for i in range(n)]


@pytest.mark.parametrize("bucket_rows, share", [(300_000, 0.6), (20, 0.6), (7, 0.3)])
def test_retrieval_is_exact(spark, bucket_rows, share):
    rnd = random.Random(11)
    vocabulary, names = list(range(1, 40)), [retrieval.NAMES + i for i in range(25)]
    index = [(i, t + [rnd.choice(names)] * (i % 3 > 0)) for i, t in _records(rnd, 300, vocabulary, 9)] + [(990, vocabulary[:36]), (991, [])]
    queries = [(str(i), t + rnd.sample(names, i % 3)) for i, t in _records(rnd, 80, vocabulary, 7)] + [(f"s{i}", t) for i, t in _records(rnd, 20, vocabulary, 2)]
    queries += [("none", []), ("odd", [99]), ("long", vocabulary[3:38]), ("name", names[:2])]
    df = {t: sum(t in r for _, r in index) for t in vocabulary + names[:20]}
    words = retrieval.Vocabulary(len(index), df, {2: 3}, {4: (5, 6)})
    got = retrieval.retrieve(spark.createDataFrame(index, "id bigint, terms array<int>"), spark.createDataFrame(queries, "id string, terms array<int>"), words, share, bucket_rows)
    pairs = [(r["index_id"], r["query_id"]) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == retrieval.brute_force(dict(index), dict(queries), words, share)
    one = retrieval.Vocabulary(3, {7: 1})
    tiny = retrieval.retrieve(spark.createDataFrame([(1, [7]), (2, [8])], "id bigint, terms array<int>"), spark.createDataFrame([("q", [7])], "id string, terms array<int>"), one)
    assert [(r["index_id"], r["query_id"], r["score"]) for r in tiny.collect()] == [(1, "q", 1.0)]


def test_matched_learns_words_and_skips_ties(spark):
    rnd = random.Random(2)
    nouns, synonyms = [f"word{i}" for i in range(150)], [f"other{i}" for i in range(150)]
    index, queries, tied = [], [], []
    for i in range(1000):
        picks = rnd.sample(range(150), 6)
        index.append((i, [retrieval.term_of(nouns[p]) for p in picks] + [retrieval.term_of(f"rare{i}")], f"name{i}", "n"))
        queries.append((f"q{i}", [retrieval.term_of((synonyms if rnd.random() < 0.4 else nouns)[p]) for p in picks[:5]], [f"name{i}"] if i % 4 else ["x"], "n"))
        if i < 900:
            tied.append((i, f"q{i}"))
    queries.append(("q-none", [retrieval.term_of(f"nothing{j}") for j in range(5)], None, None))
    schema_i, schema_q = "id bigint, terms array<int>, name string, kind string", "id string, terms array<int>, names array<string>, kind string"
    got = retrieval.matched(spark.createDataFrame(index + [(None, [1], None, None)], schema_i), spark.createDataFrame(queries, schema_q), spark.createDataFrame(tied + [(1, None)], "index_id bigint, query_id string"))
    pairs = {(r["index_id"], r["query_id"]) for r in got.collect()}
    assert {(i, f"q{i}") for i in range(900, 1000)} <= pairs and len(pairs) <= 105 and not pairs & set(tied)
    empty = retrieval.matched(spark.createDataFrame([], schema_i), spark.createDataFrame([], schema_q), spark.createDataFrame([], "index_id bigint, query_id string"))
    assert empty.count() == 0


def test_matched_finds_a_group_of_copies(spark):
    rnd = random.Random(9)
    words = [f"word{i}" for i in range(120)]
    texts = [[retrieval.term_of(w) for w in ["the", *rnd.sample(words, 8)]] for _ in range(400)]
    index = [(i, t, f"name{i}", "n") for i, t in enumerate(texts)] + [(1000 + i, texts[0], "name0", "n") for i in range(200)]
    queries = [(f"q{i}", [*t[:8], retrieval.term_of("of")], [f"name{i}"], "n") for i, t in enumerate(texts)]
    tied = [(i, f"q{i}") for i in range(0, 400, 2)]
    got = retrieval.matched(spark.createDataFrame(index, "id bigint, terms array<int>, name string, kind string"), spark.createDataFrame(queries, "id string, terms array<int>, names array<string>, kind string"), spark.createDataFrame(tied, "index_id bigint, query_id string"))
    found = [(r["index_id"], r["query_id"]) for r in got.collect()]
    assert sorted(found) == sorted([(1000 + i, "q0") for i in range(200)] + [(i, f"q{i}") for i in range(1, 400, 2)])


def test_vocabulary_of_many_terms_is_small():
    n = 1_000_000
    terms = np.arange(0, 3 * n, 3)
    tracemalloc.start()
    words = retrieval.Vocabulary(n, (terms, 2 + terms % 1000), {3: 6}, {9: (12, 15)})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * n and len(pickle.dumps(words)) < 14 * n
    assert [words.df_of(t) for t in (3, 4, 2997, 9 + retrieval.TERMS)] == [5, 1, 999, 2 + 9 + 2 + 12 + 2 + 15]


def test_words_are_learned_from_all_tied_pairs(spark):
    n, groups = 70_000, 300
    ids = spark.range(n).withColumn("q", F.concat(F.lit("q"), "id"))
    term = lambda a, b: F.array(F.when(F.col("id") < 3 * groups, 1000 * a + F.floor(F.col("id") / 3)).otherwise(b + F.col("id") % 50).cast("int"))
    index = ids.select("id", term(5, 100).alias("terms"), F.lit(None).cast("int").alias("kind"))
    queries = ids.select(F.col("q").alias("id"), term(9, 200).alias("terms"), F.lit(None).cast("int").alias("kind"))
    words = retrieval.learn_vocabulary(index.select("id", "terms"), index, queries, ids.select(F.col("id").alias("index_id"), F.col("q").alias("query_id")))
    assert {9000 + i: 5000 + i for i in range(groups)} | {200 + i: 100 + i for i in range(50)} == words.same | {y: g[0] for y, g in words.either.items()}


def test_word_pairs_broadcast_only_the_terms_there_are(spark, monkeypatch):
    sizes, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sizes.append(len(pickle.dumps(value))) or send(value))
    index = spark.createDataFrame([(i, [1, 100 + i // 3], None) for i in range(30)], "id bigint, terms array<int>, kind int")
    queries = spark.createDataFrame([(str(i), [1, 200 + i // 3], None) for i in range(30)], "id string, terms array<int>, kind int")
    words = retrieval.learn_vocabulary(index.select("id", "terms"), index, queries, spark.createDataFrame([(i, str(i)) for i in range(30)], "index_id bigint, query_id string"))
    assert {200 + g: 100 + g for g in range(10)} == words.same | {y: g[0] for y, g in words.either.items()}
    assert sizes and max(sizes) < 10_000


def test_calibration_uses_all_examples(spark):
    n = 70_000
    examples = spark.range(n).select(
        F.col("id").alias("index_id"), F.col("id").cast("string").alias("query_id"), (F.col("id") % 101 / 100).alias("score"), (F.col("id") % 7 / 10).alias("gap_query"), (F.col("id") % 11 / 10).alias("gap_index"),
        (F.col("id") % 2).cast("double").alias("same_name"), (F.col("id") % 3 % 2).cast("double").alias("same_kind"), F.when(F.pmod(F.xxhash64("id"), F.lit(100)) < F.col("id") % 101, 1).otherwise(0).alias("label"),
    )
    rows = examples.select(*retrieval.FEATURES, "label").toPandas().to_numpy(dtype=float)
    x, y = np.c_[rows[:, :-1], np.ones(n)], rows[:, -1]
    beta = retrieval.calibrate(examples)
    prior = np.array([20.0, -10.0, -10.0, 1.0, 0.5, -16.0])
    assert np.abs(x.T @ (y - 1 / (1 + np.exp(-x @ beta))) - 1e-5 * n * (beta - prior)).max() < 1e-3


def test_texts_are_hashed_together():
    odd = [None, "", "-", "a-", "-a", "A-b--c", "a_b 9-9", "end", "start", "\n", "a a A", "don't", "\x00a\x1fb", "é", "a é-b", "ｂｉｒｄ grаin x-y", "x" * 3000, "ﬁ-x", "soft\u00adhy", "İz Σς"]
    expected = [sorted({retrieval.term_of(w) for w in retrieval.words_of(t)}) if t else [] for t in odd]
    assert [retrieval.hashed_texts(pa.array(odd)[i:]).to_pylist() for i in (0, 5, len(odd))] == [expected, expected[5:], []]
    rnd = random.Random(3)
    texts = [" ".join(f"word{rnd.randrange(5000)}" for _ in range(20)) for _ in range(20_000)]
    began = time.process_time()
    one_by_one = [sorted({retrieval.term_of(w) for w in retrieval.words_of(t)}) for t in texts]
    between = time.process_time()
    together = retrieval.hashed_texts(pa.array(texts))
    assert time.process_time() - between < 0.6 * (between - began) and together.to_pylist() == one_by_one


def test_terms_of_one_side_are_packed():
    rows = [([3, 1, 3], [2, 1]), ([], [5]), ([4], []), ([7, 8], [8])]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int32())) for c in zip(*rows)], ["a", "b"])
    packed = list(retrieval._differences([batch]))
    assert [b.to_pylist() for b in packed] == [[{"x": [3], "xs": [1, 0], "y": [2, 5], "ys": [1, 1]}]]
    ((n, x, y),) = retrieval._sides(packed)
    assert (n, [v.tolist() for v in (*x, *y)]) == (2, [[0], [3], [0, 1], [2, 5]])


def test_words_of_entities():
    assert retrieval.words_of("A level-topped ｂｉｒｄ, grаin; grain") == ["a", "level-topped", "bird", "grain"]


# -- problem 5 ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [64, 3])
def test_near_duplicates_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(near, "HOT", hot)
    rnd = random.Random(hot)
    words = [f"w{i}" for i in range(30)]
    data = []
    for i in range(160):
        text = [rnd.choice(words[: rnd.choice([8, 30])]) for _ in range(rnd.randint(1, 14))]
        data.append((3 * i, " ".join(text), rnd.choice(["Big Dictionary", "big dictionary (2nd ed.)", "Other Glossary", " ", None])))
        edited = [w for w in text if rnd.random() > 0.1] + ([rnd.choice(words)] if rnd.random() < 0.3 else [])
        data.append((3 * i + 1, " ".join(edited), rnd.choice(["Big  Dictoinary", "Glossary, Other"])))
    data += [(9000, None, "Big Dictionary"), (9001, "", "Big Dictionary"), (9002, "a " * 3000, "Big Dictionary"), (9003, "A", "Big Dictionary")]
    long = [f"x{i}" for i in range(150)]
    data += [(9100, " ".join(long), "Other Glossary"), (9101, " ".join(long[:-20]), "Other Glossary"), (9102, " ".join(long[:-60]), "Other Glossary")]
    df = spark.createDataFrame(data + data[:5], "id bigint, text string, title string").withColumn("words", F.lit(1))
    got = rows(near.near_duplicates(df, 0.72))
    assert len(got) == len(set(got)) and set(got) == near.brute_force(data, 0.72)
    links = {r["id"]: r["links"] for r in near.link_counts(spark.createDataFrame(got, "id_a bigint, id_b bigint")).collect()}
    assert sum(links.values()) == 2 * len(got)
    assert near.near_duplicates(df.limit(0), 0.72).count() == 0


def test_near_duplicates_shuffle_little(spark):
    def shuffled():
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    rnd = random.Random(4)
    words = [f"word{i}" for i in range(800)]
    data = [(i, " ".join([f"rare{i}", *rnd.sample(words, 19)]), "title") for i in range(6000)]
    data += [(10_000 + i, data[i][1].replace(f"rare{i}", "other"), "title") for i in range(0, 6000, 10)]
    df = spark.createDataFrame(data, "id bigint, text string, title string")
    before = shuffled()
    assert set(rows(near.near_duplicates(df, 0.72))) == {(i, 10_000 + i) for i in range(0, 6000, 10)}
    assert shuffled() - before < 8 * sum(len(t) for _, t, _ in data)


def test_titles():
    same = [("Harwick Dictionary", "Dictionary, Harwick"), ("Harwick Dictionary", "The Harwick Dict."), ("Penmoor American Dictionary", "Pnemoor-American Dictionary online"), ("A B", "a b 3rd edition")]
    other = [("Harwick Dictionary", "Penmoor Dictionary"), ("Harwick Dictionary", "Harwick"), ("", "x")]
    assert all(near.same_title(a, b) and near.same_title(b, a) for a, b in same) and not any(near.same_title(a, b) for a, b in other)


# -- problem 7 ---------------------------------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40), st.sampled_from([64, 100]))
def test_plan_holds_every_item(histogram, capacity):
    held = {}
    for p in packing.plan(histogram, capacity):
        used = sum(n * k for n, k in p.holds.items())
        assert p.copies > 0 and 0 < used <= capacity and p.gap == capacity - used
        for n, k in p.holds.items():
            held[n] = held.get(n, 0) + k * p.copies
    assert held == histogram


def test_packed(spark):
    rnd = random.Random(4)
    sizes = [(i, int(min(5000, rnd.expovariate(1 / 300)))) for i in range(2000)] + [(5000, 20_000), (5001, 512), (5002, 0), (5003, 1)]
    out = packing.packed(spark.createDataFrame(sizes, "doc_id bigint, n_tokens bigint").withColumn("piece", F.lit(9)), 512)
    each = out.groupBy("container_id").agg(F.sum("n_tokens").alias("t")).collect()
    assert max(r["t"] for r in each) <= 512 and sum(r["t"] for r in each) == sum(n for _, n in sizes)
    cut = out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"))
    assert all(r["n"] == max(1, -(-r["t"] // 512)) for r in cut.collect()) and {r["doc_id"]: r["t"] for r in cut.collect()} == dict(sizes)
    used = packing.usage(out, 512).first()
    assert used["unused_share"] < 0.02
    assert packing.packed(spark.createDataFrame([], "doc_id bigint, n_tokens bigint"), 512).count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "word " * 20_000)], "doc_id bigint, text string")
    got = dict(rows(packing.token_counts(df)))
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] >= 20_000


# -- problem 8 ---------------------------------------------------------------------------------------------------


def test_leaks_against_brute_force(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(80)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(12, 40)))) for i in range(40)] + [(900, "too short"), (901, None), (902, "")]
    documents = []
    for d in range(120):
        parts = [rnd.choice(words) for _ in range(rnd.randint(0, 400))]
        if d % 2:
            item = rnd.choice(items[:40])[1].split()
            keep = item[rnd.randint(0, len(item) // 2) :] if d % 4 == 1 else item[: len(item) // 3] + ["extra"] + item[len(item) // 3 :]
            parts[len(parts) // 2 : len(parts) // 2] = keep
        joined = rnd.choice([" ", "\n> ", " **", "  ", "</b> <b>"]).join(parts)
        documents.append((d, joined.upper() if d % 5 == 0 else joined))
    documents += [(500, None), (501, ""), (502, items[0][1]), (503, "\n".join(f"{i}. {w}" for i, w in enumerate(items[1][1].split())))]
    got = rows(leaks.leaked_items(spark.createDataFrame(documents + documents[-2:], "doc_id bigint, text string").withColumn("item_id", F.lit("x")), spark.createDataFrame(items, "item_id bigint, text string")))
    want = leaks.brute_force([d for d in documents if d[1]], [i for i in items if i[1]])
    assert set(got) == want and len(got) == len(want) and (502, 0) in want and (503, 1) in want
    assert leaks.leaked_items(spark.createDataFrame(documents, "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")).count() == 0


def test_floor_is_reached_by_no_weaker_quotation():
    text = "a b c d e f g h i j k l m n"
    index = leaks.LeakIndex([(1, text), (2, "a b c d x y z q r s t u v w")])
    half = [text.split()[k : k + 7] for k in range(8)]
    assert all((0 if index.ids[0] == 1 else 1) in {i for _, i in index.candidates([h])} for h in half)


# -- problem 9 ---------------------------------------------------------------------------------------------------


def test_subjects_recover_planted_mixtures(spark):
    rnd = random.Random(9)
    names = ["law", "food", "music"]
    own = {s: [f"{s[:2]}{'abcdefghij'[i]}word" for i in range(8)] for s in names}
    common = [f"common{'abcdefghijklmnop'[i]}" for i in range(16)]
    sentence = lambda s: " ".join(rnd.sample(common, 5) + rnd.sample(own[s], 2)) if s else " ".join(rnd.sample(common, 6))
    docs, truth = [], {}
    for i in range(300):
        chosen = rnd.sample(names, rnd.choice([1, 1, 2]))
        parts = [sentence(s) for s in chosen for _ in range(4)] + [sentence(None)]
        rnd.shuffle(parts)
        docs.append((i, ". ".join(parts), rnd.choice(["en", "EN", None])))
        truth[i] = set(chosen)
    docs += [(900, None, "en"), (901, "", "en"), (902, "zzz qqq xxx", None)]
    labels = [(i, s) for i in range(60) for s in truth[i]] + [(0, "unknown"), (None, "law"), (1, sorted(truth[1])[0])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").withColumn("subject", F.lit("clash"))
    got = subjects.document_subjects(frame, spark.createDataFrame(labels, "doc_id bigint, subject string"), spark.createDataFrame([(s, s) for s in names], "subject string, title string")).collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], set()).add(r["subject"])
    held_out = range(60, 300)
    assert np.mean([found.get(i) == truth[i] for i in held_out]) > 0.95
    assert not {900, 901} & set(found) and all(1 <= len(v) <= 3 for v in found.values())
    none = subjects.document_subjects(frame, spark.createDataFrame([], "doc_id bigint, subject string"), spark.createDataFrame([("law",)], "subject string"))
    assert none.count() == 0
    assert subjects.document_subjects(frame.limit(0), spark.createDataFrame(labels, "doc_id bigint, subject string"), spark.createDataFrame([("law",)], "subject string")).count() == 0
