"""Queries of text functions over small fixed inputs, which no table of the test data holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.functions import pages as pg
from glossarium.functions import redirects as rd
from glossarium.functions import text as tx
from glossarium.functions.keys import match_keys_column
from glossarium.functions.phrases import normalize_expression_column
from glossarium.operators import alignment as al
from glossarium.operators import variants as va
from glossarium.sources import files as fi

DEFINITIONS = (
    (1, "past simple of go"), (2, "US spelling of colour"), (3, "→ colour"), (4, "abbreviation for doctor"), (5, "another word for sofa"), (6, "a large animal"), (7, "short form of laboratory: informal"),
    (8, "abbreviation for a group consisting of letters"), (9, "the UK spelling of theater"), (10, "another spelling of gipsy"), (11, "plural of goose"), (12, ""),
)
URLS = (
    (1, "http://wordnet-rdf.example.org/wn31/302193771-a/"), (2, "http://wordnet-rdf.example.org/wn31/100001740-n"), (3, "http://example.org/other"), (4, "/thesaurus/big?q=1"), (5, "/topics/animals/birds/"),
)
PHRASES = (
    (1, "ask somebody back"), (2, "act for/on behalf of somebody/something"), (3, "strike a deal/agreement"), (4, "something for nothing"), (5, "a/c"), (6, "take notice, account, etc. of something"), (7, "lose your/someone's way"),
)
KEYS = ((1, "Hip-Hop"), (2, "the Café"), (3, "colo(u)r"), (4, "do/make"), (5, "24/7"), (6, "lose one's way"), (7, "B, b"), (8, "the"))
LINES = ("alpha\tAlpha\tword", "beta\tidiom", "gamma", "", "alpha\tAlfa\tword")
CRAWL = "".join(f'<li><a href="{u}" title="{t}">x</a></li>' for u, t in (("/dictionary/english/give-up", "give up phrasal verb"), ("/dictionary/english/seed", "seed definition"), ("/dictionary/english/seed", "again"), ("/browse/english/a/aa-ab/", ""), ("/browse/english/b/", "")))
ENTRY_PAGE = """
<div class="dictionary"><h2 class="c_hh">Handbook of Words</h2>
<div class="entry-body__el"><div class="pos-header"><span class="hw dhw">seed</span><span class="pos dpos">noun</span>
<span class="posgram"><span class="gram dgram"><span class="gc dgc">C</span><span class="gc dgc">U</span></span></span>
<span class="uk dpron-i"><span class="daud"><audio><source type="audio/ogg" src="/x.ogg"><source type="audio/mpeg" src="//host/x.mp3"></audio></span><span class="ipa dipa">siːd</span></span>
<span class="irreg-infls"><span class="inf-group"><span class="lab">plural</span><b class="inf">seeds</b></span><span class="inf-group"><b class="inf">-x-</b></span></span></div>
<div class="dsense"><span class="guideword dsense_gw">(PLANT)</span><div class="ddef_block"><div class="ddef_h"><span class="epp-xref">B2</span><div class="def ddef_d">a small hard part of a plant:</div></div>
<div class="examp dexamp"><span class="lu dlu">sow seeds</span><span class="eg deg">Sow the seeds in spring.</span></div>
<h4>Opposite</h4><a href="/thesaurus/fruit?q=1">fruit</a></div>
<div class="daccord"><span class="daccord_lt">More examples</span><ul><li class="eg dexamp hax">Birds eat seeds.</li></ul></div></div></div>
<div class="smartt daccord"><span class="daccord_lt"><a href="/topics/plants/seeds/">Seeds</a></span><div class="daccord_lb"><a href="/dictionary/english/sow">sow</a></div></div>
<a href="/collocation/seed">c</a></div>
"""
REDIRECTS = ((2, "noun", "UK spelling of color"), (4, "noun", "abbreviation for doctor"), (1, "noun", "US spelling of colour"), (6, "verb", "another word for color"))
WORDS = ((1, "color", "color"), (2, "colour", "colour"), (3, "doctor", "doctor"), (4, "dr", "Dr"), (5, "grey", "grey"), (6, "tint", "tint"))
ANSWERS = (
    (1, '<think>well</think>```json\n{"results":[{"task_id":"seed_noun","unified_senses":[{"definition":" part of a plant ","cambridge_senses":[1,"2",9],"wordnet_synsets":[1.9]}]}]}\n```'),
    (2, '[{"task_id":"seed_noun","unified_senses":[{"definition":"a player","cambridge_senses":[2],"wordnet_synsets":["x"]}]},{"task_id":"other_verb","unified_senses":[]}]'),
    (3, '{"task_id":"seed_noun","unified_senses":[{"definition":null,"cambridge_senses":null,"wordnet_synsets":[1]}]}'),
    (4, "no answer"),
)


def _quote(v: object) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


def _values(rows: tuple, *columns: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(_quote, r)) + ")" for r in rows) + f") AS t({', '.join(columns)})"


def redirect_predicate(spark: SparkSession, d: str) -> DataFrame:
    df = spark.createDataFrame(DEFINITIONS, "id int, definition string")
    return df.select("id", rd.is_redirect("definition").alias("redirect"), rd.redirect_type("definition").alias("type"), rd.raw_target("definition").alias("target"))


def wordnet_url(spark: SparkSession, d: str) -> DataFrame:
    df = spark.createDataFrame(URLS, "id int, url string")
    return df.select("id", tx.synset_of_url("url").alias("synset_id"), tx.url_slug("url").alias("slug"))


def normalize_expression(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(PHRASES, "id int, phrase string").select("id", normalize_expression_column("phrase").alias("canonical"))


def match_keys(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(KEYS, "id int, phrase string").select("id", F.array_join(match_keys_column("phrase"), "|").alias("keys"))


def ragged_tsv(spark: SparkSession, d: str) -> DataFrame:
    return fi.ragged_words(spark.createDataFrame([(x,) for x in LINES], "value string"))


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Chunk pages and entries named by a list page."""
    df = spark.createDataFrame([(CRAWL,)], "html string")
    browse = pg.deep_links(pg.links("html", r'href="(/browse/english/[^/]+/[^/"]+/)"', "https://host"), 7)
    chunk = df.select(F.lit("chunk").alias("kind"), F.explode(browse).alias("target"), F.lit(None).cast("string").alias("title"))
    entry = df.select(F.lit("entry").alias("kind"), F.inline(pg.entry_links("html"))).select("kind", F.col("slug").alias("target"), "title")
    return chunk.unionByName(entry)


def page_parse(spark: SparkSession, d: str) -> DataFrame:
    """One row per sense of a page, with what its entry says."""
    e = spark.createDataFrame([(ENTRY_PAGE,)], "html string").select(F.explode(pg.parse_page_column("html")).alias("e"))
    flat = e.select("e.headword", "e.pos", "e.grammar", "e.pronunciation_uk", "e.audio_uk_url", "e.dictionary_source", "e.inflections", "e.has_collocations", F.explode("e.senses").alias("s"))
    return flat.select(
        "headword", "pos", "grammar", "pronunciation_uk", "audio_uk_url", "dictionary_source", F.size("inflections").alias("n_inflections"), "has_collocations", F.col("s.guideword").alias("guideword"),
        F.col("s.definition").alias("definition"), F.col("s.cefr_level").alias("cefr_level"), F.size("s.examples").alias("n_examples"), F.col("s.synonyms")[0]["slug"].alias("synonym"), F.col("s.synonyms")[0]["is_antonym"].alias("is_antonym"),
    )


def uk_us_redirect(spark: SparkSession, d: str) -> DataFrame:
    words = spark.createDataFrame(WORDS, "id bigint, word string, display_form string")
    redirects = spark.createDataFrame(REDIRECTS, "word_id bigint, pos string, definition string")
    parsed = va.parsed_redirects(redirects, words)
    return va.alternatives(parsed, va.british_to_american(parsed), words)


def llm_response_parse(spark: SparkSession, d: str) -> DataFrame:
    df = spark.createDataFrame(ANSWERS, "id int, content string")
    return al.parsed_answers(df).select("task_id", "place", "definition", F.array_join(F.transform("left", lambda x: x.cast("string")), ",").alias("left_numbers"), F.array_join(F.transform("right", lambda x: x.cast("string")), ",").alias("right_numbers"))


QUERIES = {f.__name__: f for f in (redirect_predicate, wordnet_url, normalize_expression, match_keys, ragged_tsv, page_links, page_parse, uk_us_redirect, llm_response_parse)}
SQL = {
    "redirect_predicate": f"""WITH t AS (SELECT * FROM {_values(DEFINITIONS, 'id', 'definition')}), l AS (SELECT *, lower(definition) AS s FROM t),
k AS (SELECT *, CASE WHEN regexp_matches(s, '^(the )?(us|uk)? ?spelling of ') THEN 'UK spelling' WHEN regexp_matches(s, '^abbreviation (for|of) ') AND s NOT LIKE '%consisting of%' THEN 'abbreviation'
 WHEN s LIKE 'short form of %' THEN 'short form' WHEN s LIKE '→ %' THEN 'arrow' WHEN s LIKE 'another spelling of %' THEN 'another spelling' WHEN s LIKE 'another word for %' THEN 'another word' END AS type FROM l)
SELECT id, type IS NOT NULL OR s LIKE 'past simple of %' OR s LIKE 'plural of %' AS redirect, type,
 CASE WHEN type IS NOT NULL THEN regexp_extract(definition, '(?:spelling of|abbreviation for|short form of|→|another word for) ([^:]*)', 1) END AS target FROM k""",
    "wordnet_url": rf"""SELECT id, CASE WHEN regexp_matches(url, 'wn31/\d{{9}}-[a-z]') THEN 'oewn-' || regexp_extract(url, 'wn31/\d(\d{{8}})', 1) || '-' || regexp_extract(url, '-([a-z])/?$', 1) END AS synset_id,
 regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/*$', 1) AS slug FROM {_values(URLS, 'id', 'url')}""",
    "ragged_tsv": "SELECT * FROM (VALUES ('alpha', 'Alfa', 'word'), ('beta', 'beta', 'idiom'), ('gamma', 'gamma', 'word')) AS t(word, display_form, entry_type)",
    "page_links": f"""WITH h AS (SELECT {_quote(CRAWL)} AS html), e AS (SELECT unnest(regexp_extract_all(html, 'href="/dictionary/english/([^"]+)"', 1)) AS target, unnest(regexp_extract_all(html, 'href="/dictionary/english/[^"]+" title="([^"]*)"', 1)) AS title, generate_subscripts(regexp_extract_all(html, 'href="/dictionary/english/([^"]+)"', 1), 1) AS i FROM h)
SELECT 'chunk' AS kind, 'https://host' || unnest(regexp_extract_all(html, 'href="(/browse/english/[^/]+/[^/"]+/)"', 1)) AS target, NULL::VARCHAR AS title FROM h
UNION ALL SELECT 'entry', target, arg_min(title, i) FROM e GROUP BY target""",
}
