import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glossarium.functions import pages as pg
from glossarium.functions import redirects as rd
from glossarium.functions import text as tx
from glossarium.functions.keys import match_keys
from glossarium.functions.phrases import common_parts, flat, normalize_expression, with_articles
from pyspark.sql import functions as F


def one(spark, column, **values):
    names = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], names).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("text", "keys"),
    [
        ("Hip-Hop", {"hip hop", "hiphop"}), ("the Café", {"cafe"}), ("colo(u)r", {"colo u r", "colour", "colo r", "color"}), ("do/make", {"do", "make"}), ("24/7", {"247"}),
        ("lose one's way", {"lose way", "loseway"}), ("lose someone's way", {"lose s way", "losesway"}), ("B, b", {"b"}), ("the", set()), ("and/or", set()), ("", set()), (None, set()),
    ],
)
def test_match_keys(text, keys):
    assert set(match_keys(text)) == keys


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc ()/-'.", max_size=20))
def test_match_keys_hold_only_letters_and_blanks(text):
    assert all(set(k) <= set("abcdefghijklmnopqrstuvwxyz0123456789 ") and k.strip() == k for k in match_keys(text))


@pytest.mark.parametrize(
    ("text", "form"),
    [
        ("ask somebody back", "ask {sb} back"), ("act for/on behalf of somebody/something", "act (for|on) behalf of ({sb}|{sth})"), ("strike a deal/agreement", "strike (a deal|an agreement)"),
        ("something for nothing", "something for nothing"), ("a/c", "a/c"), ("lose your/someone's way", "lose {possessive} way"), ("take notice, account, etc. of something", "take (notice|account|{any}) of {sth}"),
        ("against (all) the odds/against all odds", "(against [all] the odds|against all odds)"), ("one-/two-, etc. alarm", "(one-alarm|two-alarm|{any})"), ("something", "something"), (None, None),
    ],
)
def test_normalize_expression(text, form):
    assert normalize_expression(text) == form


def test_phrase_parts():
    assert with_articles(["a dog", "owl", "cats"]) == ["a dog", "an owl", "cats"]
    assert with_articles(["dog", "owl"]) == ["dog", "owl"]
    assert common_parts(["do {sth}", "nothing", "{any}"])[0] == "do"
    assert common_parts(["in the way", "on the way"]) == ("", ["in", "on"], "the way")
    assert flat("(a|(b|c))") == "(a|b|c)"


@pytest.mark.parametrize(
    ("pos", "letter", "kind", "compat", "short"),
    [("noun", "n", "noun", "noun", "n"), ("phrasal verb", "v", "verb", "verb", "v"), ("adverb", "r", "adverb", "verb", "r"), ("adv", "r", "adverb", "adverb", "r"), ("pronoun", None, "other", "noun", "pronoun"), ("adjective", "a", "adjective", "adjective", "a"), ("s", None, "adjective", "adjective", "s"), ("n", None, "noun", "noun", "n"), ("v", None, "verb", "verb", "v"), ("r", None, "adverb", "adverb", "r"), ("a", None, "adjective", "adjective", "a"), ("idiom", None, "other", "other", "idiom"), ("", None, "other", "other", "")],
)
def test_pos(spark, pos, letter, kind, compat, short):
    row = spark.createDataFrame([(pos,)], "p string").select(tx.map_pos("p"), tx.pos_enum("p"), tx.pos_enum("p", compat=True), tx.normalize_pos("p"), tx.map_pos("p", compat=True)).first()
    assert tuple(row[:4]) == (letter, kind, compat, short)
    assert row[4] == ("n" if pos == "pronoun" else letter)


def test_text_columns(spark):
    assert one(spark, tx.slugify("t"), t="Rock 'n' Roll!") == "rock-n-roll"
    assert one(spark, tx.slugify("t"), t="Über_die  Straße") == "über-die-straße"
    assert one(spark, tx.strip_accents("t"), t="Ça déjà ñ") == "Ca deja n"
    assert one(spark, tx.first_int("t"), t="id 12 of 7") == 12
    assert one(spark, tx.first_int("t"), t="none") is None
    assert one(spark, tx.json_weight("t"), t='{"weight": 2.5}') == 2.5
    assert one(spark, tx.json_weight("t"), t="{broken") == 1.0
    assert one(spark, tx.json_weight("t"), t="{}") == 1.0
    assert one(spark, tx.synset_of_url("t"), t="http://host/wn31/302193771-a/") == "oewn-02193771-a"
    assert one(spark, tx.url_slug("t"), t="/thesaurus/big/?q=1#x") == "big"
    assert one(spark, tx.model_text("t"), t='<think>a\nb</think>```json\n{"a":1}\n```') == '{"a":1}'
    assert one(spark, tx.display_name("d", "s"), d="", s="give-up") == "give up"
    assert one(spark, tx.effective_word("p", "d"), p=" ", d="seed ") == "seed"
    assert one(spark, tx.guess_entry_type("w", "p"), w="hour hand", p="noun") == "phrase"
    assert one(spark, tx.ten_minutes("t"), t="2024-01-02 03:45:06") == "2024-01-02 03:40"


@pytest.mark.parametrize(
    ("slug", "title", "kind", "display", "compat_kind"),
    [("give-up", "give up phrasal verb", "phrasal_verb", "give up", "phrasal_verb"), ("hip-hop", "hip-hop definition", "expression", "hip-hop", "expression"), ("phrasebook", "phrasebook definition", "word", "phrasebook", "phrase"), ("o'clock", "o'clock", "word", "o'clock", "word")],
)
def test_titles(spark, slug, title, kind, display, compat_kind):
    row = spark.createDataFrame([(slug, title)], "s string, t string").select(tx.title_type("s", "t"), tx.title_display("s", "t"), tx.title_type("s", "t", compat=True), tx.title_display("s", "t", compat=True)).first()
    assert tuple(row) == (kind, display, compat_kind, display)


def test_inflections_and_compatibility(spark):
    rows = spark.createDataFrame([("past tense and past participle", "verb"), ("singular", "noun"), ("singular", "verb"), (None, "verb"), ("Plural ", "noun")], "f string, p string")
    assert [r[0] for r in rows.select(tx.inflection_types("f", "p")).collect()] == [["past_tense", "past_participle"], [], ["third_person_singular"], [], ["plural"]]
    pairs = spark.createDataFrame([("noun", "other"), ("noun", "verb"), ("verb", "verb")], "a string, b string")
    assert [r[0] for r in pairs.select(tx.pos_compatible("a", "b")).collect()] == [True, False, True]


def test_redirects(spark):
    texts = ["past simple of go", "US spelling of colour", "→ colour", "abbreviation for doctor", "another word for sofa", "a large animal", None, "", "spelling of a computer program", "mainly UK spelling of color noun"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(rd.is_redirect("t"), rd.redirect_type("t"), rd.raw_target("t"), rd.target_candidates("t"), rd.region_of("t")).collect()
    assert [r[0] for r in rows] == [True, True, True, True, True, False, False, False, False, True]
    assert [r[1] for r in rows[:6]] == [None, "UK spelling", "arrow", "abbreviation", "another word", None]
    assert [r[2] for r in rows[1:5]] == ["colour", "colour", "doctor", "sofa"]
    assert rows[9][3][:2] == ["color noun", "color"]
    assert (rows[1][4], rows[9][4]) == ("us", "uk")
    australian = spark.createDataFrame([("Australian spelling of x",)], "t string").select(rd.region_of("t"), rd.region_of("t", compat=True)).first()
    assert tuple(australian) == (None, "us")


def test_dot_and_unit(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, b array<float>").select(tx.unit("a"), tx.unit("b"), tx.dot("a", "a")).first()
    assert row[0] == [pytest.approx(0.6), pytest.approx(0.8)] and row[1] == [0.0, 0.0] and row[2] == 25.0


def test_pages():
    assert pg.parse_page(None) == [] and pg.parse_page("<p>") == []
    plain = pg.parse_page('<div class="di-body"><b class="hw">x</b><div class="ddef_block"><div class="def ddef_d">one:</div></div><div class="ddef_block"><div class="def ddef_d"> </div></div></div>')
    assert [s["definition"] for s in plain[0]["senses"]] == ["one"]
    own = pg.parse_page('<div class="dictionary"><h2 class="c_hh">X</h2><div class="entry-body__el"><b class="hw">x</b></div></div>')
    assert own[0]["dictionary_source"] == pg.MAIN_SOURCE
    page = '<div class="eg lbb lb-cm lpt-10"><a class="hdib tb lmb-10">big seed</a><div class="dexamp">A big seed.</div><div class="dsource">From the corpus</div></div>'
    assert pg.parse_collocations(page) == [{"collocation": "big seed", "example": "A big seed.", "source": "corpus"}]
    topics = pg.parse_page('<div class="entry-body__el"><b class="hw">x</b></div><div class="smartt daccord"><span class="daccord_lt"><a href="/topics/a/birds/">Birds</a></span></div>')[0]["topics"]
    assert topics == [{"slug": "birds", "title": "Birds", "url": "/topics/a/birds/", "related_slugs": []}]


def test_numbered_lines(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "x array<string>")
    assert [r[0] for r in df.select(tx.numbered_lines("x")).collect()] == ["[1] a\n[2] b", ""]
    assert df.select(tx.cache_key(F.lit("s"), F.lit("u"), F.lit("e")).alias("k")).distinct().count() == 1
