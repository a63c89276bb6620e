"""Column builders for lexical text; everything stays in whole-stage code."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Relation names of the lexicon and of the concept graph, and the relation types they become.
SYNSET_RELATIONS = {
    "hypernym": "hypernym", "instance_hypernym": "hypernym", "hyponym": "hyponym", "instance_hyponym": "hyponym", "mero_part": "part_meronym", "holo_member": "member_holonym",
    "causes": "cause", "entails": "entailment", "similar": "similar_to", "attribute": "attribute", "domain_topic": "domain_topic", "has_domain_topic": "domain_topic",
    "domain_region": "domain_region", "has_domain_region": "domain_region", "domain_usage": "domain_usage", "has_domain_usage": "domain_usage",
    "derivation": "derivationally_related", "pertainym": "derivationally_related", "participle": "derivationally_related",
}
CONCEPT_RELATIONS = {
    "Antonym": "antonym", "CapableOf": "capable_of", "Causes": "causes", "HasProperty": "has_property", "MadeOf": "part_of", "PartOf": "part_of", "Synonym": "synonym", "UsedFor": "used_for",
}
CEFR_LEVELS = ("A1", "A2", "B1", "B2", "C1", "C2")
CEFR_ORDER = (*CEFR_LEVELS, "Not Annotated")
#: Parts of speech that are compatible with every other one when a synonym is looked up.
WILDCARD_POS = ("collocation", "phrase", "idiom", "expression", "exclamation", "preposition", "conjunction", "determiner", "pronoun", "number", "prefix", "suffix")

_ACCENTED = [chr(c) for c in range(0xC0, 0x250) if len(d := unicodedata.normalize("NFD", chr(c))) > 1 and all(unicodedata.category(x) == "Mn" for x in d[1:])]
_PLAIN = [unicodedata.normalize("NFD", c)[0] for c in _ACCENTED]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c: str | Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(F.regexp_replace(col(c), r"^\s+", ""), r"\s+$", "")


def key_form(c: str | Column) -> Column:
    """Lower case without surrounding white space: how words are compared."""
    return strip_space(F.lower(col(c)))


def blank(c: str | Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(strip_space(c), F.lit("")) == ""


def filled(c: str | Column) -> Column:
    """The value, or null where it is empty."""
    return F.when(col(c) != "", col(c))


def slugify(c: str | Column) -> Column:
    """Lower case letters and digits of any script, words joined by single hyphens."""
    kept = F.regexp_replace(strip_space(F.lower(col(c))), r"(?U)[^\w\s-]", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(kept, r"(?U)[\s_]+", "-"), "-+", "-"), "^-|-$", "")


def strip_accents(c: str | Column) -> Column:
    """Latin letters without their marks; marks that stand alone are dropped."""
    return F.regexp_replace(F.translate(col(c), "".join(_ACCENTED), "".join(_PLAIN)), r"\p{Mn}", "")


def display_name(display: str | Column, slug: str | Column) -> Column:
    """The display form, or the slug with blanks where there is none."""
    return F.coalesce(filled(display), F.regexp_replace(col(slug), "-", " "))


def effective_word(phrase: str | Column, display: str | Column) -> Column:
    """The phrase a sense belongs to, or else the word."""
    return F.when(blank(phrase), strip_space(display)).otherwise(strip_space(phrase))


def effective_pos(pos: str | Column) -> Column:
    return F.when(blank(pos), F.lit("phrase")).otherwise(strip_space(pos))


def _first_of(c: Column, tests: list[tuple[tuple[str, ...], str]]) -> Column:
    out: Column | None = None
    for needles, value in tests:
        hit = reduce(lambda a, b: a | b, [c.contains(n) for n in needles])
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def map_pos(pos: str | Column, compat: bool = False) -> Column:
    """n, r, v, a or null from a part of speech as written; with compat "pronoun" counts as noun."""
    p = key_form(pos)
    found = _first_of(p, [(("noun",), "n"), (("adverb", "adv"), "r"), (("verb",), "v"), (("adjective", "adj"), "a")])
    return found if compat else F.when(p.contains("pronoun"), F.lit(None)).otherwise(found)


def pos_enum(pos: str | Column, compat: bool = False) -> Column:
    """noun, verb, adjective, adverb or other. With compat "verb" is tested before "adverb", as earlier versions did."""
    p = F.coalesce(key_form(pos), F.lit(""))
    if compat:
        found = _first_of(p, [(("noun",), "noun"), (("verb",), "verb"), (("adjective", "adj"), "adjective"), (("adverb", "adv"), "adverb")])
        return F.coalesce(_letter_class(p), found, F.lit("other"))
    found = _first_of(p, [(("pronoun",), "other"), (("noun",), "noun"), (("adverb", "adv"), "adverb"), (("verb",), "verb"), (("adjective", "adj"), "adjective")])
    return F.coalesce(_letter_class(p), found, F.lit("other"))


def _letter_class(p: Column) -> Column:
    return F.when(p == "n", "noun").when(p == "v", "verb").when(p.isin("a", "s"), "adjective").when(p == "r", "adverb")


def pos_letter_enum(letter: str | Column) -> Column:
    return F.coalesce(_letter_class(key_form(letter)), F.lit("other"))


def any_pos_enum(pos: str | Column, compat: bool = False) -> Column:
    """Single letters by the letter table, anything else by its words."""
    return F.when(F.length(strip_space(pos)) == 1, pos_letter_enum(pos)).otherwise(pos_enum(pos, compat))


def normalize_pos(pos: str | Column, compat: bool = False) -> Column:
    """n, v, a, r, or the part of speech itself in lower case."""
    p = F.coalesce(key_form(pos), F.lit(""))
    order = [(("noun",), "n"), (("verb",), "v"), (("adjective", "adj"), "a"), (("adverb", "adv"), "r")] if compat else [(("pronoun",), "pronoun"), (("noun",), "n"), (("adverb", "adv"), "r"), (("verb",), "v"), (("adjective", "adj"), "a")]
    return F.coalesce(_first_of(p, order), p)


def guess_entry_type(word: str | Column, pos: str | Column) -> Column:
    many = col(word).rlike("[ -]")
    return F.when(many & (col(pos) == "verb"), "phrasal_verb").when(many, "phrase").otherwise("word")


def inflection_types(form_type: str | Column, pos: str | Column) -> Column:
    """array<string>: none, one or two inflection types of a label."""
    f = F.coalesce(key_form(form_type), F.lit(""))
    one = lambda v: F.array(F.lit(v))
    return (
        F.when(f == "plural", one("plural"))
        .when(f.isin("past tense", "past"), one("past_tense"))
        .when(f == "past participle", one("past_participle"))
        .when(f == "present participle", one("present_participle"))
        .when(f == "past tense and past participle", F.array(F.lit("past_tense"), F.lit("past_participle")))
        .when((f == "singular") & (col(pos) == "verb"), one("third_person_singular"))
        .otherwise(F.array().cast("array<string>"))
    )


def pos_compatible(a: str | Column, b: str | Column) -> Column:
    return (col(a) == "other") | (col(b) == "other") | (col(a) == col(b))


def title_type(slug: str | Column, title: str | Column, compat: bool = False) -> Column:
    """phrasal_verb, idiom, phrase, word or expression. With compat a label also counts inside a longer word."""
    t = F.lower(col(title))
    has = (lambda label: t.contains(label)) if compat else (lambda label: t.rlike(rf"\b{label}\b"))
    plain = ~col(slug).contains("-") & F.regexp_replace(col(slug), "'", "").rlike(r"^\p{L}+$")
    return F.when(has("phrasal verb"), "phrasal_verb").when(has("idiom"), "idiom").when(has("phrase"), "phrase").when(plain, "word").otherwise("expression")


def title_display(slug: str | Column, title: str | Column, compat: bool = False) -> Column:
    """The title up to its first label, or the slug with blanks where nothing is left."""
    edge = "" if compat else r"\b"
    cut = strip_space(F.regexp_replace(col(title), rf"(?is)\s*{edge}(phrasal verb|idiom|phrase|definition){edge}.*$", ""))
    return F.coalesce(filled(cut), F.regexp_replace(col(slug), "-", " "))


def synset_of_url(url: str | Column) -> Column:
    """oewn-XXXXXXXX-p of a lexicon address such as .../wn31/302193771-a, null for others; the leading digit tells the part of speech."""
    m = r"wn31/(\d)(\d{8})-([a-z])"
    return F.when(col(url).rlike(m), F.concat(F.lit("oewn-"), F.regexp_extract(col(url), m, 2), F.lit("-"), F.regexp_extract(col(url), m, 3)))


def first_int(c: str | Column) -> Column:
    """The first run of digits as a number, null if there is none."""
    return F.nullif(F.regexp_extract(col(c), r"(\d+)", 1), F.lit("")).try_cast("bigint")


def url_slug(url: str | Column) -> Column:
    """Last part of a path, without query, fragment and trailing slash."""
    path = F.regexp_replace(F.regexp_replace(col(url), r"[?#].*$", ""), "/+$", "")
    return F.substring_index(path, "/", -1)


def json_weight(metadata: str | Column) -> Column:
    """The weight in a JSON text, 1.0 where there is none or the text is broken."""
    return F.coalesce(F.get_json_object(F.when(F.try_parse_json(col(metadata)).isNotNull(), col(metadata)), "$.weight").try_cast("double"), F.lit(1.0))


def ten_minutes(ts: str | Column) -> Column:
    """`yyyy-MM-dd HH:m0`, the ten-minute bucket of a time."""
    return F.concat(F.substring(col(ts).cast("string"), 1, 15), F.lit("0"))


def ratio(n: str | Column, d: str | Column) -> Column:
    """n / d, and 0 where d is 0."""
    return F.when(col(d) != 0, col(n) / col(d)).otherwise(F.lit(0.0))


def f1(precision: str | Column, recall: str | Column) -> Column:
    return ratio(2 * col(precision) * col(recall), col(precision) + col(recall))


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def unit(v: str | Column) -> Column:
    """The vector scaled to length 1; the zero vector stays."""
    size = F.sqrt(F.aggregate(col(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(col(v), lambda x: F.when(size > 0, x.cast("double") / size).otherwise(F.lit(0.0)))


def source_category(source: str | Column, kinds: dict[str, str], other: str = "Other") -> Column:
    """The label of the first pattern that the source is like, in any letter case."""
    out: Column | None = None
    for pattern, label in kinds.items():
        out = F.when(col(source).ilike(pattern), label) if out is None else out.when(col(source).ilike(pattern), label)
    return out.otherwise(other)


def numbered_lines(items: str | Column) -> Column:
    """`[1] first`, `[2] second` and so on, one a line, from an array of texts."""
    return F.array_join(F.transform(col(items), lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), x)), "\n")


def model_text(content: str | Column) -> Column:
    """A model's answer without reasoning and code fences."""
    bare = strip_space(F.regexp_replace(col(content), r"(?s)<think>.*?</think>", ""))
    return strip_space(F.regexp_replace(bare, r"```(?:json)?\s*", ""))


def cache_key(system: str | Column, user: str | Column, effort: str | Column) -> Column:
    """Content address of a model request."""
    return F.sha2(F.to_json(F.struct(col(effort).alias("effort"), col(system).alias("system_prompt"), col(user).alias("user_prompt"))), 256)
