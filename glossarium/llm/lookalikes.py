"""One consistent character form for texts that look the same.

Texts are cut into tokens, the distinct tokens exploded to positioned code points, and these joined to broadcast
tables: compatibility and canonical decompositions, characters to drop, spaces, and look-alike letters. Combining
marks are then ordered by class, letters recomposed, and the strings rebuilt.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossarium.operators.skew import salted_lookup

TEXT, IPA = "text", "ipa"

# Letters of other scripts and the Latin letters they look like.
CYRILLIC_AS_LATIN = dict(zip("аеорсухіїјѕһԁԛԝкмтвнгпиьлԍѵАЕОРСУХІЇЈЅҺԀԚԜКМТВНZ", "aeopcyxiïjshdqwkmtbhrnublgvAEOPCYXIÏJSHDQWKMTBHZ"))
GREEK_AS_LATIN = dict(zip("αβγεηικνορςτυχωμϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "abyenikvopctuxwucjABEZHIKMNOPTYX"))
# Characters that only resemble the letter or mark of the phonetic alphabet.
LIKE_IPA = dict(
    zip(
        "'’‘`´′ʹʼ＇\":∶꞉g∫ſƒǝәεєɩιı∊αӕΛʋυᴜƱ∂đηзЗӡφγλꟾаеорсухіјѕһ",
        "ˈˈˈˈˈˈˈˈˈˈːːːɡʃʃʃəəɛɛɪɪɪɛɑæʌʊʊʊʊððŋɜʒʒɸɣʌɪaeopcuxijsh",
    )
)
#: Phonetic letters that belong to the Greek block and are right as they are.
_PHONETIC_GREEK = "βθχ"
_LATIN, _GREEK, _CYRILLIC = r"^\p{IsLatin}$", r"^\p{IsGreek}$", r"^\p{IsCyrillic}$"


@cache
def _decompositions() -> list[tuple[str, str, list[tuple[str, int]]]]:
    """(kind, character, parts with their combining classes) of every character that is not its own single part."""
    out = []
    for code in range(sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        c = chr(code)
        category = unicodedata.category(c)
        if category in ("Cf", "Cc") and not c.isspace():
            out += [(TEXT, c, []), (IPA, c, [])]
        elif c.isspace() or category == "Zs":
            out += [(k, c, [(" ", 0)]) for k in (TEXT, IPA) if c != " "]
        elif unicodedata.decomposition(c):
            raised = unicodedata.decomposition(c).startswith(("<super>", "<sub>"))
            for kind in (TEXT, IPA):
                whole = unicodedata.normalize("NFD" if raised and kind == IPA else "NFKD", c)
                if whole != c:
                    out.append((kind, c, [(p, unicodedata.combining(p)) for p in whole]))
        elif unicodedata.combining(c):
            out += [(TEXT, c, [(c, unicodedata.combining(c))]), (IPA, c, [(c, unicodedata.combining(c))])]
    return out


@cache
def _compositions() -> list[tuple[str, str]]:
    """(ordered decomposed letter, composed letter)."""
    every = (chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)
    return [(d, c) for c in every if len(d := unicodedata.normalize("NFD", c)) > 1 and unicodedata.normalize("NFC", d) == c]


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    decomposed = spark.createDataFrame(
        pd.DataFrame([(k, c, [{"ch": p, "ccc": n} for p, n in parts]) for k, c, parts in _decompositions()], columns=["kind", "ch", "parts"]),
        "kind string, ch string, parts array<struct<ch: string, ccc: int>>",
    )
    composed = spark.createDataFrame(pd.DataFrame(_compositions(), columns=["cluster", "composed"]), "cluster string, composed string")
    return decomposed, composed


def _alike(spark: SparkSession) -> DataFrame:
    rows = [("to-latin", a, b) for a, b in (CYRILLIC_AS_LATIN | GREEK_AS_LATIN).items() if a != b]
    rows += [("to-cyrillic", b, a) for a, b in reversed(CYRILLIC_AS_LATIN.items()) if a != b]
    rows += [("to-greek", b, a) for a, b in reversed(GREEK_AS_LATIN.items()) if a != b]
    rows += [("to-ipa", a, b) for a, b in LIKE_IPA.items()]
    return spark.createDataFrame(pd.DataFrame(dict.fromkeys(rows).keys(), columns=["direction", "ch", "like"]).drop_duplicates(["direction", "ch"]), "direction string, ch string, like string")


def _compose_rest(cluster: str) -> Column:
    """For letters with several marks of which only some can be composed."""

    def compose(clusters: pd.Series) -> pd.Series:
        return clusters.map(lambda x: unicodedata.normalize("NFC", x))

    return F.pandas_udf(compose, "string")(cluster)


def _direction() -> Column:
    """Which way a letter is to be read in its word: toward the script that most of the word's letters have."""
    is_latin, is_greek, is_cyrillic = F.col("latin") == 1, F.col("greek") == 1, F.col("cyrillic") == 1
    most = F.greatest("n_latin", "n_greek", "n_cyrillic")
    return (
        F.when(F.col("kind") == IPA, F.lit("to-ipa"))
        .when((F.col("n_latin") == most) & (is_greek | is_cyrillic), F.lit("to-latin"))
        .when((F.col("n_cyrillic") == most) & (F.col("n_latin") < most) & is_latin, F.lit("to-cyrillic"))
        .when((F.col("n_greek") == most) & (F.col("n_latin") < most) & is_latin, F.lit("to-greek"))
    )


def consistent_tokens(tokens: DataFrame) -> DataFrame:
    """(kind, token, consistent, mixed) for distinct tokens (kind, token); kind is "text" or "ipa".

    Compatibility forms are resolved, invisible characters dropped, any space made a plain one, marks put in the
    order of their classes and composed with their letter where a composed letter exists. In texts, a letter of
    another script inside a word becomes the letter it looks like of the script that most of the word has (Latin
    in a tie); whole words in another script stay. `mixed` tells that a word had letters of several scripts, also
    where no look-alike is known. In phonetic tokens, what only resembles a phonetic letter or mark becomes that
    letter or mark, and raised letters stay. Empty tokens stay empty.

    The tables are bounded by Unicode and are broadcast. The code points of one token are shuffled once, by token.
    """
    spark = tokens.sparkSession
    decomposed, composed = _tables(spark)
    per_token = W.partitionBy("kind", "token").orderBy("pos", "sub")
    per_word = W.partitionBy("kind", "token", "word")
    script = lambda p: F.col("ch").rlike(p).cast("int")
    points = (
        tokens.select("kind", "token", F.posexplode(F.split("token", "")).alias("pos", "ch"))
        .where("ch <> ''")
        .join(F.broadcast(decomposed), ["kind", "ch"], "left")
        .select("kind", "token", "pos", F.posexplode(F.coalesce("parts", F.array(F.struct("ch", F.lit(0).alias("ccc"))))).alias("sub", "part"))
        .select("kind", "token", "pos", "sub", F.col("part.ch").alias("ch"), F.col("part.ccc").alias("ccc"))
        .withColumns({"latin": script(_LATIN), "greek": script(_GREEK), "cyrillic": script(_CYRILLIC), "letter": script(r"^[\p{L}\p{M}]$")})
        .withColumn("jamo", F.col("ch").rlike("^[\\u1161-\\u1175\\u11A8-\\u11C2]$"))
        .withColumn("seg", F.sum(((F.col("ccc") == 0) & ~F.col("jamo")).cast("int")).over(per_token))
        .withColumn("word", F.sum(1 - F.col("letter")).over(per_token))
    )
    judged = points.withColumns({f"n_{s}": F.sum(s).over(per_word) for s in ("latin", "greek", "cyrillic")}).withColumn("direction", _direction())
    mixed = (F.col("kind") == TEXT) & ((F.col("n_latin") > 0).cast("int") + (F.col("n_greek") > 0).cast("int") + (F.col("n_cyrillic") > 0).cast("int") > 1)
    clusters = (
        judged.join(F.broadcast(_alike(spark)), ["direction", "ch"], "left")
        .groupBy("kind", "token", "seg")
        .agg(F.array_sort(F.collect_list(F.struct("ccc", "pos", "sub", F.coalesce("like", "ch").alias("ch")))).alias("chars"), F.max(mixed).alias("mixed"))
        .select("kind", "token", "seg", "mixed", F.array_join(F.transform("chars", lambda c: c["ch"]), "").alias("cluster"), F.size("chars").alias("n"))
        .join(F.broadcast(composed), "cluster", "left")
        .withColumn("composed", F.coalesce("composed", F.when(F.col("n") > 2, _compose_rest("cluster")), "cluster"))
    )
    done = clusters.groupBy("kind", "token").agg(F.array_sort(F.collect_list(F.struct("seg", "composed"))).alias("parts"), F.max("mixed").alias("mixed"))
    return tokens.join(done, ["kind", "token"], "left").select(
        "kind", "token", F.coalesce(F.array_join(F.transform("parts", lambda p: p["composed"]), ""), F.lit("")).alias("consistent"), F.coalesce("mixed", F.lit(False)).alias("mixed")
    )


def _token_rows(texts: DataFrame) -> DataFrame:
    """(row..., kind, token) of the tokens that are not plainly their own form; a phonetic text is one token.

    Tokens of printable ASCII stand for themselves: no decomposition, mark, other script or odd space is among
    them. Only for phonetic texts ASCII look-alikes exist.
    """
    cut = texts.withColumn("token", F.explode(F.when(F.col("kind") == IPA, F.array("text")).otherwise(F.array_distinct(F.split("text", " ")))))
    return cut.drop("text").where((F.col("kind") == IPA) & (F.col("token") != "") | F.col("token").rlike(r"[^\x20-\x7e]"))


def inconsistent_rows(texts: DataFrame, row: list[str]) -> DataFrame:
    """The row keys of texts (row..., kind, text) that hold a token which is not in its consistent form; each key once.

    Null and empty texts are consistent. A token held by a large part of the rows is spread over salts.
    """
    tokens = _token_rows(texts.where("text is not null").select(*row, "kind", "text"))
    changed = consistent_tokens(tokens.select("kind", "token").distinct()).where("consistent <> token or mixed").select("kind", "token")
    return salted_lookup(tokens, changed, ["kind", "token"], row, "left_semi").select(*row).distinct()


def consistent_texts(texts: DataFrame, row: list[str]) -> DataFrame:
    """(row..., text) with every text in consistent form; texts has (row..., kind, text), each key once; null stays null."""
    plain = F.col("text").isNull() | ((F.col("kind") == TEXT) & ~F.col("text").rlike(r"[^\x20-\x7e]"))
    odd = texts.where(~plain).select(*row, "kind", F.posexplode(F.when(F.col("kind") == IPA, F.array("text")).otherwise(F.split("text", " "))).alias("at", "token"))
    forms = consistent_tokens(odd.select("kind", "token").distinct()).select("kind", "token", "consistent")
    rebuilt = (
        salted_lookup(odd, forms, ["kind", "token"], [*row, "at"])
        .groupBy(*row)
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "consistent"))), lambda t: t["consistent"]), " ").alias("text"))
    )
    return texts.where(plain).select(*row, "text").unionByName(rebuilt)
