"""Match keys: the forms under which a phrase can be found, whatever its spelling of optional and alternative parts."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence
from itertools import product

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are no key by themselves, and words that stand for a person, thing, place or owner.
STOP_KEYS = frozenset("a an the to of in at on with for and or as so if when by someone something somebody sb sth sw etc s".split())
_STANDS_FOR = "someone something somebody somewhere sth sb oneself yourself himself herself themselves".split()
_OWNERS = ["someone's", "somebody's", "one's", "your", "their", "his", "her", "my", "our"]

_PLACE = "|".join(_STANDS_FOR)
_DROPPED = re.compile(rf"\b(?:{_PLACE})/+(?:{_PLACE})\b"), re.compile(rf"\b(?:{_PLACE}|doing)\b"), re.compile(r"\b(?:" + "|".join(_OWNERS) + r")\b")
_OPTION = re.compile(r"\(([^)]+)\)")
_CHOICE = re.compile(r"\b(\w+(?:/\w+)+)\b")


def _spelt(pieces: list[str], choices: Callable[[str], Sequence[str]], glue: str) -> set[str]:
    """Every text that picks one of its choices for each odd piece."""
    return {glue.join(picked) for picked in product(*[choices(p) if i % 2 else (p,) for i, p in enumerate(pieces)])}


def alternatives(text: str) -> set[str]:
    """The readings of a phrase with slashes.

    Slashes stand between whole phrases if these are all of one word or all of several, otherwise between the words
    beside them. With digits or single letters ("24/7", "a/c") a slash belongs to the word.
    """
    sides = [side.strip() for side in text.split("/")]
    if re.search(r"\d", text) or any(len(side) < 2 for side in sides):
        return {text}
    pieces = _CHOICE.split(text)
    if len(pieces) > 1 and 0 < sum(" " in side for side in sides) < len(sides):
        return _spelt(pieces, lambda words: words.split("/"), "")
    return set(sides)


def match_keys(text: str | None) -> list[str]:
    """Sorted keys of a phrase: letters a-z and digits only, with and without optional parts, each alternative by
    itself, with blanks and (where there is no digit) without. Every optional part counts, so a phrase of n of them has
    up to 2^n keys."""
    plain = unicodedata.normalize("NFD", (text or "").strip().lower().replace("’", "'"))
    plain = re.sub(r"[.\u0300-\u036f]", "", re.sub(r"^(?:the|an?)\s+", "", re.sub(r"[_:-]", " ", plain)))
    letter = re.fullmatch(r"([a-z]),\s*[a-z]", plain)
    plain = letter.group(1) if letter else plain
    for words in _DROPPED:
        plain = words.sub(" ", plain)
    found = set()
    for whole in _spelt(_OPTION.split(plain), lambda inner: (inner, ""), " "):
        for reading in alternatives(whole):
            words = re.sub(r"[^a-z0-9\s]", "", reading).split()
            forms = [" ".join(words)] if " ".join(words) not in STOP_KEYS else []
            found.update(forms + ["".join(words)] * (bool(forms) and not re.search(r"\d", forms[0])))
    return sorted(found - STOP_KEYS - {""})


def match_keys_column(text: str | Column) -> Column:
    """array<string> of match keys, in Arrow batches; equal texts of a batch are read once."""

    def keyed(texts: pd.Series) -> pd.Series:
        return texts.map({t: match_keys(t) for t in texts.unique()})

    return F.pandas_udf(keyed, "array<string>")(text)


def register_match_keys(spark, name: str = "match_keys") -> None:
    """The table function `SELECT ... FROM t, LATERAL match_keys(t.phrase)` with one row per key."""

    @F.udtf(returnType="key string")
    class Keys:
        def eval(self, text: str):
            for key in match_keys(text):
                yield (key,)

    spark.udtf.register(name, Keys)
