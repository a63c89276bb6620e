"""Definitions that only point to another word: which they are, of what kind, and where they point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossarium.functions.text import col, strip_space

# How definitions of inflected forms begin.
INFLECTED = (
    "past simple of ", "past simple and past participle of ", "past participle of ", "past participle, past simple of ", "present participle of ",
    "plural of ", "pl of ", "comparative of ", "superlative of ",
)
# Words that may stand before each kind, and phrases that show that it is a real definition.
_QUALIFIERS = "the a an mainly old-fashioned older old non-standard written informal offensive us uk english australian and".split()
_NOUNS = (
    ("UK spelling", "spelling", ("of",), ("computer program",)),
    ("abbreviation", "abbreviation", ("for", "of"), ("consisting of", "that consists")),
    ("short form", "short form", ("of", "for"), ("giving only", "combination of words")),
)
# The grammar of such a definition: qualifiers, the noun, a preposition, the target.
_KINDS = tuple((kind, rf"(?i)^(?:(?:{'|'.join(_QUALIFIERS)}) )*{noun} (?:{'|'.join(links)}) (.+)$", real) for kind, noun, links, real in _NOUNS)
_ARROW = "→ "
_PREFIXES = (("another spelling", "another spelling of "), ("another word", "another word for "))
# Labels that may follow the target.
LABELS = (
    "mainly disapproving", "mainly approving", "mainly informal", "mainly formal", "uk old-fashioned", "us old-fashioned", "mainly uk", "mainly us", "uk specialized", "us specialized",
    "old-fashioned", "informal", "formal", "specialized", "disapproving", "approving", "humorous", "slang", "literary", "trademark", "old use", "indian english", "australian english",
    "irish english", "uk", "us", "old", "noun", "verb", "adjective", "adverb", "s",
)


def _tidy(definition: str | Column) -> Column:
    return F.regexp_replace(strip_space(definition), r"\s+", " ")


def is_redirect(definition: str | Column) -> Column:
    """Whether a definition only points elsewhere; false for null."""
    s = _tidy(definition)
    low = F.lower(s)
    hit = s.startswith(_ARROW)
    for start in (*INFLECTED, *[p for _, p in _PREFIXES]):
        hit |= low.startswith(start)
    for _, pattern, real in _KINDS:
        veto = F.lit(False)
        for r in real:
            veto |= low.contains(r)
        hit |= s.rlike(pattern) & ~veto
    return F.coalesce(hit, F.lit(False))


def redirect_type(definition: str | Column) -> Column:
    """Kind of a redirect, null for inflected forms and real definitions."""
    s = _tidy(definition)
    low = F.lower(s)
    out: Column | None = None
    for name, pattern, real in _KINDS:
        veto = F.lit(False)
        for r in real:
            veto |= low.contains(r)
        test = s.rlike(pattern) & ~veto
        out = F.when(test, name) if out is None else out.when(test, name)
    out = out.when(s.startswith(_ARROW), "arrow")
    for name, start in _PREFIXES:
        out = out.when(low.startswith(start), name)
    return out


def raw_target(definition: str | Column) -> Column:
    """What a redirect names, up to the first `: ; ,` or "or", without quotes; labels may still follow it."""
    s = _tidy(definition)
    kind = redirect_type(definition)
    out: Column | None = None
    for name, pattern, _ in _KINDS:
        part = F.regexp_extract(s, pattern, 1)
        out = F.when(kind == name, part) if out is None else out.when(kind == name, part)
    out = out.when(kind == "arrow", F.substr(s, F.lit(3)))
    for name, start in _PREFIXES:
        out = out.when(kind == name, F.substr(s, F.lit(len(start) + 1)))
    return F.regexp_replace(strip_space(F.regexp_replace(out, r"(?s)([:;,]|\bor\b).*$", "")), "^[\"' ]+|[\"' ]+$", "")


def target_candidates(definition: str | Column, rounds: int = 4) -> Column:
    """array<string> of what the target may be, in the order to try: as written, then without one trailing label after
    another, each also without a leading "the"."""
    pattern = "(?i) (?:" + "|".join(sorted(LABELS, key=len, reverse=True)) + ")$"
    steps = [raw_target(definition)]
    for _ in range(rounds):
        steps.append(strip_space(F.regexp_replace(steps[-1], pattern, "")))
    every = F.array_distinct(F.array(*steps))
    both = F.flatten(F.transform(every, lambda t: F.array(t, F.regexp_replace(t, r"(?i)^the\s+", ""))))
    return F.filter(F.array_distinct(both), lambda t: t != "")


def region_of(definition: str | Column, compat: bool = False) -> Column:
    """us or uk if that is named before "spelling"; with compat also inside another word, as in "Australian"."""
    before = F.substring_index(F.lower(col(definition)), "spelling", 1)
    has = (lambda r: before.contains(r)) if compat else (lambda r: before.rlike(rf"\b{r}\b"))
    return F.when(has("us"), "us").when(has("uk"), "uk")
