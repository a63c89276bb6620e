"""Mapping free-entered values to a reference list: BK-trees under the Levenshtein metric."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import permutations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarium.operators.skew import spread

#: Reference lists up to this many entries go to every task; longer ones are cut into shards of this size.
SHARD_ENTRIES = 20_000
#: Radii of the search for short and for long values; what it returns is then judged. Two neighbouring letters that
#: change places cost 2 in the tree's metric and 1 in the judgement, so the radius is twice the edits allowed.
LONG, RADIUS_SHORT, RADIUS_LONG = 8, 2, 4
# What people type where there is no value.
PLACEHOLDERS = frozenset(["n/a", "na", "n.a.", "none", "null", "nil", "unknown", "tbc", "tbd", "tba"])

# Usual grammatical abbreviations and what they stand for.
ABBREVIATIONS = {
    "n": ("noun",), "nn": ("noun",), "ns": ("noun",), "v": ("verb",), "vb": ("verb",), "vt": ("verb",), "vi": ("verb",),
    "adj": ("adjective",), "a": ("adjective",), "adv": ("adverb",), "pron": ("pronoun",), "pn": ("pronoun",), "prep": ("preposition",), "conj": ("conjunction",),
    "det": ("determiner",), "excl": ("exclamation",), "exclam": ("exclamation",), "interj": ("exclamation",), "interjection": ("exclamation",),
    "phr": ("phrase", "phrasal"), "phrv": ("phrasal verb",), "pv": ("phrasal verb",), "id": ("idiom",), "idm": ("idiom",), "pref": ("prefix",), "suff": ("suffix",), "suf": ("suffix",),
    "mod": ("modal",), "modal": ("modal verb", "modal"), "aux": ("auxiliary", "auxiliary verb"), "auxv": ("auxiliary verb",), "num": ("number",), "abbr": ("abbreviation",), "abbrev": ("abbreviation",), "abb": ("abbreviation",),
    "pl": ("plural",), "plur": ("plural",), "sg": ("singular",), "sing": ("singular",), "comp": ("comparative",), "compar": ("comparative",), "super": ("superlative",), "superl": ("superlative",), "sup": ("superlative",),
    "pt": ("past tense", "past"), "pa": ("past",), "pp": ("past participle",), "prp": ("present participle",), "pres": ("present",), "part": ("participle",), "ptcp": ("participle",), "ppl": ("participle",), "past": ("past", "past tense"), "t": ("tense",),
}
# Labels, particles and placeholders that may be added to a term without changing which term it is.
ADDITIONS = frozenset(
    "to the a an sb sth sw somebody something someone somewhere ones one s be very quite rather etc usually often mainly formal informal uk us british american "
    "form forms only also spec old fashioned literary humorous rare dated slang c u t i or tr intr countable uncountable transitive intransitive before after noun verb plural singular not "
    "used with on upon up out in off at for of by it the".split()
)
LONG_VALUE = 12
_BRACKETED = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|<[^<>]*>")
_WORD = re.compile(r"[^\W_]+")
_AND = re.compile(r"[&+/]")


def levenshtein(a: str, b: str, limit: int) -> int:
    """Edit distance, or limit + 1 where it is more; the columns of the table are bit vectors."""
    if a == b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    m = len(a)
    if len(b) - m > limit:
        return limit + 1
    if not m:
        return len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top, score = (1 << m) - 1, 1 << m - 1, m
    up, down = full, 0
    for c in b:
        match = where.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus = plus << 1 | 1
        up, down = minus << 1 | ~(diagonal | plus) & full, plus & diagonal
        up &= full
        down &= full
    return score


def edits(a: str, b: str) -> int:
    """Edit distance in which two neighbouring letters that change places are one edit (in adjacent cells only)."""
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, d in enumerate(b, 1):
            cost = min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d))
            if i > 1 and j > 1 and c == b[j - 2] and a[i - 2] == d:
                cost = min(cost, last[j - 2] + 1)
            row.append(cost)
    return row[-1]


class BKTree:
    """Strings under the Levenshtein metric; a search visits only children the triangle inequality allows."""

    def __init__(self, keys: Iterable[str]) -> None:
        self.root: tuple[str, dict] | None = None
        for key in keys:
            self.add(key)

    def add(self, key: str) -> None:
        if self.root is None:
            self.root = (key, {})
            return
        node = self.root
        while True:
            d = levenshtein(key, node[0], 1 << 30)
            if d == 0:
                return
            if d not in node[1]:
                node[1][d] = (key, {})
                return
            node = node[1][d]

    def within(self, key: str, radius: int) -> list[tuple[int, str]]:
        """(distance, stored key) of every stored key within the radius."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            stored, children = stack.pop()
            d = levenshtein(key, stored, 1 << 30)
            if d <= radius:
                out.append((d, stored))
            stack += [child for edge, child in children.items() if d - radius <= edge <= d + radius]
        return out


def _plain(value: str) -> str:
    """Lower case, compatibility forms resolved, invisible characters dropped, any white space a blank."""
    text = unicodedata.normalize("NFKC", value).casefold()
    return " ".join("".join(" " if c.isspace() else "" if unicodedata.category(c) in ("Cf", "Cc") else c for c in text).split())


def _tokens(text: str) -> list[str]:
    return _WORD.findall(text.replace("'", "").replace("’", ""))


def forms(value: str, abbreviations: bool) -> list[tuple[int, tuple[str, ...]]]:
    """(cost, words) of the readings of a typed value, the literal one first.

    Readings without bracketed labels, without added labels or particles, with `&` read as `and`, with
    abbreviations written out, and with the words in another order. Costs order the readings, so that a
    plainer one wins. Of values of more than LONG_VALUE words each abbreviation has its first meaning only and
    labels are left out all together, not one by one; other orders of more than three words are not listed, as the
    search compares those in alphabetical order.
    """
    text = _plain(value)
    seen: dict[tuple[str, ...], int] = {}

    def put(cost: int, words: Sequence[str]) -> None:
        if words:
            seen.setdefault(tuple(words), cost)

    bare = _BRACKETED.sub(" ", text)
    bare = bare if _tokens(bare) else text
    for cost, t in ((0, text), (1, bare)):
        put(cost, _tokens(t))
        put(cost, _tokens(t.replace(".", "")))
        put(cost, _tokens(_AND.sub(" and ", t)))
        put(cost, _tokens(_AND.sub(" and ", t.replace(".", ""))))
    few = max(map(len, seen), default=0) <= LONG_VALUE
    plain = list(seen.items())
    for words, cost in list(seen.items()):
        added = [i for i, w in enumerate(words) if w in ADDITIONS]
        if len(words) > 1:
            put(cost + 2, [w for i, w in enumerate(words) if i not in added])
            for i in added if few else ():
                put(cost + 2, words[:i] + words[i + 1 :])
    if abbreviations:
        for words, cost in list(seen.items()) if few else plain:
            if any(w in ABBREVIATIONS for w in words):
                meanings = [(ABBREVIATIONS[w] if w in ABBREVIATIONS and w not in ("past", "modal") else (w, *ABBREVIATIONS.get(w, ()))) for w in words]
                for option in product(*meanings) if few else [[m[0] for m in meanings]]:
                    put(cost + 1, " ".join(option).split())
    for words, cost in list(seen.items()):
        if 1 < len(words) <= 3:
            for other in permutations(words):
                put(cost + 3, other)
        elif len(words) <= 8 and "and" in words:
            at = words.index("and")
            put(cost + 3, (*words[at + 1 :], "and", *words[:at]))
    return [(c, w) for w, c in seen.items()]


def acceptable(typed: str, stored: Sequence[str]) -> int | None:
    """Edits from the typed letters to a term's, or None where they are too many to be the same term.

    One edit is allowed for a term of four to seven letters, two for longer ones. Terms of up to three letters
    have to be exact.
    """
    term = "".join(stored)
    if abs(len(term) - len(typed)) > 2:
        return None
    n = edits(typed, term)
    if n == 0:
        return 0
    return None if len(term) <= 3 or len(typed) <= 2 or n > (1 if len(term) <= 7 else 2) else n


_LETTERS = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789")}


def _bag(text: str) -> np.ndarray:
    """How often each letter or digit occurs; all others count together."""
    out = np.zeros(len(_LETTERS) + 1, dtype=np.int32)
    for c in text:
        out[_LETTERS.get(c, -1)] += 1
    return out


class Matcher:
    """The reference entries of one shard, one tree per kind."""

    def __init__(self, terms: Iterable[tuple[int, str, str]], abbreviated: Sequence[str], words: Mapping[str, set[str]] | None = None) -> None:
        """words: those of the whole list by kind, where `terms` are only a part of it."""
        self.abbreviated, self.trees, self.by_key, self.words, self.bags = set(abbreviated), {}, {}, dict(words or {}), {}
        self.in_order: dict[str, BKTree] = {}
        self.by_order: dict[tuple[str, str], tuple[int, tuple[str, ...]]] = {}
        grouped: dict[str, list[tuple[int, str]]] = {}
        for term_id, kind, canonical in terms:
            grouped.setdefault(kind, []).append((term_id, canonical))
        for kind, entries in grouped.items():
            for term_id, canonical in sorted(entries):
                own = tuple(_tokens(_plain(canonical)))
                if own:
                    self.by_key.setdefault((kind, "".join(own)), (term_id, own))
                    if words is None:
                        self.words.setdefault(kind, set()).update(own)
                    if len(own) > 3:
                        self.by_order.setdefault((kind, "".join(sorted(own))), (term_id, own))
            keys = [key for k, key in self.by_key if k == kind]
            self.trees[kind] = BKTree(keys)
            self.in_order[kind] = BKTree(key for k, key in self.by_order if k == kind)
            self.bags[kind] = np.array([_bag(key) for key in keys]).reshape(len(keys), -1)

    def _near(self, kind: str, typed: str, most: int) -> bool:
        """Whether some entry's letters differ from the typed ones in at most so many; edits are never fewer than that."""
        gap = self.bags[kind] - _bag(typed)
        return bool(np.any(np.maximum(np.maximum(gap, 0).sum(axis=1), np.maximum(-gap, 0).sum(axis=1)) <= most))

    def find(self, kind: str, value: str) -> tuple[int, int]:
        """(rank, term_id) of the best entry, (-1, 0) if there is none.

        The rank grows with the edits, then with the reading's cost. A typed word that is literally a word of
        the list stands for itself and is never taken for a misspelling of another one.
        """
        best = None
        if _plain(value) in PLACEHOLDERS:
            return -1, 0
        readings = forms(value, kind in self.abbreviated)
        for cost, words in readings:
            hit = self.by_key.get((kind, "".join(words)))
            if hit and (best is None or (cost, hit[0]) < best):
                best = (cost, hit[0])
        if best:
            return best
        tree = self.trees.get(kind)
        if tree is None:
            return -1, 0
        asked, bags = set(), {}
        for cost, words in readings:
            typed = "".join(words)
            if typed in asked or len(typed) < 3:
                continue
            asked.add(typed)
            letters = "".join(sorted(typed))
            if letters not in bags:
                bags[letters] = self._near(kind, typed, 2)
            if not bags[letters]:
                continue
            known, radius = self.words.get(kind, set()).intersection(words), RADIUS_LONG if len(typed) >= LONG else RADIUS_SHORT
            found = [(cost, typed, self.by_key[kind, key]) for _, key in tree.within(typed, radius)]
            if len(words) > 3:
                ordered = "".join(sorted(words))
                found += [(cost + 3, ordered, self.by_order[kind, key]) for _, key in self.in_order[kind].within(ordered, radius)]
            for price, letters, (term_id, stored) in found:
                n = acceptable(letters, stored if letters == typed else sorted(stored))
                if n is not None and known.issubset(stored) and (best is None or (n * 100 + price, term_id) < best):
                    best = (n * 100 + price, term_id)
        return best or (-1, 0)


def canonical_terms(values: DataFrame, terms: DataFrame, abbreviated: Sequence[str] = (), shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """(kind, value, term_id): each distinct value with the reference entry it is a form of, or 0.

    values: kind, value. terms: term_id, kind, canonical. Equal values are looked up once. A value is a form
    of an entry if one of its readings (see forms) is within the allowed edits (see acceptable); of several
    entries the one with the fewest edits, then the plainest reading, then the smallest term_id wins. Null
    values and null kinds are left out; empty values and kinds without entries are unmatched. Abbreviations
    are written out for the kinds in `abbreviated`.

    The entries are counted first. Up to shard_entries of them go to every task; more are cut into shards by
    hash, each value asks every shard, and the winners of the shards are merged. Every shard knows the words of the
    whole list, which decide what is no misspelling, so the result does not depend on the shards.
    """
    asked = values.where("kind is not null and value is not null").select("kind", "value").distinct()
    entries = terms.where("term_id is not null and kind is not null and canonical is not null").select(F.col("term_id").cast("bigint").alias("term_id"), "kind", "canonical").distinct()
    n = entries.count()
    shards = -(-n // shard_entries)
    schema = "kind string, value string, rank bigint, term_id bigint"
    if shards <= 1:
        listed = [tuple(r) for r in entries.collect()]

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            matcher = Matcher(listed, abbreviated)
            for batch in batches:
                found = [matcher.find(k, v) for k, v in zip(batch["kind"], batch["value"])]
                yield batch.assign(rank=[f[0] for f in found], term_id=[f[1] for f in found])

        return spread(asked).mapInPandas(search, schema).select("kind", "value", "term_id")

    buckets = 64
    parts = entries.withColumn("shard", F.pmod(F.xxhash64("term_id"), F.lit(shards))).withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    questions = asked.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))))

    def own_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"kind": batch["kind"], "word": [_tokens(_plain(c)) for c in batch["canonical"]]}).explode("word").dropna().drop_duplicates()

    words: dict[str, set[str]] = {}
    for r in entries.select("kind", "canonical").mapInPandas(own_words, "kind string, word string").distinct().collect():  # words of the list, far fewer than its entries
        words.setdefault(r["kind"], set()).add(r["word"])

    def search_shard(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        matcher = Matcher(zip(t["term_id"], t["kind"], t["canonical"]), abbreviated, words)
        found = [matcher.find(k, v) for k, v in zip(q["kind"], q["value"])]
        return pd.DataFrame({"kind": q["kind"], "value": q["value"], "rank": [f[0] for f in found], "term_id": [f[1] for f in found]})

    won = questions.groupBy("shard", "bucket").cogroup(parts.groupBy("shard", "bucket")).applyInPandas(search_shard, schema)
    best = won.groupBy("kind", "value").agg(F.min(F.when(F.col("rank") >= 0, F.struct("rank", "term_id"))).alias("best"))
    return best.select("kind", "value", F.coalesce("best.term_id", F.lit(0)).alias("term_id"))
