"""Matching entities across two tables without a common key: BM25 retrieval over an inverted index, exact pruning,
mutual nearest neighbours, confidence by logistic calibration.

Records of either side are sets of terms from all their attributes: the words of their descriptions, their names and
their kind. Terms are hashed to TERMS columns. Words that the sources use for each other are learned from pairs that
are already tied. A term weighs the square of its BM25 weight (k1 = 0, so term frequency and length drop out).

The postings are partitioned by term: a record is sent to the buckets of its terms, a query only to those of its
leading terms, and a frequent term has buckets of its own, over which its records are spread. No row is copied per
block of the other side. Of a query's terms, rarest first, only a prefix is essential: a record that has fewer than
three terms of it lacks more weight than the threshold lets it lack. In the bucket of a term the triples that begin
with it are looked up among those of its records; queries without such a prefix, and records with very many terms,
meet by the posting list of one term. A pair is scored whole in the bucket of its first common term, and term by term
until it can no longer reach the threshold, so every pair is found. A bucket gets a record's terms from its own first
one on: what other buckets find of a pair is less, and the largest score counts.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarium.llm.lookalikes import CYRILLIC_AS_LATIN, GREEK_AS_LATIN
from glossarium.session import cut, sweep

#: Hashed words and kinds lie below NAMES, hashed names from there on.
TERMS = 1 << 23
NAMES = TERMS >> 1
#: A term that stands for any of several index terms is a term of its own in the search, from TERMS on.
_UNKNOWN = 1 << 25
#: A name weighs at most as much as a word that so large a share of the records has.
NAME_SHARE = 0.025
#: Postings of a bucket, and records of a term from which it has buckets of its own.
BUCKET_ROWS = 400_000
#: Share of a query's weight that a record has to match to be retrieved.
RETRIEVED = 0.6
_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
_ALIKE = str.maketrans(CYRILLIC_AS_LATIN | GREEK_AS_LATIN)
_LATIN = re.compile("[A-Za-z]")


def words_of(text: str) -> list[str]:
    """Distinct words in consistent characters and lower case, in order; hyphenated words are one."""
    if text.isascii():
        return list(dict.fromkeys(_WORD.findall(text.lower())))
    text = unicodedata.normalize("NFKC", text)
    for c in set(text):
        if c > "\x7f" and unicodedata.category(c) == "Cf":
            text = text.replace(c, "")
    words = [w.translate(_ALIKE) if not w.isascii() and _LATIN.search(w) else w for w in _WORD.findall(text)]
    return list(dict.fromkeys(w.lower() for w in words))


def term_of(word: str) -> int:
    return zlib.crc32(word.encode()) & (NAMES - 1)


#: Of each byte: its ASCII lower case, and whether it belongs to a word, as all beyond ASCII do in what words_of gives.
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
_INSIDE = np.array([c > 127 or chr(c).isalnum() for c in range(256)])


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _terms_of_bytes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """term_of of many words of lower case: the checksums of all of them together, byte by byte."""
    order = np.argsort(-size, kind="stable")
    crc, start = np.full(len(size), 0xFFFFFFFF, dtype=np.uint32), start[order]
    longer = len(size) - np.cumsum(np.bincount(size))  # words of more bytes
    for k, n in enumerate(longer[:-1].tolist()):
        crc[:n] = _CRC[(crc[:n] ^ data[start[:n] + k]) & 0xFF] ^ crc[:n] >> 8
    out = np.empty(len(size), dtype=np.int64)
    out[order] = ~crc & np.uint32(NAMES - 1)
    return out


def hashed_texts(texts: pa.Array) -> pa.ListArray:
    """The hashed words of each text, ascending; null gives none. The words of a batch are found and hashed as one run of
    bytes; only texts beyond ASCII go through words_of first, each by itself."""
    n = len(texts)
    texts = pc.fill_null(texts, "")
    other = pc.invert(pc.string_is_ascii(texts))
    texts = pc.replace_with_mask(texts, other, pa.array([" ".join(words_of(t)) for t in texts.filter(other).to_pylist()], texts.type))
    # A separator after each text: no word goes on into the next one.
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), texts), "\n")[0]
    data = _LOWER[np.frombuffer(joined.as_buffer(), dtype=np.uint8)]
    inside = np.concatenate([[False], _INSIDE[data], [False]])
    hyphen = np.flatnonzero(data == ord("-")) + 1
    inside[hyphen[inside[hyphen - 1] & inside[hyphen + 1]]] = True
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    key = _unique(np.searchsorted(ends, start, "right") << 32 | _terms_of_bytes(data, start, end - start))
    return _lists(key >> 32, key & 0xFFFFFFFF, n)


def terms_column(text: str) -> Column:
    """array<int>: the distinct hashed words of a text; null gives none."""

    def hashed(texts: pa.Array) -> pa.Array:
        return hashed_texts(texts)

    return F.arrow_udf(hashed, "array<int>")(text)


def kind_term(kind: str | Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("kind"), kind), F.lit(NAMES)).cast("int")


def name_term(name: str | Column) -> Column:
    """The term of a name that is already a bare key."""
    return (F.pmod(F.xxhash64(name), F.lit(NAMES)) + NAMES).cast("int")


def _unique(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting is faster here than hashing."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in an ascending table; looked up, as np.isin would sort the values."""
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values if len(table) else np.zeros(len(values), dtype=bool)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, dtype=np.int64)


def _range(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after another."""
    return np.repeat(start - _starts(sizes), sizes) + np.arange(sizes.sum())


def _sorted_table(keys: Iterable[int], values: Iterable[int]) -> tuple[np.ndarray, np.ndarray]:
    keys, values = np.fromiter(keys, dtype=np.int32), np.fromiter(values, dtype=np.int32)
    order = np.lexsort((values, keys))
    return keys[order], values[order]


class Vocabulary:
    """How many records have a term (1 if not named), and which terms of a query stand for which terms of the index.

    df: a mapping, or (ascending terms, their numbers) as arrays. Up to TERMS terms are held, at 13 bytes each.
    """

    def __init__(self, n_index: int, df: Mapping[int, int] | tuple[np.ndarray, np.ndarray], same: Mapping[int, int] | None = None, either: Mapping[int, tuple[int, ...]] | None = None) -> None:
        self.n_index, self.same, self.either = n_index, dict(same or {}), dict(either or {})
        self.groups = {t: tuple(sorted({self.canonical(t), *g})) for t, g in self.either.items()}
        self._same = _sorted_table(self.same.keys(), self.same.values())
        self._either = np.array(sorted(self.either), dtype=np.int32)
        self._members, self._grouped = _sorted_table((x for g in self.groups.values() for x in g), (t + TERMS for t, g in self.groups.items() for _ in g))
        terms, counts = _sorted_table(df.keys(), df.values()) if isinstance(df, Mapping) else (df[0].astype(np.int32), df[1].astype(np.int32))
        if not len(terms) or terms[0]:
            terms, counts = np.append(np.int32(0), terms), np.append(np.int32(1), counts)
        at = np.minimum(np.searchsorted(terms, self._members), len(terms) - 1)
        summed = np.zeros(len(self._either), dtype=np.int64)
        np.add.at(summed, np.searchsorted(self._either, self._grouped - TERMS), np.where(terms[at] == self._members, counts[at], 1))
        ceiling = max(1, n_index)
        counts = np.clip(np.concatenate([counts, np.minimum(summed, ceiling).astype(np.int32)]), 1, ceiling)
        #: Ranks: codes from 0 on, rarest first; a term that is not named has the code term - _UNKNOWN and is rarer than all.
        self.terms = np.concatenate([terms, self._either + np.int32(TERMS)])
        order = np.argsort(counts, kind="stable")
        self.rank = np.empty(len(order), dtype=np.int32)
        self.rank[order] = np.arange(len(order), dtype=np.int32)
        self.ranked_df = counts[order]
        self.ranked_name = ((self.terms >= NAMES) & (self.terms < TERMS))[order]
        self.rare = [float(self._weights(np.array([1]), np.array([b]))[0]) for b in (False, True)]

    def _weights(self, df: np.ndarray, name: np.ndarray) -> np.ndarray:
        df = np.where(name, np.maximum(df, NAME_SHARE * self.n_index), df)
        return np.log1p((self.n_index - df + 0.5) / (df + 0.5)) ** 2

    def df_of(self, term: int) -> int:
        """How many records have a term."""
        code = self.codes(np.array([term]))
        return int(self.postings(code)[0])

    def canonical(self, term: int) -> int:
        return self.same.get(term, term)

    def canonical_array(self, terms: np.ndarray) -> np.ndarray:
        keys, values = self._same
        if not len(keys):
            return terms
        at = np.minimum(np.searchsorted(keys, terms), len(keys) - 1)
        return np.where(keys[at] == terms, values[at], terms)

    def codes(self, terms: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, self.rank[at], terms - _UNKNOWN).astype(np.int64)

    def postings(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones(len(codes))
        out[codes >= 0] = self.ranked_df[codes[codes >= 0]]
        return out

    def is_name(self, codes: np.ndarray) -> np.ndarray:
        term = codes + _UNKNOWN
        out = (codes < 0) & (term >= NAMES) & (term < TERMS)
        out[codes >= 0] = self.ranked_name[codes[codes >= 0]]
        return out

    def weight(self, codes: np.ndarray, name: np.ndarray) -> np.ndarray:
        out = np.where(name, self.rare[1], self.rare[0])
        known = codes >= 0
        out[known] = self._weights(self.ranked_df[codes[known]], name[known])
        return out

    def record_codes(self, terms: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owners, codes) of records, rarest first; terms that a query term may stand for are added under its own name."""
        terms = self.canonical_array(terms)
        low = np.searchsorted(self._members, terms, "left")
        n = np.searchsorted(self._members, terms, "right") - low
        return self._sorted(np.concatenate([owner, np.repeat(owner, n)]), np.concatenate([terms, self._grouped[_range(low, n)]]))

    def query_codes(self, terms: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._sorted(owner, np.where(_among(terms, self._either), terms + TERMS, self.canonical_array(terms)))

    def _sorted(self, owner: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = _unique(owner << 32 | (self.codes(terms) + _UNKNOWN))
        return key >> 32, (key & 0xFFFFFFFF) - _UNKNOWN


#: Records with more terms than this meet queries by single terms, as they would have too many triples.
TRIPLE_TERMS = 24
#: Queries go through posting lists if so few records have a term of their shorter prefix.
LIST_ROWS = 1000
_AT_ONCE = 2_000_000
_EPS = 1e-9


class Asked:
    """Queries as flat arrays of codes with what bounds them.

    A record has at most one of a query's names, so the names count once, by the heaviest. `rest` is what the terms after
    a place can add at most. A query's prefix ends where the rest and the two heaviest terms together fall below its
    need: a record has to have three terms of the prefix. Where no place is such, or few records have a term of it, one term has
    to be in the prefix that ends where the rest alone falls below the need.
    """

    def __init__(self, owner: np.ndarray, codes: np.ndarray, n: int, vocabulary: Vocabulary, share: float) -> None:
        self.n, self.owner, self.codes = n, owner, codes
        name = vocabulary.is_name(codes)
        self.weight = vocabulary.weight(codes, name)
        own = np.where(name, 0.0, self.weight)
        self.sizes = np.bincount(owner, minlength=n)
        self.start = _starts(self.sizes)
        called, words = np.zeros(n), np.bincount(owner, weights=own, minlength=n)
        np.maximum.at(called, owner[name], self.weight[name])
        self.total = words + called
        self.need = self.total * share - _EPS
        running = np.cumsum(own)
        before = np.where(self.start > 0, running[np.maximum(self.start - 1, 0)] if len(running) else 0.0, 0.0)
        upto = running - before[owner]
        later = np.cumsum(name[::-1])[::-1] - name  # names at later places, of this and later queries
        last = self.start + self.sizes - 1
        self.rest = np.maximum(words[owner] - upto, 0) + np.where(later - later[np.maximum(last, 0)][owner] > 0, called[owner], 0.0) if len(codes) else own
        place = np.arange(len(owner)) - self.start[owner]
        first, second = np.zeros(n), np.zeros(n)
        np.maximum.at(first, owner, own)
        under = np.flatnonzero(~name)
        words_seen = np.bincount(owner[under], minlength=n)
        position = np.arange(len(under)) - _starts(words_seen)[owner[under]]
        second[owner[under][position == 1]] = self.weight[under][position == 1]
        head = first + np.maximum(second, called)
        self.prefix = np.full(n, 1 << 30)
        three = (self.rest + head[owner] < self.need[owner]) & (place >= 2)
        np.minimum.at(self.prefix, owner[three], place[three] + 1)
        single = np.full(n, 0)
        np.maximum.at(single, owner, np.where(self.rest < self.need[owner], 0, place + 1))
        posted = np.bincount(owner, weights=np.where(place <= single[owner], vocabulary.postings(codes), 0), minlength=n)
        self.deep = (self.prefix <= TRIPLE_TERMS) & (posted > LIST_ROWS)
        self.prefix = np.where(self.deep, self.prefix, np.minimum(single + 1, self.sizes))
        self.lead = np.where(self.deep, self.prefix - 2, self.prefix)
        self.least = np.where(called >= self.need, 1, 1 << 30)  # terms that a record has to have
        for extra, most in ((1, upto[under]), (2, upto[under] + called[owner[under]])):
            enough = most >= self.need[owner[under]]
            np.minimum.at(self.least, owner[under][enough], position[enough] + extra)


def _mix(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """One number for three codes in ascending order; equal numbers of different triples only cost a check."""
    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + c.astype(np.uint64)
        return (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def _sketches(owner: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """64 bits for each set of codes: two sets have at most as many codes in common as one of them has that hit bits of both."""
    out = np.zeros(n, dtype=np.uint64)
    np.bitwise_or.at(out, owner, np.uint64(1) << ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)))
    return out


class Buckets:
    """Which buckets a term has: one of the common ones, or, if many records have it, some of its own."""

    def __init__(self, vocabulary: Vocabulary, common: int, rows: int = BUCKET_ROWS) -> None:
        self.common = common
        hot = np.flatnonzero(vocabulary.ranked_df > rows)
        self.hot, self.salts = hot, -(-vocabulary.ranked_df[hot].astype(np.int64) // rows)
        self.first = common + _starts(self.salts)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first bucket, number of buckets)"""
        if not len(self.hot):
            return np.mod(codes, self.common), np.ones(len(codes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hot, codes), len(self.hot) - 1)
        is_hot = self.hot[at] == codes
        return np.where(is_hot, self.first[at], np.mod(codes, self.common)), np.where(is_hot, self.salts[at], 1)

    def inside(self, codes: np.ndarray, bucket: int) -> np.ndarray:
        first, n = self.of(codes)
        return (first <= bucket) & (bucket < first + n)


def search_bucket(records: tuple[np.ndarray, np.ndarray, int], asked: Asked, inside: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(record, query, score) of the pairs that reach the query's need and whose first term in common here is the bucket's.

    records: (owners, codes, number); inside: which of their codes are the bucket's; leads: which of the queries' codes
    are the bucket's, within the leading places.
    """
    owner, codes, n = records
    held = owner << 32 | (codes + _UNKNOWN)
    sketch, query_sketch = _sketches(owner, codes, n), _sketches(asked.owner, asked.codes, asked.n)
    at_least = asked.least - (asked.sizes - np.bitwise_count(query_sketch))  # terms that share a bit may hide each other
    place = np.arange(len(asked.owner)) - asked.start[asked.owner]
    within = place < asked.prefix[asked.owner]
    keyed = _among(codes, _unique(asked.codes[within & asked.deep[asked.owner]]))
    count = np.bincount(owner[keyed], minlength=n)
    many = count > TRIPLE_TERMS
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def judged(record: np.ndarray, query: np.ndarray) -> None:
        pair = _unique(record * asked.n + query)
        record, query = pair // asked.n, pair % asked.n
        fits = np.bitwise_count(sketch[record] & query_sketch[query]) >= at_least[query]
        out.append(_score(asked, held, leads, record[fits], query[fits]))

    def joined(have: np.ndarray, of: np.ndarray, key: np.ndarray, by: np.ndarray) -> None:
        """Pairs of equal keys; `have` is sorted."""
        low = np.searchsorted(have, key, "left")
        sizes = np.searchsorted(have, key, "right") - low
        hit = np.flatnonzero(sizes)
        low, sizes, by = low[hit], sizes[hit], by[hit]
        a, total = 0, np.cumsum(sizes)
        while a < len(sizes):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + _AT_ONCE, "right")))
            for c in range(0, int(sizes[a]) if b == a + 1 else 1, _AT_ONCE):  # a single key may have more
                m = np.minimum(sizes[a:b] - c, _AT_ONCE) if b == a + 1 else sizes[a:b]
                judged(of[_range(low[a:b] + c, m)], np.repeat(by[a:b], m))
            a = b

    def by_lists(chosen: np.ndarray, queries: np.ndarray) -> None:
        """Records and queries that meet by one term."""
        at, wanted = np.flatnonzero(chosen & inside), np.flatnonzero(leads & queries[asked.owner])
        if len(at) and len(wanted):
            order = at[np.argsort(codes[at], kind="stable")]
            wanted = wanted[np.argsort(asked.codes[wanted], kind="stable")]
            joined(codes[order], owner[order], asked.codes[wanted], asked.owner[wanted])

    by_lists(np.ones(len(codes), dtype=bool), ~asked.deep)
    if many.any():
        by_lists(many[owner], asked.deep)
    have, of = _triples(owner[keyed & ~many[owner]], codes[keyed & ~many[owner]], inside[keyed & ~many[owner]], n)
    deep = within & asked.deep[asked.owner]
    key, by = _triples(asked.owner[deep], asked.codes[deep], leads[deep], asked.n)
    if len(key) and len(have):
        seen = np.zeros(1 << 22, dtype=bool)
        seen[key >> np.uint64(42)] = True
        kept = np.flatnonzero(seen[have >> np.uint64(42)])
        kept, order = kept[np.argsort(have[kept])], np.argsort(key)
        joined(have[kept], of[kept], key[order], by[order])
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    r, q, s = (np.concatenate(x) for x in zip(*out))
    first = np.unique(q * max(n, 1) + r, return_index=True)[1]
    return r[first], q[first], s[first]


def _triples(owner: np.ndarray, codes: np.ndarray, leading: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(triples of ascending codes that begin with a leading one, their owners)."""
    sizes = np.bincount(owner, minlength=n)
    start = _starts(sizes)
    keys, owners = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for k in np.unique(sizes[sizes >= 3]).tolist():
        rows = np.flatnonzero(sizes == k)
        at = start[rows][:, None] + np.arange(k)
        matrix, lead = codes[at], leading[at]
        for i in range(k - 2):
            chosen = np.flatnonzero(lead[:, i])
            if len(chosen):
                j, l = np.array(list(combinations(range(i + 1, k), 2))).T  # noqa: E741
                m = matrix[chosen]
                found = _mix(np.repeat(m[:, i : i + 1], len(j), axis=1), m[:, j], m[:, l])
                keys.append(found.ravel())
                owners.append(np.repeat(rows[chosen], found.shape[1]))
    return np.concatenate(keys), np.concatenate(owners)


def _score(asked: Asked, held: np.ndarray, leads: np.ndarray, record: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that reach the need, term by term as long as they still can; the first common term has to lead here."""
    score, fresh = np.zeros(len(record)), np.ones(len(record), dtype=bool)
    done = 0
    while len(record):
        more = done < asked.sizes[query]
        if not more.any():
            break
        at = np.where(more, asked.start[query] + done, 0)
        key = record << 32 | (asked.codes[at] + _UNKNOWN)
        found = (held[np.minimum(np.searchsorted(held, key), len(held) - 1)] == key) & more
        score += np.where(found, asked.weight[at], 0.0)
        keep = np.where(more, score + asked.rest[at], score) >= asked.need[query]
        keep &= ~(found & fresh) | leads[at]
        fresh &= ~found
        if not keep.all():
            record, query, score, fresh = record[keep], query[keep], score[keep], fresh[keep]
        done += 1
    return record, query, score / np.maximum(asked.total[query], 1e-12)


def _counted(parts: list[np.ndarray]) -> pa.RecordBatch:
    terms = np.sort(np.concatenate(parts))
    edges = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    return pa.RecordBatch.from_pydict({"term": terms[edges].astype(np.int32), "n": np.diff(np.append(edges, len(terms)))})


def term_counts(records: DataFrame, at_least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(terms that so many records have, how many have each, how many records there are); at most TERMS terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy(zero_copy_only=False))
            size += len(held[-1])
            if size > _AT_ONCE:
                yield _counted(held)
                held, size = [], 0
        if size:
            yield _counted(held)

    counted = records.select(F.concat("terms", F.array(F.lit(-1))).alias("terms")).mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).where((F.col("n") >= at_least) | (F.col("term") < 0))
    found = counted.select("term", F.col("n").cast("int").alias("n")).toArrow()
    terms, n = found["term"].to_numpy(), found["n"].to_numpy()
    return terms[terms >= 0], n[terms >= 0], int(n[terms < 0].sum())


#: Tied pairs, times terms, whose term pairs a worker counts at once.
_PAIRS_AT_ONCE = 4_000_000
#: Tied pairs whose terms are packed into one row.
_PACKED_ROWS = 2000


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b) of terms those that only one side has, where b has some. Many rows become one of four lists, as
    writing and reading a row costs more than its terms: the terms of each side and how many each row has."""
    for batch in (b.slice(i, _PACKED_ROWS) for b in batches for i in range(0, b.num_rows, _PACKED_ROWS)):
        a, b = (_unique(owner << 32 | terms) for owner, terms in (_flat(batch.column(c)) for c in (0, 1)))
        x, y = a[~_among(a, b)], b[~_among(b, a)]
        sizes = [np.bincount(side >> 32, minlength=batch.num_rows) for side in (x, y)]
        kept = sizes[1] > 0
        values = [x[kept[x >> 32]] & 0xFFFFFFFF, sizes[0][kept], y & 0xFFFFFFFF, sizes[1][kept]]
        yield pa.RecordBatch.from_arrays([_lists(np.zeros(len(v), dtype=np.int64), v, 1) for v in values], ["x", "xs", "y", "ys"])


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]]:
    """(number of rows, (owners, terms) of x, the same of y) of what _differences wrote."""
    for batch in batches:
        for i in range(batch.num_rows):
            x, xs, y, ys = (_flat(c.slice(i, 1))[1] for c in batch.columns)
            yield len(ys), (np.repeat(np.arange(len(xs)), xs), x), (np.repeat(np.arange(len(ys)), ys), y)


def _by_term(terms: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The number of each term, 0 if it is not named."""
    table = np.zeros(NAMES, dtype=n.dtype)
    table[terms] = n
    return table


def word_pairs(alone: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(y, x, share) as arrays: the index terms x that at least 0.25 of the pairs that have y in the query alone have in
    the record alone, six times as often as x is among such pairs in general, in three pairs or more.

    alone: what _differences gives, of terms below NAMES. Every pair counts. The driver gets two tables over terms and what is
    found, at most four times as many rows as a record has terms for each y.
    """
    counts = alone.select(F.explode("y").alias("t"), F.lit(1).alias("y"), F.lit(0).alias("x")).unionByName(alone.select(F.explode("x").alias("t"), F.lit(0).alias("y"), F.lit(1).alias("x")))
    counts = counts.groupBy("t").agg(F.sum("y").cast("int").alias("y"), F.sum("x").cast("int").alias("x")).where("y >= 3 or x >= 3").toArrow()
    often = [(counts["t"].to_numpy()[n >= 3], n[n >= 3]) for n in (counts[c].to_numpy() for c in ("y", "x"))]
    seen, total = _by_term(*often[0]), max(1, int(often[0][1].sum(dtype=np.int64)))
    # Each executor writes a broadcast to its disk, so workers get the terms there are and lay out the tables themselves.
    tables = alone.sparkSession.sparkContext.broadcast(often)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each y, with those x that are frequent enough for it."""
        seen, held = (_by_term(*t) for t in tables.value)
        for rows, (owner_x, x), (owner_y, y) in _sides(batches):
            keep_x, keep_y = held[x] > 0, seen[y] > 0
            (owner_x, x), (owner_y, y) = (owner_x[keep_x], x[keep_x]), (owner_y[keep_y], y[keep_y])
            sizes = np.bincount(owner_x, minlength=rows)
            start, n = _starts(sizes), sizes[owner_y]
            by, x = np.repeat(np.arange(len(y)), n), x[_range(start[owner_y], n)]
            fits = held[x] >= 0.25 * seen[y[by]]
            by, x = by[fits], x[fits]
            used = _unique(by)
            yield pa.RecordBatch.from_arrays([pa.array(y[used].astype(np.int32)), _lists(np.searchsorted(used, by), x, len(used))], ["y", "x"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of y; what a y has so far is kept until the next y."""
        seen = _by_term(*tables.value[0])
        keys, n, waiting, size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new = np.concatenate(waiting) if waiting else np.zeros(0, dtype=np.int64)
            both = np.concatenate([keys, new])
            order = np.argsort(both, kind="stable")
            both, weights = both[order], np.concatenate([n, np.ones(len(new), dtype=np.int64)])[order]
            edges = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, dtype=np.int64)
            return both[edges], np.add.reduceat(weights, edges) if len(edges) else weights

        def found(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            y = keys >> 32
            kept = (n >= 3) & (n >= 0.25 * seen[y])
            return pa.RecordBatch.from_arrays([pa.array(y[kept].astype(np.int32)), pa.array((keys[kept] & 0xFFFFFFFF).astype(np.int32)), pa.array(n[kept].astype(np.int32))], ["y", "x", "n"])

        for batch in batches:
            owner, x = _flat(batch.column(1))
            waiting.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[owner] << 32 | x)
            size += len(x)
            if size > _PAIRS_AT_ONCE:
                keys, n = merged()
                last = keys >> 32 == keys[-1] >> 32
                yield found(keys[~last], n[~last])
                keys, n, waiting, size = keys[last], n[last], [], 0
        yield found(*merged())

    got = alone.mapInArrow(split, "y int, x array<int>").repartition("y").sortWithinPartitions("y").mapInArrow(count, "y int, x int, n int").toArrow()
    chosen = alone.sparkSession.sparkContext.broadcast(_unique(got["x"].to_numpy()))

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each x that was found, the pairs of it and a y."""
        seen = _by_term(*tables.value[0])
        for rows, (owner_x, x), (owner_y, y) in _sides(batches):
            wanted = _among(x, chosen.value)
            terms, at = np.unique(x[wanted], return_inverse=True)
            n = np.bincount(owner_y[seen[y] > 0], minlength=rows)[owner_x[wanted]]
            yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int32)), pa.array(np.bincount(at, weights=n, minlength=len(terms)).astype(np.int64))], ["x", "n"])

    general = alone.mapInArrow(beside, "x int, n bigint").groupBy("x").agg(F.sum("n").alias("n")).toArrow()
    tables.destroy()
    chosen.destroy()
    base = _by_term(general["x"].to_numpy(), general["n"].to_numpy())
    y, x = got["y"].to_numpy(), got["x"].to_numpy()
    share = got["n"].to_numpy() / np.maximum(seen[y], 1)
    kept = share >= 6 * base[x] / total
    return y[kept], x[kept], share[kept]


def learn_vocabulary(sets: DataFrame, index: DataFrame, queries: DataFrame, tied: DataFrame) -> Vocabulary:
    """Weights from the distinct term sets of both sides; word pairs from all tied pairs (index_id, query_id).

    No term is left out: a frequent one weighs less. Its frequency is the larger of its shares of the two sides, so that
    a word that only one source keeps using weighs little too. Copies of a text count once. The weight is the BM25 weight
    of the record's term times that of the query's, or its square; with it alone the frequent words, in which the sources
    differ most, would bring true pairs below RETRIEVED.

    A query term that the tied index record lacks is taken to stand for the index term that at least 0.6 of those
    records have and it has not, in three pairs or more; where several terms have at least 0.25, for any of them.
    """
    terms, n, n_index = term_counts(sets, 2)
    query_terms, query_n, n_asked = term_counts(queries.select("terms").distinct(), 2)
    df = np.zeros(TERMS, dtype=np.int32)
    df[terms] = n
    words = F.array_except(F.filter("terms", lambda t: t < NAMES), F.array(F.coalesce("kind", F.lit(-1))))
    side = lambda df, c, n: df.select(F.col("id").alias(c), words.alias(n))
    both = tied.join(side(index, "index_id", "a"), "index_id").join(side(queries, "query_id", "b"), "query_id")
    alone = cut(both.select("a", "b").mapInArrow(_differences, "x array<int>, xs array<int>, y array<int>, ys array<int>"))
    options: dict[int, list[tuple[float, int]]] = defaultdict(list)
    for y, x, share in zip(*(c.tolist() for c in word_pairs(alone))):
        options[y].append((share, x))
    same: dict[int, int] = {}
    either: dict[int, tuple[int, ...]] = {}
    for y, found in options.items():
        share, x = max(found, key=lambda f: (f[0], -f[1]))
        if len(found) == 1 and share >= 0.6 and df[y] <= 0.2 * df[x]:
            same[y] = x
        else:
            either[y] = tuple(sorted(x for _, x in found))
    same = {y: x for y, x in same.items() if x not in same}
    df[query_terms] = np.maximum(df[query_terms], np.rint(query_n.astype(np.int64) * n_index / max(1, n_asked)).astype(np.int32))
    known = np.flatnonzero(df >= 2)
    return Vocabulary(n_index, (known, df[known]), same, either)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(owners, values) of a column of lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(sizes), dtype=np.int64), sizes), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=n))).astype(np.int32)), pa.array(values.astype(np.int32)))


_SHORT = 1 << 16
#: How queries use a term: at all, as a leading term of a query that asks for one or for three, within a prefix of three.
_NAMED, _ALONE, _FIRST, _KEYED = 1, 2, 4, 8
_CODES = "rare array<int>, often array<smallint>"


def _packed(owner: np.ndarray, codes: np.ndarray, n: int, known: int) -> list[pa.ListArray]:
    """Two columns for the codes of n rows: the most frequent terms, most of a text, take two bytes each."""
    short = codes >= known - _SHORT
    often = (known - 1 - codes[short] - (_SHORT >> 1)).astype(np.int16)
    ends = np.append(0, np.cumsum(np.bincount(owner[short], minlength=n))).astype(np.int32)
    return [_lists(owner[~short], codes[~short], n), pa.ListArray.from_arrays(pa.array(ends), pa.array(often))]


def _unpacked(rare: pa.Array, often: pa.Array, known: int) -> tuple[np.ndarray, np.ndarray]:
    """(owners, codes), rarest first, of what _packed wrote."""
    (a, codes), (b, short) = _flat(rare), _flat(often)
    n = len(rare)
    first, second = np.bincount(a, minlength=n), np.bincount(b, minlength=n)
    start = _starts(first + second)
    out = np.empty(len(codes) + len(short), dtype=np.int64)
    out[_range(start, first)], out[_range(start + first, second)] = codes, known - 1 - (short + (_SHORT >> 1))
    return np.repeat(np.arange(n, dtype=np.int64), first + second), out


def retrieve(index: DataFrame, queries: DataFrame, vocabulary: Vocabulary, share: float = RETRIEVED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(index_id, query_id, score): every pair in which the index record matches at least `share` of the query's weight.

    index: id bigint, terms; queries: id string, terms. Records without terms match nothing. A record of t terms is sent
    to at most t buckets, whatever the size of the other side; a query also to each of the buckets of a leading term that
    more than bucket_rows records have.
    """
    spark, known = index.sparkSession, len(vocabulary.terms)
    fields = spark.sparkContext.broadcast(vars(vocabulary))  # sent once, not with each function; a broadcast goes without its class

    def held() -> Vocabulary:
        vocabulary = Vocabulary.__new__(Vocabulary)
        vocabulary.__dict__ = fields.value
        return vocabulary

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held()
        for batch in batches:
            owner, terms = _flat(batch.column(1))
            asked = Asked(*vocabulary.query_codes(terms, owner), batch.num_rows, vocabulary, share)
            yield pa.RecordBatch.from_arrays([batch.column(0), *_packed(asked.owner, asked.codes, batch.num_rows, known), pa.array(asked.lead.astype(np.int32)), pa.array(np.where(asked.deep, asked.prefix, 0).astype(np.int32))], ["id", "rare", "often", "lead", "prefix"])

    asked = cut(queries.where("size(terms) > 0").select("id", "terms").mapInArrow(ask, f"id string, {_CODES}, lead int, prefix int"))
    # Frequent terms that no query has are left out of the records, and those that lead none have no bucket. Where one
    # leads only queries that ask for three terms, a record needs two more after it that are in such a prefix.
    often = int(np.searchsorted(vocabulary.ranked_df, vocabulary.n_index // 1000 + 1))

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The frequent terms of queries, with a bit for each use."""
        bits = np.zeros(known - often, dtype=np.uint8)
        for batch in batches:
            owner, codes = _unpacked(batch.column(0), batch.column(1), known)
            place = np.arange(len(owner)) - _starts(np.bincount(owner, minlength=batch.num_rows))[owner]
            seen = codes >= often
            owner, codes, place = owner[seen], codes[seen] - often, place[seen]
            lead, prefix = (batch.column(c).to_numpy(zero_copy_only=False)[owner] for c in (2, 3))
            for bit, of in ((_NAMED, place >= 0), (_ALONE, (place < lead) & (prefix == 0)), (_FIRST, (place < lead) & (prefix > 0)), (_KEYED, place < prefix)):
                bits[codes[of]] |= bit
        code = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array((code + often).astype(np.int32)), pa.array(bits[code].astype(np.int32))], ["code", "bits"])

    met = asked.select("rare", "often", "lead", "prefix").mapInArrow(used, "code int, bits int").groupBy("code").agg(F.bit_or("bits").alias("bits")).toArrow()
    uses = np.zeros(known - often, dtype=np.uint8)
    uses[met["code"].to_numpy() - often] = met["bits"].to_numpy()
    total_rows = int(vocabulary.ranked_df.sum(dtype=np.int64))
    common = int(max(spark.sparkContext.defaultParallelism * 2, -(-total_rows // bucket_rows)))
    buckets = Buckets(vocabulary, common, bucket_rows)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            owner, terms = _flat(batch.column(1))
            owner, codes = held().record_codes(terms, owner)
            bits = np.full(len(codes), 255, dtype=np.uint8)
            bits[codes >= often] = uses[codes[codes >= often] - often]
            named = bits > 0
            owner, codes, bits = owner[named], codes[named], bits[named]
            is_keyed = bits & _KEYED > 0
            keyed = np.cumsum(is_keyed[::-1])[::-1]
            ends = np.cumsum(np.bincount(owner, minlength=len(ids)))
            later = keyed - is_keyed - np.append(keyed, 0)[ends[owner]]
            goes = (bits & _ALONE > 0) | ((bits & _FIRST > 0) & (later >= 2))
            first, n = buckets.of(codes[goes])
            salt = np.mod(ids.astype(np.uint64)[owner[goes]] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33), n.astype(np.uint64)).astype(np.int64)
            # Terms before the bucket's first one are left out: what has one of them in common is found whole elsewhere.
            sent, place = np.unique(owner[goes] << 32 | (first + salt), return_index=True)
            rows, begin = sent >> 32, np.flatnonzero(goes)[place]
            sizes = np.cumsum(np.bincount(owner, minlength=len(ids)))[rows] - begin
            yield pa.RecordBatch.from_arrays([pa.array((sent & 0xFFFFFFFF).astype(np.int32)), pa.array(ids[rows]), *_packed(np.repeat(np.arange(len(rows)), sizes), codes[_range(begin, sizes)], len(rows), known)], ["bucket", "id", "rare", "often"])

    def send_query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, codes = _unpacked(batch.column(1), batch.column(2), known)
            place = np.arange(len(owner)) - _starts(np.bincount(owner, minlength=batch.num_rows))[owner]
            leads = place < batch.column(3).to_numpy(zero_copy_only=False)[owner]
            first, n = buckets.of(codes[leads])
            sent = _unique(np.repeat(owner[leads], n) << 32 | _range(first, n))
            rows = pa.array(sent >> 32)
            yield pa.RecordBatch.from_arrays([pa.array((sent & 0xFFFFFFFF).astype(np.int32)), *[batch.column(c).take(rows) for c in range(3)]], ["bucket", "id", "rare", "often"])

    def match(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        none = pa.table({"index_id": pa.array([], pa.int64()), "query_id": pa.array([], pa.string()), "score": pa.array([], pa.float64())})
        if not a.num_rows or not b.num_rows:
            return none
        bucket = key[0].as_py()
        owner, codes = _unpacked(a["rare"], a["often"], known)
        asked = Asked(*_unpacked(b["rare"], b["often"], known), b.num_rows, held(), share)
        place = np.arange(len(asked.owner)) - asked.start[asked.owner]
        leads = buckets.inside(asked.codes, bucket) & (place < asked.lead[asked.owner])
        r, q, s = search_bucket((owner, codes, a.num_rows), asked, buckets.inside(codes, bucket), leads)
        return pa.table({"index_id": a["id"].combine_chunks().take(pa.array(r)), "query_id": b["id"].combine_chunks().take(pa.array(q)), "score": s})

    parts = max(spark.sparkContext.defaultParallelism, common // 2)
    left = index.where("size(terms) > 0").select("id", "terms").mapInArrow(send, f"bucket int, id bigint, {_CODES}").repartition(parts, "bucket")
    right = asked.mapInArrow(send_query, f"bucket int, id string, {_CODES}").repartition(parts, "bucket")
    found = left.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(match, "index_id bigint, query_id string, score double")
    return found.groupBy("index_id", "query_id").agg(F.max("score").alias("score"))


FEATURES = ("score", "gap_query", "gap_index", "same_name", "same_kind")


def with_gaps(found: DataFrame) -> DataFrame:
    """found (set, query_id, score) with how far each pair is behind the best pair of its query and of its set. The best
    scores are aggregated before they are joined, so a record with very many pairs is never held in one place."""
    out = found
    for c, name in (("query_id", "gap_query"), ("set", "gap_index")):
        best = found.groupBy(c).agg(F.max("score").alias("__best"))
        out = out.join(best, c).withColumn(name, F.col("__best") - F.col("score")).drop("__best")
    return out


def calibrate(examples: DataFrame) -> np.ndarray:
    """Coefficients of a logistic model over FEATURES and a constant, from all labelled candidates: Newton's method, each
    step of which adds up gradient and Hessian over the workers."""
    k = len(FEATURES) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.ascontiguousarray(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).T)
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(rows.tobytes(), 1)])], ["rows"])

    packed = cut(examples.select(*[F.col(c).cast("double") for c in (*FEATURES, "label")]).mapInArrow(pack, "rows binary"))

    def sums(beta: np.ndarray) -> np.ndarray:
        """Gradient, Hessian, number of rows and number of true ones."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(k + k * k + 2)
            for blob in (x for batch in batches for x in batch.column(0).to_pylist()):
                rows = np.frombuffer(zlib.decompress(blob)).reshape(k, -1).T
                x, y = np.c_[rows[:, :-1], np.ones(len(rows))], rows[:, -1]
                p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
                total += np.concatenate([x.T @ (y - p), (x.T @ (x * (p * (1 - p))[:, None])).ravel(), [len(y), y.sum()]])
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["sums"])

        return sum((np.array(r["sums"]) for r in packed.mapInArrow(add, "sums array<double>").collect()), np.zeros(k + k * k + 2))

    prior = np.array([20.0, -10.0, -10.0, 1.0, 0.5, -16.0])  # where nothing is tied yet
    beta = prior.copy()
    for _ in range(30):
        total = sums(beta)
        n, true = total[-2:]
        if n < 50 or true in (0, n):
            return prior
        ridge = 1e-3 * n
        step = np.linalg.solve(total[k:-2].reshape(k, k) + ridge * np.eye(k) * 0.01, total[:k] - ridge * 0.01 * (beta - prior))
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def confidence(beta: np.ndarray) -> Column:
    z = sum((F.col(f).cast("double") * float(b) for f, b in zip(FEATURES, beta)), F.lit(float(beta[-1])))
    return 1 / (1 + F.exp(-z))


def matched(index: DataFrame, queries: DataFrame, tied: DataFrame, accept: float = 0.5, near: float = 0.2, share: float = RETRIEVED) -> DataFrame:
    """(index_id, query_id, score, confidence) of the pairs that describe the same thing and are not tied yet.

    index: id bigint, terms, name string (its name as a bare key), kind string; queries: id string, terms, names
    array<string>, kind string; tied: index_id, query_id. A pair is taken if it is (nearly) nearest from both sides,
    within `near` of the best score of either, and its confidence is at least `accept`. Records of equal score are
    all taken. Ids that come several times count once; null ids and records without words match nothing.
    """
    none = F.array().cast("array<int>")
    listed = lambda c: F.when(F.col(c).isNotNull(), F.array(c)).otherwise(none)
    whole = lambda df, names: df.withColumn("terms", F.array_sort(F.array_distinct(F.concat("terms", names, listed("kind")))))
    described_rows = lambda df: df.where("id is not null and size(terms) > 0").withColumn("kind", F.when(F.col("kind").isNotNull(), kind_term("kind")))
    called = F.coalesce(F.transform(F.filter("names", lambda x: x.isNotNull() & (x != "")), name_term), none)
    # Records of equal terms are one record of the search: however many copies there are, they are scored once. That two
    # sets share a hash is unlikely below a billion sets, and would only make a candidate of one pair too many.
    index = described_rows(index).withColumn("name", F.when(F.col("name") != "", name_term("name")))
    index = cut(whole(index, listed("name")).withColumn("set", F.xxhash64("terms")).select("id", "terms", "name", "kind", "set"))
    queries = cut(whole(described_rows(queries).withColumn("names", called), F.col("names")).select("id", "terms", "names", "kind"))
    sets = cut(index.select(F.col("set").alias("id"), "terms").dropDuplicates(["id"]))
    tied = cut(tied.where("index_id is not null and query_id is not null").distinct())
    vocabulary = learn_vocabulary(sets, index, queries, tied)
    # From here on the sets have the terms of the index: while the buckets are on disk, they are not kept twice.
    index = cut(index.drop("terms"))
    sweep(index.sparkSession)
    found = cut(retrieve(sets, queries.select("id", "terms"), vocabulary, share).withColumnRenamed("index_id", "set"))
    sweep(index.sparkSession)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    described = (
        with_gaps(found).join(index.select("set", F.col("id").alias("index_id"), "name", F.col("kind").alias("index_kind")), "set")
        .join(queries.select(F.col("id").alias("query_id"), "names", F.col("kind").alias("query_kind")), "query_id")
        .select(
            "index_id",
            "query_id",
            "score",
            "gap_query",
            "gap_index",
            F.col("name").alias("name_key"),
            flag(F.array_contains("names", F.col("name"))).alias("same_name"),
            flag(F.col("index_kind") == F.col("query_kind")).alias("same_kind"),
        )
        .groupBy("query_id", "index_id")
        .agg(*[F.max(c).alias(c) for c in ("score", "name_key", "same_name", "same_kind")], *[F.min(c).alias(c) for c in ("gap_query", "gap_index")])
    )
    marks = tied.withColumn("label", F.lit(1))
    # Of a query with tied records, records of another name are no matches; of the same name they may be copies.
    judged = cut(described.join(marks, ["index_id", "query_id"], "left").withColumn("label", F.coalesce("label", F.lit(0))))
    tied_names = judged.where("label = 1").groupBy("query_id").agg(F.collect_set("name_key").alias("tied_names"))
    known = judged.join(tied_names, "query_id").where(F.col("label").cast("boolean") | ~F.coalesce(F.array_contains("tied_names", F.col("name_key")), F.lit(True)))
    beta = calibrate(known)
    return (
        judged.withColumn("confidence", confidence(beta))
        .where((F.col("label") == 0) & (F.col("gap_query") <= near) & (F.col("gap_index") <= near) & (F.col("confidence") >= accept))
        .select("index_id", "query_id", "score", "confidence")
    )


def brute_force(index: Mapping[int, Iterable[int]], queries: Mapping[str, Iterable[int]], vocabulary: Vocabulary, share: float = RETRIEVED) -> set[tuple[int, str]]:
    """What retrieve gives, by scoring every pair; for tests."""

    def weight(term: int) -> float:
        df = min(vocabulary.n_index, max(1, vocabulary.df_of(term) if term < TERMS else sum(vocabulary.df_of(x) for x in vocabulary.groups[term - TERMS])))
        return float(vocabulary._weights(np.array([df]), np.array([NAMES <= term < TERMS]))[0])

    out = set()
    for q, terms in queries.items():
        own = {t + TERMS if t in vocabulary.either else vocabulary.canonical(t) for t in terms}
        names = [weight(t) for t in own if NAMES <= t < TERMS]
        total = sum(weight(t) for t in own if not NAMES <= t < TERMS) + max(names, default=0.0)
        for i, record in index.items():
            held = {vocabulary.canonical(t) for t in record}
            if total and sum(weight(t) for t in own if (t in held if t < TERMS else held.intersection(vocabulary.groups[t - TERMS]))) >= total * share - _EPS:
                out.add((i, q))
    return out
