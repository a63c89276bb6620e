"""Evaluation passages inside corpus documents: BM25 over an inverted index of the items, block-max pruning, exact check.

Every passage of a document is a query against the index of the test items. A quotation that counts holds at least
half of the item's words, so its passage scores at least the item's floor: the least BM25 weight that runs of the
needed length covering that many of its words can have. Term weights are divided by the floor of their item, after
which one threshold of 1 holds for all items, and retrieving all items above it loses no quotation. Items are kept
in blocks; a block's largest weight of each term bounds the score of all its items, and only blocks whose bound
reaches the threshold are scored item by item. What is retrieved is then checked word by word on the whole text.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Unbroken words that count, and the share of the item's words that they must make up.
RUN, SHARE = 6, 0.5
#: A quotation stands in one passage: from its first to its last word at most so many times the item's words.
STRETCH = 2
BLOCK = 16
#: The index goes to every task and may have at most so many items; more are worked on in as many passes as needed.
MOST_ITEMS = 20_000
K1, B = 1.2, 0.75

_WORD = re.compile(r"[^\W_]+")
_TAG = re.compile(r"</?[a-zA-Z][^<>\n]{0,80}>")
_PREFIX = re.compile(r"(?m)^[ \t]*(?:(?:\d{1,4}[.):]|[-*•>#|]+)[ \t]*)+")
_HIDDEN = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))


def words_of(text: str) -> list[str]:
    """Words in lower case, without markup, line prefixes and invisible characters."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_HIDDEN)
    if "<" in text:
        text = _TAG.sub("", text)
    if "&" in text:
        text = html.unescape(text)
    if "\n" in text:
        text = _PREFIX.sub("", text)
    return _WORD.findall(text.lower())


class LeakIndex:
    """Inverted index of the items with BM25 weights, normalized by each item's floor, and block maxima."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        read = [(i, w) for i, t in items if t and (w := words_of(t))]
        read.sort(key=lambda x: (sorted(set(x[1]))[:8], x[0]))
        self.ids = [i for i, _ in read]
        self.words = [w for _, w in read]
        self.term: dict[str, int] = {}
        for w in self.words:
            for t in w:
                self.term.setdefault(t, len(self.term))
        n, v = len(read), len(self.term)
        held = np.zeros((v, n), dtype=np.float32)
        for i, w in enumerate(self.words):
            for t in w:
                held[self.term[t], i] += 1
        df = (held > 0).sum(axis=1)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        length = held.sum(axis=0)
        norm = K1 * (1 - B + B * length / max(length.mean() if n else 1.0, 1e-9))
        weight = idf[:, None] * held * (K1 + 1) / (held + norm[None, :])
        self.floor = np.array([self._floor(i, weight[:, i], held[:, i]) for i in range(n)], dtype=np.float64)
        self.weight = (weight / np.maximum(self.floor, 1e-9)[None, :]).astype(np.float32)
        blocks = range(0, n, BLOCK)
        self.block = np.stack([self.weight[:, b : b + BLOCK].max(axis=1) for b in blocks], axis=1) if n else np.zeros((0, 0), np.float32)
        self.longest = max(map(len, self.words), default=0)
        self.grams: dict[tuple[str, ...], list[tuple[int, int]]] = defaultdict(list)
        for i, w in enumerate(self.words):
            for k in range(len(w) - RUN + 1):
                self.grams[tuple(w[k : k + RUN])].append((i, k))
        self.grams = dict(self.grams)

    def _floor(self, i: int, weight: np.ndarray, held: np.ndarray) -> float:
        """Least weight of runs of RUN or more words that make up SHARE of the item: by places, words so far, length of the run."""
        ids = [self.term[t] for t in self.words[i]]
        each = [float(weight[t] / held[t]) for t in ids]
        need = ceil(len(ids) * SHARE)
        off = {0: 0.0}
        on: dict[tuple[int, int], float] = {}
        for x in each:
            nxt: dict[tuple[int, int], float] = {}
            for k, c in off.items():
                key = (min(k + 1, need), 1)
                nxt[key] = min(nxt.get(key, np.inf), c + x)
            for (k, r), c in on.items():
                key = (min(k + 1, need), min(r + 1, RUN))
                nxt[key] = min(nxt.get(key, np.inf), c + x)
            for (k, r), c in on.items():
                if r == RUN:
                    off[k] = min(off.get(k, np.inf), c)
            on = nxt
        return min([c for (k, r), c in on.items() if r == RUN and k >= need] + [c for k, c in off.items() if k >= need], default=np.inf)

    def candidates(self, texts: list[list[str]]) -> set[tuple[int, int]]:
        """(place of the text, place of the item) of every item whose score some passage of the text brings to the threshold."""
        if not self.ids:
            return set()
        half = STRETCH * self.longest + RUN
        get = self.term.get
        out: set[tuple[int, int]] = set()
        owners: list[int] = []
        rows: list[np.ndarray] = []
        cells = 0
        limit = max(1, 6_000_000 // max(1, len(self.term)))
        for n, words in enumerate(texts):
            ids = np.fromiter((get(w, -1) for w in words), dtype=np.int32, count=len(words))
            for a in range(0, max(1, len(ids) - half), half):
                owners.append(n)
                rows.append(ids[a : a + 2 * half])
                cells += 1
                if cells == limit:
                    self._retrieve(owners, rows, out)
                    owners, rows, cells = [], [], 0
        if cells:
            self._retrieve(owners, rows, out)
        return out

    def _retrieve(self, owners: list[int], rows: list[np.ndarray], out: set[tuple[int, int]]) -> None:
        held = np.zeros((len(rows), len(self.term) + 1), dtype=np.float32)
        held[np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)] = 1
        held = held[:, :-1]
        bound = held @ self.block
        for b in np.flatnonzero((bound >= 0.999).any(axis=0)):
            at = np.flatnonzero(bound[:, b] >= 0.999)
            score = held[at] @ self.weight[:, b * BLOCK : (b + 1) * BLOCK]
            for r, i in zip(*np.nonzero(score >= 0.999)):
                out.add((owners[at[r]], b * BLOCK + i))

    def quoted(self, words: list[str], items: set[int]) -> dict[int, float]:
        """Of each of the items with an unbroken run in the text, the largest share of its words that stand there in the
        item's order, in one passage, in runs of RUN or more words."""
        runs: dict[int, list[list[int]]] = defaultdict(list)  # from in the text, from in the item, length
        open_runs: dict[tuple[int, int], list[int]] = {}
        get = self.grams.get
        for k, gram in enumerate(zip(*[words[j:] for j in range(RUN)])):
            at = get(gram)
            if at is None:
                if open_runs:
                    open_runs = {}
                continue
            nxt: dict[tuple[int, int], list[int]] = {}
            for i, p in at:
                if i in items:
                    run = open_runs.get((i, p - k))
                    if run is None:
                        run = [k, p, RUN]
                        runs[i].append(run)
                    else:
                        run[2] += 1
                    nxt[i, p - k] = run
            open_runs = nxt
        return {i: self._share(own, len(self.words[i])) for i, own in runs.items()}

    @staticmethod
    def _share(runs: list[list[int]], n: int) -> float:
        runs.sort()
        best = 0
        for first, (k0, p0, l0) in enumerate(runs):
            reach = k0 + STRETCH * n + RUN
            chain: list[tuple[int, int, int]] = []  # end in the text, end in the item, words
            for k, p, size in runs[first:]:
                if k >= reach:
                    break
                size = min(size, reach - k)
                if size < RUN:
                    continue
                got = 0 if (k, p) == (k0, p0) else -1
                for end_k, end_p, c in chain:
                    cut = max(0, end_k - k, end_p - p)
                    if size - cut >= RUN or (size - cut > 0 and cut > 0):
                        got = max(got, c - cut)
                if got >= 0:
                    chain.append((k + size, p + size, got + size))
                    best = max(best, got + size)
        return best / n


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): the items of which a passage stands in the document, fully or by half or more, each pair once.

    documents: doc_id, text; items: item_id, text. Letter case, punctuation, spacing, line breaks, line prefixes and
    markup do not count. Null and empty texts hold nothing; items of fewer than RUN words cannot be quoted. Whole
    texts are read, in overlapping passages, without a shuffle of the corpus. Of several rows of one doc_id each is
    read. Items beyond MOST_ITEMS are indexed in several passes over the documents.
    """
    listed = [(r[0], r[1]) for r in items.where("item_id is not null and text is not null").select("item_id", "text").distinct().sort("item_id", "text").toLocalIterator()]
    out = None
    for a in range(0, max(1, len(listed)), MOST_ITEMS):
        part = listed[a : a + MOST_ITEMS]

        def search(batches: Iterator[pd.DataFrame], part: list = part) -> Iterator[pd.DataFrame]:
            index = LeakIndex(part)
            for batch in batches:
                texts = [words_of(t) for t in batch["text"]]
                asked: dict[int, set[int]] = defaultdict(set)
                for d, i in index.candidates(texts):
                    asked[d].add(i)
                ids = batch["doc_id"].tolist()
                found = [(ids[d], index.ids[i]) for d, some in sorted(asked.items()) for i, share in index.quoted(texts[d], some).items() if share >= SHARE - 1e-9]
                yield pd.DataFrame(found, columns=["doc_id", "item_id"], dtype="int64")

        got = documents.where("doc_id is not null and text is not null").select("doc_id", "text").mapInPandas(search, "doc_id bigint, item_id bigint")
        out = got if out is None else out.unionByName(got)
    return out.distinct()


def brute_force(documents: list[tuple[int, str]], items: list[tuple[int, str]]) -> set[tuple[int, int]]:
    """What leaked_items gives, by checking every document against every item; for tests."""
    index = LeakIndex(items)
    every = set(range(len(index.ids)))
    return {(d, index.ids[k]) for d, t in documents if t for k, share in index.quoted(words_of(t), every).items() if share >= SHARE - 1e-9}
