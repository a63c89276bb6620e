"""Subjects of documents: the document-term matrix factored with seeded non-negative alternating updates.

Terms are words hashed to TERMS columns, so the factor that goes to every task has a bound. Each subject is one
component, and each common language one background component. Components are anchored by the labelled documents:
a term whose documents prefer a subject, by a likelihood-ratio test within its language, starts in that subject's
component and in no background; a term of labelled documents that prefers none starts in the backgrounds only, and a
term of no labelled document may go to any component. The updates are multiplicative (for the Kullback-Leibler
divergence), so what starts at zero stays zero and a component keeps its subject. All documents take part in every
update, and the updates end when the divergence does. The weights of a document over the subject components, divided
by their sum, are its mixture of subjects.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarium.session import cut

TERMS = 1 << 18
#: A language has a background component if so large a share of the documents names it (so there are at most 50).
LANGUAGE_SHARE = 0.02
#: An anchor's share of a subject's labelled documents is so many times that of the others, and so much above it. How
#: sure the difference has to be grows with the number of labelled documents, as they decide how many terms are tested.
ANCHOR_RATIO, ANCHOR_GAP = 2.5, 0.01
#: Labelled documents from which a term that anchors nothing belongs to the backgrounds only.
BACKGROUND_DOCUMENTS = 3
#: What terms of no labelled document start with in a subject, relative to their frequency.
OPEN = 1e-2
#: A round is the last one if it lowers the divergence (nats a word) by less than this.
CONVERGED = 2e-3
#: Updates of the document weights for one factor; they start anew, as the problem is convex for a fixed factor.
INNER = 4
#: Part of the mixture from which a document has a subject, and how many it may have.
DOCUMENT_SHARE, MOST_SUBJECTS = 1 / 6, 3
_CHUNK = 400_000
_SCHEMA = "doc_id bigint, language string, terms array<int>, counts array<int>"


def document_terms(documents: DataFrame) -> DataFrame:
    """(doc_id, language, terms, counts): distinct hashed words of the whole text, each with its number."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{2,})"), 1)
    language = F.substring(F.lower(F.trim(F.coalesce("lang", F.lit("")))), 1, 2)
    hashed = (
        documents.where("doc_id is not null and text is not null")
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), language.alias("language"), F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(TERMS)).cast("int")).alias("w"))
        .where("size(w) > 0")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            key, n = np.unique(np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) * TERMS + column.flatten().to_numpy(zero_copy_only=False), return_counts=True)
            ends = pa.array(np.searchsorted(key, np.arange(len(sizes) + 1, dtype=np.int64) * TERMS).astype(np.int32))
            terms = pa.ListArray.from_arrays(ends, pa.array((key % TERMS).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), terms, pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int32)))], ["doc_id", "language", "terms", "counts"])

    return hashed.mapInArrow(count, _SCHEMA)


class Factors:
    """The term factor (terms x components) and what the tasks do with it."""

    def __init__(self, factor: np.ndarray, subjects: int) -> None:
        self.factor, self.subjects = factor.astype(np.float32), subjects

    def _posterior(self, weights: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = weights[doc] * self.factor[term]
        total = np.maximum(p.sum(axis=1), 1e-20)
        p *= (count / total)[:, None]
        return p, total

    @staticmethod
    def _sum(into: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
        for c in range(values.shape[1]):
            into[:, c] += np.bincount(at, weights=values[:, c], minlength=len(into))

    def weights(self, batch: pd.DataFrame, terms_into: np.ndarray | None = None) -> tuple[np.ndarray, float]:
        """(weights of the documents, log-likelihood of their words); the last update's term sums are added to terms_into."""
        doc, term, count = _flat(batch)
        k, n = self.subjects, self.factor.shape[1]
        weights = np.empty((len(batch), n), dtype=np.float32)
        weights[:, :k], weights[:, k:] = 0.3 / k, 0.7 / (n - k)
        likelihood = 0.0
        for i in range(INNER):
            sums = np.zeros(weights.shape)
            for a in range(0, len(term), _CHUNK):
                d, t, c = doc[a : a + _CHUNK], term[a : a + _CHUNK], count[a : a + _CHUNK]
                p, total = self._posterior(weights, d, t, c)
                self._sum(sums, d, p)
                if terms_into is not None and i == INNER - 1:
                    used = np.unique(t)
                    part = np.zeros((len(used), n))
                    self._sum(part, np.searchsorted(used, t), p)
                    terms_into[used] += part
                    likelihood += float((c * np.log(total)).sum())
            weights = (sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-20)).astype(np.float32)
        return weights, likelihood


def _flat(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(t) for t in batch["terms"]]
    if not sum(sizes):
        return (np.zeros(0, dtype=np.int64),) * 3
    return np.repeat(np.arange(len(batch)), sizes), np.concatenate(list(batch["terms"])).astype(np.int64), np.concatenate(list(batch["counts"])).astype(np.float32)


def _times_log(x: Column, expected: Column) -> Column:
    return F.when((x > 0) & (expected > 0), x * F.log(x / expected)).otherwise(F.lit(0.0))


def anchors(labelled: DataFrame, per_subject: DataFrame, least: float) -> DataFrame:
    """(term, subject, strength) of the terms that tell a subject, and (term, null, null) of frequent ones that tell none.

    labelled: language, subject, weight, terms of each labelled document and subject; per_subject: language, subject,
    n (documents), all (documents of the language). The statistic is the root of the likelihood ratio of two shares,
    which unlike a difference in standard errors is not misled by terms of very few documents.
    """
    held = labelled.select("language", "subject", "weight", F.explode("terms").alias("term")).groupBy("language", "subject", "term").agg(F.sum("weight").alias("c"))
    whole = held.groupBy("language", "term").agg(F.sum("c").alias("total"))
    c, n, total, every = F.col("c"), F.col("n"), F.col("total"), F.col("all")
    rest, rest_n = F.greatest(total - c, F.lit(0.0)), F.greatest(every - n, F.lit(1e-9))
    p, share, others = total / every, c / n, rest / rest_n
    ratio = 2 * (_times_log(c, n * p) + _times_log(n - c, n * (1 - p)) + _times_log(rest, rest_n * p) + _times_log(rest_n - rest, rest_n * (1 - p)))
    telling = (F.sqrt(F.greatest(ratio, F.lit(0.0))) >= least) & (c >= 1) & (share > ANCHOR_RATIO * others) & (share - others >= ANCHOR_GAP)
    tested = held.join(whole, ["language", "term"]).join(F.broadcast(per_subject), ["language", "subject"])  # languages x subjects rows
    judged = tested.select("term", "subject", F.when(telling, (share - others) * n).alias("strength"), "c")
    strong = judged.where("strength is not null").groupBy("term", "subject").agg(F.sum("strength").alias("strength"))
    frequent = judged.groupBy("term").agg(F.sum("c").alias("c"), F.max("strength").alias("s")).where(f"s is null and c >= {BACKGROUND_DOCUMENTS}")
    return strong.unionByName(frequent.select("term", F.lit(None).cast("string").alias("subject"), F.lit(None).cast("double").alias("strength")))


def _seed(terms: DataFrame, labels: DataFrame, names: list[str]) -> tuple[np.ndarray, int] | None:
    """(the factor to begin with, the subject of most labels). What is collected: anchors, frequent terms and counts of
    terms by language, each at most TERMS rows for one subject or language."""
    counted = terms.groupBy("language").count()
    n_documents = counted.agg(F.sum("count")).first()[0] or 0
    found = counted.where((F.col("count") >= LANGUAGE_SHARE * n_documents) & (F.col("language") != "")).orderBy(F.desc("count"), "language").collect()
    languages = [r["language"] for r in found] or [""]
    place = {g: i for i, g in enumerate(languages)}
    words = terms.withColumn("language", F.when(F.col("language").isin(languages), F.col("language")).otherwise(F.lit(languages[0])))
    ones = labels.where("doc_id is not null").select("doc_id", "subject").distinct().where(F.col("subject").isin(names))
    weighted = ones.join(ones.groupBy("doc_id").agg((1 / F.count(F.lit(1))).alias("weight")), "doc_id")
    labelled = cut(words.select("doc_id", "language", "terms").join(weighted, "doc_id"))
    sizes = labelled.groupBy("language", "subject").agg(F.sum("weight").alias("n"))
    per_subject = sizes.join(sizes.groupBy("language").agg(F.sum("n").alias("all")), "language")
    by_subject = {r["subject"]: r["n"] for r in sizes.groupBy("subject").agg(F.sum("n").alias("n")).collect()}
    if not by_subject:
        return None
    at = {s: i for i, s in enumerate(names)}
    table = anchors(labelled, per_subject, float(np.sqrt(2 * np.log(max(2.0, sum(by_subject.values())))))).toArrow().to_pandas()
    common = words.select("language", F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("language", F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("n")).toArrow().to_pandas()
    strong = table[table["subject"].notna()]
    seed = np.zeros((TERMS, len(names)))
    seed[strong["term"].to_numpy(), strong["subject"].map(at).to_numpy(dtype=int)] = strong["strength"].to_numpy()
    background = np.zeros((TERMS, len(languages)))
    background[common["term"].to_numpy(), common["language"].map(place).to_numpy(dtype=int)] = common["n"].to_numpy()
    overall = background.sum(axis=1) / max(background.sum(), 1)
    background /= np.maximum(background.sum(axis=0), 1)
    seed /= np.maximum(seed.sum(axis=0), 1e-9)
    anchored = seed.sum(axis=1) > 0
    background[anchored] = 0
    free = ~anchored
    free[table["term"][table["subject"].isna()].to_numpy()] = False
    seed[free] = OPEN * overall[free, None]
    factor = np.concatenate([seed, background], axis=1)
    return factor / np.maximum(factor.sum(axis=0), 1e-20), at[max(by_subject, key=lambda s: (by_subject[s], s))]


def _update(terms: DataFrame, factors: Factors) -> tuple[np.ndarray, float]:
    """(the next term factor, log-likelihood a word with this one): every document's term sums, added up by term."""
    n = factors.factor.shape[1]
    names = [f"c{i}" for i in range(n)]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, likelihood, words = np.zeros((TERMS, n), dtype=np.float32), 0.0, 0.0
        for batch in batches:
            likelihood += factors.weights(batch, sums)[1]
            words += float(sum(int(c.sum()) for c in batch["counts"]))
        rows = np.flatnonzero(sums.sum(axis=1) > 0)
        told = pd.DataFrame([[-1.0, likelihood, words] + [0.0] * n], columns=["term", *(names + ["x", "y"])[: n + 2]]).iloc[:, : n + 1]
        yield pd.concat([pd.DataFrame(sums[rows], columns=names).assign(term=rows), told])[["term", *names]].astype({"term": "int64"} | {c: "float64" for c in names})

    added = terms.select("terms", "counts").mapInPandas(partial, "term bigint, " + ", ".join(f"{c} double" for c in names)).groupBy("term").agg(*[F.sum(c).alias(c) for c in names]).toArrow().to_pandas()
    summed = added[added["term"] >= 0]
    told = added.loc[added["term"] < 0, names].to_numpy()
    out = np.zeros((TERMS, n))
    out[summed["term"].to_numpy()] = summed[names].to_numpy()  # at most TERMS rows
    level = float(told[0][0] / max(told[0][1], 1.0)) if len(told) else 0.0
    return out / np.maximum(out.sum(axis=0), 1e-20), level


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """(doc_id, subject, share): the subjects that make up a sixth or more of the document's mixture.

    documents: doc_id, text, lang; labels: doc_id, subject, some wrong or repeated; subjects: subject. A document with
    words has one to three: the largest part of its mixture always stands, and where no word belongs to any subject's
    component it has the subject of most labels, with the share 0. Documents without words have none; without labels
    there are no components to anchor and no rows. The language column only chooses backgrounds: it may be null or wrong.
    """
    names = sorted({r["subject"] for r in subjects.where("subject is not null").select("subject").distinct().collect()})
    terms = cut(document_terms(documents))
    seeded = _seed(terms, labels, names) if names else None
    schema = "doc_id bigint, subject string, share double"
    if seeded is None:
        return documents.sparkSession.createDataFrame([], schema)
    factor, usual = seeded
    level, gain = -np.inf, np.inf
    while gain >= CONVERGED:  # the likelihood never falls and is at most 0, so this ends
        factor, reached = _update(terms, Factors(factor, len(names)))
        level, gain = reached, reached - level
    factors = Factors(factor, len(names))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = factors.weights(batch)[0][:, : len(names)].astype(float)
            total = own.sum(axis=1, keepdims=True)
            share = np.where(total > 1e-9, own / np.maximum(total, 1e-9), 0.0)
            top = np.argsort(-share, axis=1, kind="stable")[:, :MOST_SUBJECTS]
            top[total[:, 0] <= 1e-9, 0] = usual
            value = np.take_along_axis(share, top, axis=1)
            keep = value >= DOCUMENT_SHARE
            keep[:, 0] = True
            rows, place = np.nonzero(keep)
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[rows], "subject": [names[s] for s in top[rows, place]], "share": value[rows, place]})

    found = terms.select("doc_id", "terms", "counts").mapInPandas(assign, schema)
    return found.groupBy("doc_id", "subject").agg(F.max("share").alias("share"))
