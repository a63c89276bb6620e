"""Near-duplicate texts with small edits: bucketed prefixes of rarest words, bit sketches, exact verification.

Each text is a set of words. Words are hashed to units (hash, 1), (hash, 2), ... - the second where two words of a text
share a hash - and the units of all texts are in one order, those of the rarest hashes first. Two texts of n and m
words that are similar enough have at least o = max(needed(n), needed(m)) units in common, and the first d of these lie
among the first n - o + d units of the one and m - o + d of the other. So a text is sent to the buckets of its first
n - needed + 1 units, with the units that may follow; in a bucket texts meet that have the same first `depth` units.
A unit that more than HOT texts have, has a bucket for each unit that may follow. Sizes and sketches rule out pairs
before any is written; what is left is compared by its words. A text's words are shuffled only if it is in such a pair.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarium.llm.canonical import edits
from glossarium.llm.retrieval import _flat, _lists, _mix, _range, _starts, _triples, _unique
from glossarium.operators.skew import SALT, salt_of
from glossarium.session import cut

#: Hashes of words; the table of how many texts have each is bounded by this and goes to every task.
HASHES = 1 << 22
#: Texts of at most so many words meet by 3, by 2, beyond that by 1 unit; longer texts have rarer words.
DEPTHS = ((36, 3), (100, 2))
#: Texts of a unit from which it has a bucket for each unit that may follow.
HOT = 400_000
#: Rows of a bucket, and pairs that are looked at together.
BUCKET_ROWS, _AT_ONCE = 200_000, 2_000_000
#: Bits of the filters that say which texts are needed again.
FILTER_BITS = 1 << 24
_EPS = 1e-9

# Words that are added to a title without making it another one.
TITLE_ADDITIONS = frozenset("the a an online web uk us edition ed edn revised new print digital app".split())
_ORDINAL = re.compile(r"^\d+(st|nd|rd|th)?$")


def words_of(text: str | Column) -> Column:
    """Distinct words of a text in lower case: maximal runs of letters, marks and digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{M}\p{N}]+)"), 1))


class _Hashed(dict):
    """Hashes of words seen so far; emptied before it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = zlib.crc32(word.encode())
        return h


def _hashed(words: pa.Array, known: _Hashed) -> tuple[np.ndarray, np.ndarray]:
    """(owners, 32-bit hashes) of the words of each row."""
    split = [x.split(" ") for x in words.to_pylist()]
    sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    return np.repeat(np.arange(len(split)), sizes), np.fromiter((known[w] for row in split for w in row), dtype=np.int64, count=int(sizes.sum()))


def _needed(n: np.ndarray, threshold: float) -> np.ndarray:
    """Least overlap with any partner of a text of n words."""
    return np.ceil(n * threshold - _EPS).astype(np.int64)


def _depth(n: np.ndarray) -> np.ndarray:
    return np.where(n <= DEPTHS[0][0], 3, np.where(n <= DEPTHS[1][0], 2, 1))


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def packed_cut(df: DataFrame) -> DataFrame:
    """cut(df) of compressed columns: (rows binary); read by unpacked()."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["rows"])

    return cut(df.mapInArrow(pack, "rows binary"))


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for blob in (x for batch in batches for x in batch.column(0).to_pylist()):
        yield from pa.ipc.open_stream(blob)


def members_of(blobs: DataFrame, schema: str, key: str, keys: DataFrame) -> DataFrame:
    """The rows of a packed_cut whose `key` is among keys (one bigint column), and a few others. The driver gets a bitmap
    of FILTER_BITS bits, whatever the number of keys."""
    bits = keys.toDF("k").select(F.pmod("k", F.lit(FILTER_BITS)).alias("b")).groupBy((F.shiftright("b", 6)).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("b") % 64).cast("int"))).alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    table[bits["at"].to_numpy()] = bits["bits"].to_numpy()
    held = keys.sparkSession.sparkContext.broadcast(table)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            b = np.mod(batch.column(key).to_numpy(), FILTER_BITS)
            yield batch.filter(pa.array(held.value[b >> 6] >> (b & 63) & 1 == 1))

    return blobs.mapInArrow(chosen, schema)


def candidates(blobs: DataFrame, threshold: float) -> DataFrame:
    """(class_a, class_b), class_a < class_b: pairs of classes of similar size and sketch that have their first units in
    common, each once. blobs: packed (class_id, words), the words of a row joined by spaces; copies count once.
    """
    if threshold <= 2 / 3:
        raise ValueError("the units need a threshold above 2/3")
    spark, hot_from = blobs.sparkSession, HOT
    parallel = spark.sparkContext.defaultParallelism

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Hashed(), np.zeros(HASHES, dtype=np.int32)
        sends = 0
        for batch in unpacked(batches):
            owner, h = _hashed(batch.column("words"), known)
            total += np.bincount(_unique(owner << 22 | (h & (HASHES - 1))) & (HASHES - 1), minlength=HASHES).astype(np.int32)
            n = np.bincount(owner)
            sends += int((n - _needed(n, threshold) + 1).sum())
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1).astype(np.int32)), pa.array(np.append(total[found], sends).astype(np.int64))], ["h", "n"])

    counted = blobs.mapInArrow(count, "h int, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").toArrow()  # at most HASHES rows
    h, n = counted["h"].to_numpy(), counted["n"].to_numpy()
    table = np.ones(HASHES, dtype=np.int32)
    table[h[h >= 0]] = n[h >= 0]
    common = int(max(parallel * 2, -(-int(n[h < 0].sum()) // BUCKET_ROWS)))
    loads = spark.sparkContext.broadcast(table)
    bucket_of = lambda u: np.mod((u * 0x9E3779B1 & 0xFFFFFFFF) >> 7, common)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, load = _Hashed(), np.zeros(0, dtype=np.int64), loads.value
        for batch in unpacked(batches):
            # Copies within a task are sent once; what is known of earlier batches is bounded.
            ids = batch.column("class_id").to_numpy()
            fresh = np.unique(ids, return_index=True)[1]
            fresh = np.sort(fresh[~np.isin(ids[fresh], seen)])
            seen = np.concatenate([seen if len(seen) < _AT_ONCE else seen[:0], ids[fresh]])
            batch, ids = batch.take(pa.array(fresh)), ids[fresh]
            owner, h = _hashed(batch.column("words"), known)
            size = np.bincount(owner, minlength=len(ids))
            sketch = np.zeros(len(ids), dtype=np.uint64)
            np.bitwise_xor.at(sketch, owner, np.uint64(1) << (h >> 22 & 63).astype(np.uint64))
            unit = h & (HASHES - 1)
            order = np.lexsort((unit, load[unit], owner))
            unit = unit[order]  # owner stays, as it is the first key
            again = np.concatenate([[False], (unit[1:] == unit[:-1]) & (owner[1:] == owner[:-1])])
            run = np.arange(len(unit)) - np.maximum.accumulate(np.where(again, 0, np.arange(len(unit))))
            spread = load[unit]
            unit |= np.minimum(run, 1023) << 22
            start = _starts(size)
            place = np.arange(len(unit)) - start[owner]
            last = size - _needed(size, threshold)  # the last leading place
            leads = (place <= last[owner]) & (spread > 1) & (size[owner] >= 3)
            single = (_depth(size) == 1) & (_depth(np.floor(size / threshold + _EPS)) == 1)
            rows, units, owners = [], [], []

            def add(bucket: np.ndarray, of: np.ndarray, kind: int, begin: np.ndarray, sizes: np.ndarray, before: list[np.ndarray]) -> None:
                lengths = sizes + len(before)
                out, first = np.empty(int(lengths.sum()), dtype=np.int64), _starts(lengths)
                for k, x in enumerate(before):
                    out[first + k] = x
                out[_range(first + len(before), sizes)] = unit[_range(begin, sizes)]
                owners.append(np.repeat(np.arange(len(of)), lengths) + sum(len(r[0]) for r in rows))
                rows.append((bucket, of, np.full(len(of), kind)))
                units.append(out)

            # By one unit: its bucket gets the units from the first of the text that is the bucket's.
            calm = np.flatnonzero(leads & (spread <= hot_from) & ~single[owner])
            sent, at = np.unique(owner[calm] << 32 | bucket_of(unit[calm]), return_index=True)
            begin = calm[at]
            add(sent & 0xFFFFFFFF, sent >> 32, 0, begin, last[sent >> 32] + 3 - place[begin], [])
            alone = np.flatnonzero(leads & (spread <= hot_from) & single[owner])
            add(bucket_of(unit[alone]), owner[alone], 1, alone, np.zeros(len(alone), dtype=np.int64), [unit[alone]])
            # By two units: the third is one of those after them.
            hot = np.flatnonzero(leads & (spread > hot_from))
            seconds = last[owner[hot]] + 1 - place[hot]
            i, j = np.repeat(hot, seconds), _range(hot + 1, seconds)
            add(bucket_of(unit[i] * 31 + unit[j]), owner[i], 2, j + 1, last[owner[i]] + 3 - place[j] - 1, [unit[i], unit[j]])
            bucket, of, kind = (np.concatenate(c) for c in zip(*rows))
            lists = _lists(np.concatenate(owners), np.concatenate(units).astype(np.uint32).view(np.int32), len(of))
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(ids[of]), pa.array(sketch[of].view(np.int64)), pa.array((size[of] * 4 + kind).astype(np.int32)), lists], ["bucket", "class_id", "sketch", "meta", "units"])

    def match(key: tuple, rows: pa.Table) -> pa.Table:
        bucket, ids, meta = key[0].as_py(), rows["class_id"].to_numpy(), rows["meta"].to_numpy().astype(np.int64)
        size, kind = meta >> 2, meta & 3
        sketch = rows["sketch"].to_numpy().view(np.uint64)
        owner, unit = _flat(rows["units"])
        unit &= 0xFFFFFFFF
        length = np.bincount(owner, minlength=len(ids))
        start = _starts(length)
        place = np.arange(len(unit)) - start[owner]
        pairs = [np.zeros((0, 2), dtype=np.int64)]

        def joined(keys: np.ndarray, of: np.ndarray) -> None:
            order = np.argsort(keys, kind="stable")
            keys, of = keys[order], of[order]
            if not len(keys):
                return
            edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            runs = np.diff(np.append(edges, len(keys)))
            partners = np.repeat(edges + runs, runs) - np.arange(len(keys)) - 1
            hit = np.flatnonzero(partners)
            partners = partners[hit]
            total, a = np.cumsum(partners), 0
            while a < len(hit):
                b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + _AT_ONCE, "right")))
                x, y = of[np.repeat(hit[a:b], partners[a:b])], of[_range(hit[a:b] + 1, partners[a:b])]
                both = size[x] + size[y]
                fits = np.bitwise_count(sketch[x] ^ sketch[y]) <= both - 2 * np.ceil(both * (threshold / (1 + threshold)) - _EPS)
                x, y = x[fits], y[fits]
                fits = (np.minimum(size[x], size[y]) >= np.maximum(size[x], size[y]) * threshold - _EPS) & (ids[x] != ids[y])
                x, y = ids[x[fits]], ids[y[fits]]
                pairs.append(np.unique(np.column_stack([np.minimum(x, y), np.maximum(x, y)]), axis=0))
                a = b

        own = (bucket_of(unit) == bucket) & (place < length[owner] - 2) & (kind[owner] == 0)
        depths = [(_depth(size) == d) | (_depth(np.floor(size / threshold + _EPS)) == d) for d in (1, 2, 3)]
        three = depths[2][owner] & (kind[owner] == 0)
        key3, of3 = _triples(owner[three], unit[three], own[three], len(ids))
        second = np.flatnonzero(own & depths[1][owner])
        reach = length[owner[second]] - 2 - place[second]  # up to the last place but one
        key2, of2 = _mix(np.repeat(unit[second], reach), unit[_range(second + 1, reach)], np.full(int(reach.sum()), 2)), np.repeat(owner[second], reach)
        first = np.flatnonzero((own | (kind[owner] == 1)) & depths[0][owner])
        key1, of1 = _mix(unit[first], np.full(len(first), 1), np.full(len(first), 1)), owner[first]
        third = np.flatnonzero((kind[owner] == 2) & (place > 1))
        at = start[owner[third]]
        keyh, ofh = _mix(unit[at] + 7, unit[at + 1], unit[third]), owner[third]
        for keys, of in ((key3, of3), (key2, of2), (key1, of1), (keyh, ofh)):
            joined(keys, of)
        a, b = np.unique(np.concatenate(pairs), axis=0).T
        return pa.table({"class_a": a, "class_b": b})

    parts = max(parallel, common // 2)
    sent = blobs.mapInArrow(send, "bucket int, class_id bigint, sketch bigint, meta int, units array<int>").repartition(parts, "bucket")
    return sent.groupBy("bucket").applyInArrow(match, "class_a bigint, class_b bigint").distinct()


def similar_classes(blobs: DataFrame, schema: str, threshold: float) -> DataFrame:
    """(class_a, class_b), class_a < class_b: every pair of different word sets with that similarity or more.

    blobs: packed rows of `schema` with (class_id, words). Similarity is shared words over all words of both. Sets of one
    or two words are similar only to themselves. Sets are compared in full, whatever their size. Works for
    thresholds above 2/3, for which sets of three or more words overlap in at least three.
    """
    pairs = cut(candidates(blobs, threshold))
    ends = pairs.select(F.explode(F.array("class_a", "class_b")))
    words = members_of(blobs, schema, "class_id", ends).select("class_id", F.split("words", " ").alias("words")).dropDuplicates(["class_id"])
    sides = [words.select(F.col("class_id").alias(f"class_{s}"), F.col("words").alias(f"words_{s}")) for s in "ab"]
    shared, total = F.size(F.array_intersect("words_a", "words_b")), F.size("words_a") + F.size("words_b")
    return pairs.join(sides[0], "class_a").join(sides[1], "class_b").where(shared / (total - shared) >= threshold - _EPS).select("class_a", "class_b")


def same_title(a: str, b: str) -> bool:
    """Whether two titles are the same apart from small edits: case, punctuation, word order, misspellings of up to two
    letters in a word, words cut short, and additions such as an edition."""
    x, y = _title_words(a), _title_words(b)
    if not x or not y or len(x) != len(y):
        return bool(x) and bool(y) and "".join(x) == "".join(y)
    if x == y:
        return True
    left = list(y)
    for w in x:
        best = min(left, key=lambda v: (edits(w, v), v))
        d = edits(w, best)
        if d > (2 if max(len(w), len(best)) >= 6 else 1):
            best = next((v for v in left if _cut_short(w, v)), None)
        if best is None:
            return False
        left.remove(best)
    return True


def _cut_short(a: str, b: str) -> bool:
    """Whether the shorter word begins the longer one, with at most one misspelling from four letters on."""
    n = min(len(a), len(b))
    return n >= 3 and (a[:n] == b[:n] or (n >= 4 and edits(a[:n], b[:n]) <= 1))


def _title_words(title: str) -> list[str]:
    text = unicodedata.normalize("NFKC", title).casefold().replace("'", "").replace("’", "")
    words = re.findall(r"[^\W_]+", text)
    return sorted(w for w in words if w not in TITLE_ADDITIONS and not _ORDINAL.match(w)) or sorted(words)


def _same_titles(a: str, b: str) -> Column:
    def judge(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([same_title(u, v) for u, v in zip(x, y)])

    return F.pandas_udf(judge, "boolean")(a, b)


def near_duplicates(rows: DataFrame, threshold: float, salts: int = 4) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of rows (id, text, title) of similar text and same title.

    Rows with a null or blank title, or a text without words, match nothing. An id that comes several times counts
    once.
    """
    rows = rows.where("id is not null and text is not null and trim(title) <> ''").dropDuplicates(["id"])
    titles = rows.select("title").distinct().select(F.col("title").alias("key"), "title")
    return near_unique(rows.withColumnRenamed("title", "key"), titles, threshold, salts)


def near_unique(rows: DataFrame, titles: DataFrame, threshold: float, salts: int = 4) -> DataFrame:
    """near_duplicates of rows (id, text, key), each id once, with titles (key, title), each key once; rows without a
    title match nothing.

    Texts with the same word set form one class, and only classes are compared; titles are compared once per
    pair of distinct titles that meet. Classes and titles are expanded to rows at the end, over salts, so a class
    that holds a large part of the rows is not left to one task. A class is a 64-bit hash of its words: that two sets
    share one is unlikely below a billion sets. Titles are looked up only for texts that have a partner.
    """
    words = F.array_sort(words_of("text"))
    texts = rows.where("id is not null and text is not null and key is not null").select("id", "key", words.alias("words")).where("size(words) > 0")
    texts = texts.select("id", "key", F.xxhash64("words").alias("class_id"), F.array_join("words", " ").alias("words"))
    schema, blobs = _schema(texts), packed_cut(texts)
    alike = cut(similar_classes(blobs, schema, threshold))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            yield pa.RecordBatch.from_arrays([batch.column("class_id")], ["class_id"])

    several = blobs.mapInArrow(ids, "class_id bigint").groupBy("class_id").count().where("count > 1").select("class_id")
    wanted = alike.select(F.explode(F.array("class_a", "class_b"))).union(several)
    members = cut(members_of(blobs, schema, "class_id", wanted).join(titles, "key").select("class_id", "title", "id"))
    titled = members.groupBy("class_id", "title").agg(F.count(F.lit(1)).alias("m"))
    same = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("class_id").alias("class_a"), F.col("class_id").alias("class_b"))
    met = (
        alike.unionByName(same)
        .join(titled.select(F.col("class_id").alias("class_a"), F.col("title").alias("title_a")), "class_a")
        .join(titled.select(F.col("class_id").alias("class_b"), F.col("title").alias("title_b")), "class_b")
    )
    met = cut(met)
    agree = met.select("title_a", "title_b").distinct().where(_same_titles("title_a", "title_b"))
    pairs = met.join(agree, ["title_a", "title_b"])
    for side in ("a", "b"):
        own = members.select(F.col("class_id").alias(f"class_{side}"), F.col("title").alias(f"title_{side}"), F.col("id").alias(f"id_{side}")).withColumn(SALT, salt_of(f"id_{side}", salts=salts))
        pairs = pairs.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).join(own, [f"class_{side}", f"title_{side}", SALT]).drop(SALT)
    return pairs.where("class_a <> class_b or id_a < id_b").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def link_counts(pairs: DataFrame) -> DataFrame:
    """(id, links): how many partners each row of some pair has."""
    ends = pairs.select(F.explode(F.array("id_a", "id_b")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("links"))


def brute_force(rows: list[tuple[int, str, str]], threshold: float) -> set[tuple[int, int]]:
    """What near_duplicates gives, by comparing all pairs; for tests."""
    sets = {i: frozenset(re.findall(r"[^\W_]+", t.lower())) for i, t, s in rows if t and s and s.strip()}
    titles = {i: s for i, _, s in rows}
    ids = sorted(i for i in sets if sets[i])
    return {
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if len(sets[a] & sets[b]) >= ceil(threshold * len(sets[a] | sets[b]) - _EPS) and same_title(titles[a], titles[b])
    }
