"""Importance resampling towards a target distribution over hashed n-grams.

A batch of texts interns its n-grams in an open-addressed table of numpy arrays: XXH64 keys, verified
on the bytes, lead to slots with a bucket and a count. Slot ids of the occurrences then gather gains, so
an n-gram that occurs a thousand times in a batch is hashed to its bucket once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import compress
from operator import ne

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .shared import field, saved, small_batches, with_columns_from_text

BUCKETS = 10_000
ORDER = 1  #: words of the longest feature
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SCALE = 1000
OCCURRENCES_AT_ONCE = 1 << 18  #: a batch is interned in parts of about so many occurrences
ROWS_A_TASK = 1 << 17  #: rows that one task ranks, about

#: A-Z lowered, every other ASCII byte that is no digit or letter a space; bytes beyond ASCII stay.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: runs of digits, ASCII letters (lower case) and all characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def features_of(words: list[bytes], order: int = ORDER) -> list[bytes]:
    """All runs of 1 to ``order`` words, joined by a space."""
    found = list(words)
    for n in range(2, order + 1):
        found += map(b" ".join, zip(*(words[k:] for k in range(n)), strict=False))
    return found


class InternTable:
    """Open addressing with linear probing over numpy arrays; ids are slots."""

    def __init__(self, buckets: int = BUCKETS, size: int = 1 << 12) -> None:
        self.buckets = buckets
        self._allocate(size)

    def _allocate(self, size: int) -> None:
        self.size, self.used = size, 0
        self.keys = np.zeros(size, np.uint64)
        self.grams = np.full(size, None, object)  #: the bytes; None marks a free slot
        self.bucket = np.zeros(size, np.int64)
        self.count = np.zeros(size, np.int64)

    def intern(self, grams: list[bytes]) -> np.ndarray:
        """The slot of each occurrence; new n-grams take the first free slot of their chain.

        Probing runs over all unsettled occurrences at once. Of those that meet a free slot the last one
        written wins it; the others see its bytes in the same round and go on if they differ.
        """
        n = len(grams)
        if 2 * (self.used + n) > self.size:
            self._grow(2 * (self.used + n))
        keys = np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, n)
        found = np.empty(n, np.int64)
        told = np.empty(n, object)
        told[:] = grams
        left, at = np.arange(n), (keys & np.uint64(self.size - 1)).astype(np.int64)
        while len(left):
            free = np.equal(self.grams[at], None)
            if free.any():
                slots, who = at[free], left[free]
                self.grams[slots] = told[who]
                self.keys[slots] = keys[who]
                slots = np.unique(slots)
                self.used += len(slots)
                self.bucket[slots] = [zlib.crc32(gram) % self.buckets for gram in self.grams[slots]]
            same = self.keys[at] == keys[left]
            # Equal keys are verified on the bytes; a false friend goes on like any other occupant.
            wrong = list(map(ne, self.grams[at[same]], told[left[same]]))
            if any(wrong):
                same[np.flatnonzero(same)[list(compress(range(len(wrong)), wrong))]] = False
            found[left[same]] = at[same]
            left, at = left[~same], (at[~same] + 1) & (self.size - 1)
        np.add.at(self.count, found, 1)
        return found

    def _grow(self, least: int) -> None:
        held = np.flatnonzero(np.not_equal(self.grams, None))
        keys, grams, bucket, count = self.keys[held], self.grams[held], self.bucket[held], self.count[held]
        self._allocate(1 << max(12, int(least - 1).bit_length()))
        at = (keys & np.uint64(self.size - 1)).astype(np.int64)
        left = np.arange(len(held))
        while len(left):
            free = np.equal(self.grams[at], None)
            first = np.zeros(len(at), bool)
            first[np.unique(at, return_index=True)[1]] = True
            placed = free & first
            slots, who = at[placed], left[placed]
            self.keys[slots], self.grams[slots] = keys[who], grams[who]
            self.bucket[slots], self.count[slots] = bucket[who], count[who]
            left, at = left[~placed], at[~placed]
            at = np.where(np.equal(self.grams[at], None), at, (at + 1) & (self.size - 1))
        self.used = len(held)

    def bucket_counts(self) -> np.ndarray:
        return np.bincount(self.bucket, weights=self.count, minlength=self.buckets).astype(np.int64)


def _parts(texts: list[str | None], order: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(words of each text, features of each text, all features) of parts of bounded size.

    A text is whole in one part; a part holds more than its bound only if one text does.
    """
    n_words: list[int] = []
    n_features: list[int] = []
    grams: list[bytes] = []
    for text in texts:
        words = words_of(text)
        before = len(grams)
        grams += features_of(words, order)
        n_words.append(len(words))
        n_features.append(len(grams) - before)
        if len(grams) >= OCCURRENCES_AT_ONCE:
            yield n_words, n_features, grams
            n_words, n_features, grams = [], [], []
    if n_words:
        yield n_words, n_features, grams


def bucket_counts(docs: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Feature occurrences of each bucket over all texts; a task sends one row a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, grams in _parts(batch.column(0).to_pylist(), order):
                table = InternTable(buckets)
                table.intern(grams)
                total += table.bucket_counts()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    texts = docs.select(F.col(f"`{text}`").alias("text"))
    parts = small_batches(texts).mapInArrow(count, "bucket long, n long")
    sums = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, np.int64)
    total[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed bucket shares, target over source."""
    buckets = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(SCALE * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, text: str = "text", order: int = ORDER) -> DataFrame:
    """Each input row as ``row`` with n_words, n_features and weight, the sum of its features' gains."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket, whatever the corpus

    def make():
        def read(texts: list[str | None]) -> list:
            worth = shared.value
            n_words, n_features, weights = [], [], []
            for words, features, grams in _parts(texts, order):
                table = InternTable(len(worth))
                slots = table.intern(grams)
                sums = np.concatenate(([0], np.cumsum(worth[table.bucket][slots])))
                ends = np.cumsum(features)
                n_words += words
                n_features += features
                weights += (sums[ends] - sums[ends - features]).tolist()
            return [n_words, n_features, weights]

        return read

    added = [field(name, LongType()) for name in ("n_words", "n_features", "weight")]
    return with_columns_from_text(docs, text, StructType(added), make)


def noise(doc_id, seed: int = SEED):
    """floor(-1000 ln(-ln u)), with u from the first 32 bits of sha256 of seed and id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log(uniform))).cast("long")


def ranked(rows: DataFrame, keys: list, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """The rows with ``rank`` (1, 2, ...) in the order of the keys, which must not tie.

    Rows are dealt by range, written, and numbered within their range; only one count a range meets in
    one task.
    """
    n = rows.count()
    dealt = rows.repartitionByRange(n // rows_a_task + 1, *keys).withColumn("part", F.spark_partition_id())
    dealt = saved(dealt, "ranges")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*keys))
    numbered = dealt.withColumn("inside", inside).join(offsets, "part")
    return numbered.withColumn("rank", F.col("before") + F.col("inside")).drop("part", "before", "inside")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    order: int = ORDER,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of each input row; rank is null where a row is not drawn.

    Bucket shares of all texts of both tables give the gains. Null and empty texts have no features and
    weight 0. Rows without an id count towards the shares, but have no score and are never drawn. Repeated
    rows are rows of their own; rows that tie in score and id take neighbouring ranks. An empty target
    makes every gain that of the smoothing alone, an empty table of documents gives an empty result.
    """
    narrow = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    gain = gains(bucket_counts(narrow, "text", order, buckets), bucket_counts(target, target_text, order, buckets))
    read = weighted(narrow, gain, "text", order)
    scored = read.select(
        F.col("row.id").alias("id"),
        "n_words",
        "n_features",
        "weight",
        (F.col("weight") + noise(F.col("row.id"), seed)).alias("score"),
    )
    scored = saved(scored.withColumn("uid", F.monotonically_increasing_id()), "scored")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    wanted = scored.filter(able).count() * percent // 100
    order_of = [F.col("score").desc(), F.col("id").asc(), F.col("uid").asc()]
    drawn = ranked(scored.filter(able), order_of).withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    shown = [F.col("id").alias(doc_id), "n_features", "weight", "score", "rank"]
    return drawn.select(*shown).unionByName(rest.select(*shown))


def lowered_words(text: str | None) -> list[str]:
    """The words as text, by pattern: the plain form of ``words_of`` that tests compare with."""
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
