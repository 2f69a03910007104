"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .shared import component_roots, field, saved, with_columns_from_text

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int) -> int:
    """A bit is set if over half of the shingles' XXH64 values have it; no words give zero.

    Words are runs of non-space characters after lowering A-Z; a text of fewer words than a shingle
    has itself as its only shingle. Repeats count.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    last = ends[min(words, len(found)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    totals = np.zeros(BITS, np.int64)
    for at in range(0, len(last), SHINGLES_AT_ONCE):
        upto = last[at : at + SHINGLES_AT_ONCE]
        hashes = np.array(
            [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + len(upto)], upto, strict=False)], np.uint64
        )
        totals += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * totals > len(last), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3) -> DataFrame:
    """Each input row as ``row`` with ``fp``, its 64 bits as a long. Null and empty texts have zero."""

    def make():
        return lambda texts: [[fingerprint(t, words) for t in texts]]

    return with_columns_from_text(docs, text, StructType([field("fp", LongType())]), make)


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints of column ``fp`` within ``radius`` bits.

    Every fingerprint emits the variants within half the radius; two that are close enough meet at
    one of them. All that meet at a variant lie within the radius of each other, and no more than a
    ball's volume can meet there, so one link from each to the smallest keeps every connection. The
    distance is verified all the same.
    """
    if radius % 2 or not 0 <= radius <= 4:
        raise ValueError("radius is 0, 2 or 4")
    masks = [
        sum(1 << bit for bit in flips) for size in range(radius // 2 + 1) for flips in combinations(range(BITS), size)
    ]
    signed = [mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask for mask in masks]
    balls = fps.select("fp").distinct().select(
        "fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(mask)) for mask in signed])).alias("variant")
    )
    met = balls.groupBy("variant").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return (
        met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        .distinct()
    )


def hex_digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """(id, fp, component_id) of each input row; component_id is the smallest id that links reach.

    Equal fingerprints are one class before any link is made, so a mass of copies costs one row.
    Repeated rows and ids stay as they are; a null id never names a component that has another id.
    An empty table gives an empty one.
    """
    narrow = docs.select(F.col(f"`{doc_id}`").alias(doc_id), F.col(f"`{text}`").alias("of_text"))
    printed = saved(fingerprints(narrow, "of_text", words).select(f"row.`{doc_id}`", "fp"), "fingerprints")
    classes = saved(printed.groupBy("fp").agg(F.min(doc_id).alias("first")), "classes")
    roots = component_roots(links(classes, radius))
    rooted = saved(
        classes.join(roots, F.col("fp") == F.col("node"), "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked")
        ),
        "rooted",
    )
    firsts = rooted.filter("linked").groupBy("root").agg(F.min("first").alias("lowest"))
    labels = (
        rooted.filter("linked")
        .join(firsts, "root")
        .select("fp", "lowest")
        .union(rooted.filter("not linked").select("fp", "first"))
        .toDF("fp_of", "component_id")
    )
    return printed.join(labels, F.col("fp") == F.col("fp_of")).drop("fp_of")


def one_of_each(docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's rows without near-duplicates: of each group the row of the smallest id stays.

    ``groups`` has the id and component_id of each row.

    Of rows that share both id and text one stays. Rows without an id stay, one of each text, since no
    component can name them.
    """
    found = saved(groups.select(doc_id, "component_id"), "near-duplicates")
    number = F.col(f"`{doc_id}`")
    named = found.groupBy(number.alias("kept_id")).agg(
        F.min("component_id").alias("component"), F.count("*").alias("rows")
    )
    named = saved(named.filter("kept_id = component"), "kept-ids")
    # Texts are dealt by id once, at every size alike, and meet the ids without being sorted.
    single = docs.join(named.filter("rows = 1").hint("shuffle_hash"), number == F.col("kept_id"), "left_semi")
    repeated = named.filter("rows > 1")
    odd = []
    if not repeated.isEmpty():
        odd.append(docs.join(repeated, number == F.col("kept_id"), "left_semi"))
    if not found.filter(number.isNull()).isEmpty():
        odd.append(docs.filter(number.isNull()))
    for rows in odd:
        single = single.unionByName(rows.dropDuplicates([doc_id, text]))
    return single
