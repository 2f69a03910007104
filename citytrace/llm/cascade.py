"""URL filters: rules by host and path, and a Bloom filter cascade for everything that no rule fits.

Only DataFrame functions. The cascade's levels encode in turn the listed keys and the false positives
over the complete universe of keys, so that membership of any key of the universe is exact, and a row
is judged by bit tests without a join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, saved

#: Bits of one level at most (8 MB); a longer list is looked up by a shuffled join instead.
MAX_BITS = 1 << 26
MAX_LEVELS = 64

#: The rules as (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Names of sites that the list holds.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule for the host or a domain above it; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, decided in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decided).otherwise(verdict)
    return name, verdict


class Cascade:
    """Levels of (words of bits, number of bits, hashes); built by ``build``."""

    def __init__(self, levels: list[tuple[DataFrame, int, int]]) -> None:
        self.levels = levels

    @staticmethod
    def _places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(bits).cast("long")) for k in range(hashes)]

    @classmethod
    def _hits(cls, key: Column, level: int, filter_: tuple[DataFrame, int, int]) -> Column:
        words, bits, hashes = filter_
        array, hit = words.scalar(), F.lit(True)
        for place in cls._places(key, level, bits, hashes):
            word = F.get(array, F.shiftright(place, 6).cast("int"))
            hit = hit & (F.getbit(word, (place % 64).cast("int")) == 1)
        return hit

    @classmethod
    def _encode(cls, keys: DataFrame, level: int, bits: int, hashes: int) -> DataFrame:
        """One row with all words: bits are combined before the shuffle, words are ordered at the end."""
        place = F.explode(F.array(*cls._places(F.col("key"), level, bits, hashes)))
        spots = keys.select(place.alias("place"))
        # getbit counts from the lowest bit.
        words = spots.select(
            F.shiftright("place", 6).alias("at"), F.expr("shiftleft(1L, cast(place % 64 as int))").alias("bit")
        )
        words = words.groupBy("at").agg(F.bit_or("bit").alias("bits"))
        all_words = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "at")
        dense = all_words.join(words, "at", "left").select(F.struct("at", F.coalesce("bits", F.lit(0)).alias("bits")).alias("w"))
        one = dense.agg(F.array_sort(F.collect_list("w")).alias("w"))
        return saved(one.select(F.transform("w", lambda w: w["bits"]).alias("words")), f"cascade-{level}")

    @classmethod
    def build(cls, universe: DataFrame, listed: DataFrame, max_bits: int = MAX_BITS) -> Cascade | None:
        """Levels over distinct keys (column ``key``); None if the list is too long for the bound.

        Null keys are in no set. Listed keys outside the universe are encoded as well.
        """
        keys = universe.select("key", F.lit(False).alias("on")).union(listed.select("key", F.lit(True).alias("on")))
        keys = saved(keys.filter("key is not null").groupBy("key").agg(F.max("on").alias("on")), "keys")
        inside, outside = keys.filter("on").select("key"), keys.filter("not on").select("key")
        n_in, n_out = inside.count(), outside.count()
        levels: list[tuple[DataFrame, int, int]] = []
        rate = min(0.5, max(1e-6, math.sqrt(0.5) * n_in / max(1, n_out)))
        while n_in and len(levels) < MAX_LEVELS:
            bits = -(-max(64, math.ceil(n_in * -math.log(rate) / math.log(2) ** 2)) // 64) * 64
            if bits > max_bits:
                return None
            hashes = max(1, round(-math.log2(rate)))
            level = (cls._encode(inside, len(levels), bits, hashes), bits, hashes)
            wrong = saved(outside.filter(cls._hits(F.col("key"), len(levels), level)), "false-positives")
            levels.append(level)
            # The next level tells the false positives from the keys of this one.
            inside, outside, n_in, rate = wrong, inside, wrong.count(), 0.5
        return cls(levels) if not n_in else None

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed; a null key is not."""
        found = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels) - 1, -1, -1):
            found = F.when(self._hits(key, level, self.levels[level]), found).otherwise(F.lit(level % 2 == 1))
        return F.coalesce(found & key.isNotNull(), F.lit(False))


def judged(
    pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url", max_bits: int = MAX_BITS
) -> DataFrame:
    """(page_id, host, path, rule, listed, verdict) of every row.

    ``listed`` has hosts in a column ``key``. A null url and one without ``://`` have an empty host and
    path, which no rule fits; such a page is allowed unless the empty host is listed. Repeated rows stay.
    """
    address = F.col(f"`{url}`")
    rows = pages.select(F.col(f"`{page_id}`").alias(page_id), host_of(address).alias("host"), path_of(address).alias("path"))
    hosts = saved(rows.groupBy("host").agg(F.count("*").alias("rows")).select(F.col("host").alias("key")), "hosts")
    cascade = Cascade.build(hosts, listed, max_bits)
    if cascade is None:
        # Beyond the bound: a shuffled join on distinct keys, split at hot hosts by adaptive execution.
        keys = listed.select(F.col("key").alias("listed_key")).filter("listed_key is not null").distinct()
        rows = rows.join(keys, F.col("host") == F.col("listed_key"), "left")
        rows = rows.withColumn("listed", F.col("listed_key").isNotNull()).drop("listed_key")
    else:
        rows = rows.withColumn("listed", cascade.holds(F.col("host")))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"))
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return rows.select(page_id, "host", "path", rule.alias("rule"), "listed", F.coalesce(verdict, own).alias("verdict"))


def listed_hosts(pages: DataFrame, url: str = "url", names: tuple[str, ...] = LISTED_NAMES) -> DataFrame:
    """Distinct hosts with a listed name among their labels, as the list of the checked query."""
    host = host_of(F.col(f"`{url}`"))
    hosts = pages.select(host.alias("key")).distinct()
    return hosts.filter(F.arrays_overlap(F.split("key", "[.]"), F.array(*[F.lit(n) for n in names])))
