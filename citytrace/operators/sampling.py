"""Repeatable samples by a numeric key instead of a random generator.

A key is a non-negative long below ``space`` that depends only on the row. The rows with the
smallest keys are the sample, so it is the same however the data is partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citytrace.operators.lookup import with_row
from citytrace.session import cut_lineage

HASH_SPACE = 1 << 52
KEY_SLICES = 65_536
BLOCK = 256  #: slices whose counts are summed in one window


def hash_key(*cols: str, seed: int = 42) -> Column:
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(HASH_SPACE))


def running(counts: DataFrame, by: Sequence[str], at: str, size: str) -> DataFrame:
    """Add ``_before``: the sum of ``size`` over the group's rows with a lower ``at``; one row for each (group, at).

    A window sums within blocks of neighbouring places; the blocks of a group are one short array.
    """
    blocked = counts.withColumn("_block", F.floor(F.col(at) / BLOCK))
    blocks = blocked.groupBy(*by, "_block").agg(F.sum(size).alias("_of_block"))
    listed = F.collect_list(F.struct(F.col("_block").alias("block"), F.col("_of_block").alias("m")))
    lists = blocks.groupBy(*by).agg(listed.alias("_blocks"))
    whole = blocked.join(lists, list(by), "inner") if by else blocked.withColumn("_blocks", lists.scalar())
    lower = F.filter("_blocks", lambda b: b["block"] < F.col("_block"))
    inside = F.sum(size).over(Window.partitionBy(*by, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, -1))
    before = F.aggregate(lower, F.lit(0).cast("long"), lambda total, b: total + b["m"]) + F.coalesce(inside, F.lit(0))
    return whole.withColumn("_before", before).select(*counts.columns, "_before")


def preceding(df: DataFrame, by: Sequence[str], order: Sequence[str], size: str) -> DataFrame:
    """Add ``_before``: the sum of ``size`` over the group's rows that come earlier in the order.

    Rows are dealt by range of (group, order), so a group of any size is spread over all tasks, and written
    once. A task orders its own share; what lies before it is read off the sums per task and group.
    """
    dealt = cut_lineage(df.repartitionByRange(*by, *order).withColumn("_share", F.spark_partition_id()))
    sums = dealt.groupBy(*by, "_share").agg(F.sum(size).alias("_m"))
    ahead = running(sums, by, "_share", "_m").select(*by, "_share", F.col("_before").alias("_ahead"))
    own = Window.partitionBy(*by, "_share").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("_inside", F.coalesce(F.sum(size).over(own), F.lit(0)))
    joined = inside.join(ahead, [*by, "_share"], "inner")
    return joined.withColumn("_before", F.col("_ahead") + F.col("_inside")).select(*df.columns, "_before")


def take_smallest(df: DataFrame, n: int | Column, key: Column, space: int = HASH_SPACE) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) with the smallest keys, ties by the columns in order.

    No global sort: a count per key slice finds the slice the cut falls into, whole slices below
    pass through, and only the slice of the cut is ranked, dealt by range over all tasks. Copies of a row are
    ranked once with their count and repeated afterwards, so a mass of copies never meets in one task.
    Runs Spark jobs.
    """
    return _take(df, [], F.lit(n) if isinstance(n, int) else n, key, space)


def take_smallest_by(df: DataFrame, quotas: DataFrame, by: Sequence[str], key: Column, space: int) -> DataFrame:
    """As ``take_smallest`` within each group; ``quotas`` holds the group keys and ``_quota``."""
    return _take(df, list(by), quotas, key, space)


def _take(df: DataFrame, by: list[str], quota, key: Column, space: int) -> DataFrame:
    cols = df.columns
    width = max(1, -(-space // KEY_SLICES))
    keyed = df.withColumn("_k", key.cast("long")).withColumn("_s", F.floor(F.col("_k") / width))
    slices = keyed.groupBy(*by, "_s").agg(F.count(F.lit(1)).alias("_m"))
    slices = slices.join(quota, by, "inner") if by else slices.withColumn("_quota", quota)
    # At most KEY_SLICES rows a group.
    placed = cut_lineage(running(slices, by, "_s", "_m"))
    upto = F.col("_before") + F.col("_m")
    cut = placed.where((F.col("_before") < F.col("_quota")) & (upto > F.col("_quota"))).select(
        *by, F.col("_s").alias("_cut"), (F.col("_quota") - F.col("_before")).alias("_left")
    )
    full = placed.where((F.col("_quota") > 0) & (upto <= F.col("_quota"))).groupBy(*by).agg(F.max("_s").alias("_last"))
    if by:
        marked = keyed.join(full.join(cut, by, "full"), by, "inner")
    else:
        marked = with_row(with_row(keyed, full, "_f"), cut, "_e").select(*keyed.columns, "_f._last", "_e._cut", "_e._left")
    whole = marked.where(F.col("_s") <= F.col("_last")).select(*cols)
    tied = cut_lineage(
        marked.where(F.col("_s") == F.col("_cut")).groupBy(*cols, "_k", "_left").agg(F.count(F.lit(1)).alias("_c"))
    )
    ranked = preceding(tied, by, ["_k", *[c for c in cols if c not in by]], "_c")
    part = _repeated(ranked, F.least(F.col("_c"), F.col("_left") - F.col("_before"))).select(*cols)
    return whole.unionByName(part)


def _repeated(df: DataFrame, copies: Column) -> DataFrame:
    """Every row as often as ``copies`` says; none where it is 0 or less."""
    some = df.withColumn("_copies", copies.cast("long")).where(F.col("_copies") > 0)
    return some.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).drop("_copies", "_i")


def sample_capped(df: DataFrame, share: float, cap: int, key: Column, space: int = HASH_SPACE) -> DataFrame:
    """Rows whose key falls into the given share of the key space, at most ``cap`` of them."""
    return take_smallest(df.where(key < int(share * space)), cap, key, space)


def sample_n(df: DataFrame, n: int, key: Column, space: int = HASH_SPACE) -> DataFrame:
    return take_smallest(df, n, key, space)


def stratified_sample(df: DataFrame, stratum: str, n: int, key: Column, space: int = HASH_SPACE) -> DataFrame:
    """Proportional sample: at least one row per stratum, topped up or trimmed to ``n`` rows.

    ``n <= 0`` or a frame of at most ``n`` rows keeps everything.
    """
    if n <= 0:
        return df
    cols = df.columns
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("_size"))
    total = sizes.agg(F.sum("_size")).scalar()
    share = F.rint(F.col("_size") * float(n) / total).cast("long")
    base = F.when(total <= n, F.col("_size")).otherwise(
        F.least(F.col("_size"), F.greatest(F.lit(1).cast("long"), share))
    )
    planned = cut_lineage(sizes.select(stratum, base.alias("_base")))
    missing = F.greatest(F.lit(0).cast("long"), F.lit(n) - planned.agg(F.sum("_base")).scalar())
    # The rows that may fill the gap are the next ones of their stratum, so a wider quota holds them all.
    quotas = planned.select(stratum, (F.col("_base") + missing).alias("_quota"))
    wide = take_smallest_by(df, quotas, [stratum], key, space).join(planned, stratum, "inner")
    # From here on at most n rows plus a few per stratum are left; copies are one row with their count.
    folded = wide.groupBy(*cols, "_base").agg(F.count(F.lit(1)).alias("_c")).withColumn("_k", key.cast("long"))
    folded = cut_lineage(folded)
    turned = preceding(folded, [stratum], ["_k", *[c for c in cols if c != stratum]], "_c")
    own = F.greatest(F.lit(0).cast("long"), F.least(F.col("_c"), F.col("_base") - F.col("_before")))
    halves = F.array(
        F.struct(F.lit(0).alias("turn"), own.alias("m")), F.struct(F.lit(1).alias("turn"), (F.col("_c") - own).alias("m"))
    )
    split = turned.select(*cols, "_k", F.explode(F.filter(halves, lambda half: half["m"] > 0)).alias("_half"))
    split = split.select(*cols, "_k", F.col("_half.turn").alias("_turn"), F.col("_half.m").alias("_m"))
    ranked = preceding(split, [], ["_turn", "_k", *cols], "_m")
    return _repeated(ranked, F.least(F.col("_m"), F.lit(n) - F.col("_before"))).select(*cols)
