"""Exact interpolated quantiles per group that hold when one group owns most of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citytrace.functions import numeric
from citytrace.session import cut_lineage


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Rows per (keys, value) as ``weight`` column ``_n``; NULL keys, NULL and NaN values are left out.

    A written count table serves the quantiles of its keys and of any part of them.
    """
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    typed = df.select(*keys, F.col(value).cast("double").alias("_v"), *([weight] if weight else []))
    # The key filter is what the joins below would infer; stated here, all branches share one exchange.
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, "_v")])
    kept = typed.where(present & ~F.isnan("_v"))
    return kept.groupBy(*keys, "_v").agg(rows.alias("_n"))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    count_as: str | None = None,
    weight: str | None = None,
    folded: bool = False,
) -> DataFrame:
    """Linear-interpolation quantiles of the non-NULL values, one column per entry of ``probs``.

    Values are counted per (keys, value) first, so copies fold on the map side. The counts are dealt
    by range of (keys, value), which gives every task an equal share whatever the keys and values are,
    and written once. Sums per task and key tell which task holds a wanted rank; only those tasks' values
    of that key are ordered. ``weight`` names a column with the number of rows each row stands for;
    ``folded`` says that these are value counts of the same keys, which are not counted once more.
    Runs Spark jobs.
    """
    if folded:
        counted = df.select(*keys, F.col(value).cast("double").alias("_v"), F.col(weight).alias("_n"))
    else:
        counted = value_counts(df, keys, value, weight)
    return _ranked(counted, list(keys), probs, count_as)


def stacked_quantiles(
    df: DataFrame, measures: Mapping[str, Mapping[str, float]], group: str | None = None
) -> DataFrame:
    """Quantiles of several measures in one call: a row per group, and one of all rows with group NULL.

    ``measures`` maps a column to its named probabilities; the names are the result's columns. Rows are
    counted by coarse slices of their values, of which a group has some thousands at most; only values of
    slices with a wanted rank travel. A slice that holds most values is dealt to all tasks. The frame is
    read twice. Runs Spark jobs.
    """
    own = F.col(group).cast("int") if group else F.lit(None).cast("int")
    entries = [F.struct(F.lit(m).alias("_measure"), own.alias("_of"), F.col(m).cast("double").alias("_v")) for m in measures]
    rows = df.select(F.inline(F.array(*entries))).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rows = rows.withColumn("_coarse", _coarse(F.col("_v")))
    names = {name: p for probs in measures.values() for name, p in probs.items()}
    keys = ["_measure", "_own", "_group"]
    # A row for its group and one for all rows; the second comes from the counts of the first.
    place = lambda own, of: F.struct(F.lit(own).alias("_own"), of.alias("_group"))
    both = F.array(place(False, F.lit(0)), place(True, F.col("_of")))
    slices = (
        rows.groupBy("_measure", "_of", "_coarse")
        .agg(F.count(F.lit(1)).alias("_m"))
        .select("_measure", "_coarse", "_m", F.inline(F.filter(both, lambda g: g["_group"].isNotNull())))
        .groupBy(*keys, "_coarse")
        .agg(F.sum("_m").alias("_m"))
    )
    wanted = _wanted(slices, keys, "_coarse", names).withColumnRenamed("_below", "_under")
    entry = F.struct("_own", "_group", "_under", "_total")
    # Few slices, written so that their size is known: rows outside them go no further.
    kept = cut_lineage(wanted.groupBy("_measure", "_coarse").agg(F.collect_list(entry).alias("_entries")))
    mine = F.filter("_entries", lambda e: ~e["_own"] | F.coalesce(e["_group"] == F.col("_of"), F.lit(False)))
    picked = rows.join(kept, ["_measure", "_coarse"]).select("_measure", "_coarse", "_v", F.inline(mine))
    counted = picked.groupBy(*keys, "_coarse", "_under", "_total", "_v").agg(F.count(F.lit(1)).alias("_n"))
    found = _ranked(counted, keys, names, None, coarse=True)
    of = {name: m for m, probs in measures.items() for name in probs}
    pick = [F.max(F.when(F.col("_measure") == of[name], F.col(name))).alias(name) for name in names]
    key = F.when(F.col("_own"), F.col("_group"))
    return found.groupBy("_own", "_group").agg(*pick).select(key.alias(group or "_group"), *names)


def _coarse(value: Column) -> Column:
    """An order-preserving slice of a number: sign, power of two and a 256th of it."""
    size = lambda x: F.floor(F.least(F.log2(x), F.lit(2000.0)) * 256) + 300_000
    return F.when(value > 0, size(value)).when(value < 0, -size(-value)).otherwise(F.lit(0).cast("long"))


def _position(p: float) -> Column:
    return (F.col("_total") - 1) * float(p)


def _wanted(slices: DataFrame, keys: list[str], slice_: str, probs: Mapping[str, float], part: Sequence[str] = ()) -> DataFrame:
    """The slices that hold a wanted rank, with the rows below them, those of the group and the ranks.

    ``part`` are keys of a part of a group, whose slices know the rows under it (``_under``) and ``_total``.
    """
    group = Window.partitionBy(*keys, *part)
    upto = F.sum("_m").over(group.orderBy(slice_).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total, under = (F.col("_total"), F.col("_under")) if part else (F.sum("_m").over(group), F.lit(0).cast("long"))
    placed = slices.select(
        *keys, *part, slice_, "_m", (under + upto - F.col("_m")).alias("_below"), total.alias("_total")
    )
    ranks = [
        F.struct(F.lit(name).alias("q"), F.lit(side).alias("side"), turn(_position(p)).cast("long").alias("rank"))
        for name, p in probs.items()
        for side, turn in (("lo", F.floor), ("hi", F.ceil))
    ]
    inside = lambda r: (r["rank"] >= F.col("_below")) & (r["rank"] < F.col("_below") + F.col("_m"))
    return placed.withColumn("_ranks", F.filter(F.array(*ranks), inside)).where(F.size("_ranks") > 0).drop("_m")


def _ranked(
    counted: DataFrame, keys: list[str], probs: Mapping[str, float], count_as: str | None, coarse: bool = False
) -> DataFrame:
    """Quantiles of value counts; ``coarse`` ones are parts of their groups, as ``stacked_quantiles`` leaves them."""
    part = ["_coarse"] if coarse else []
    known = ["_under", "_total"] if coarse else []
    dealt = counted.repartitionByRange(*keys, "_v").withColumn("_slice", F.spark_partition_id())
    sliced = cut_lineage(dealt)
    # Per group at most as many slices as there are tasks.
    slices = sliced.groupBy(*keys, *part, "_slice").agg(F.sum("_n").alias("_m"), *[F.max(c).alias(c) for c in known])
    wanted = _wanted(slices, keys, "_slice", probs, part)
    picked = sliced.drop(*known).join(wanted, [*keys, *part, "_slice"], "inner")
    running = F.sum("_n").over(
        Window.partitionBy(*keys, *part, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    hits = (
        picked.withColumn("_end", F.col("_below") + running)
        .select(*keys, "_v", "_n", "_end", "_total", F.explode("_ranks").alias("_r"))
        .where((F.col("_r.rank") < F.col("_end")) & (F.col("_r.rank") >= F.col("_end") - F.col("_n")))
    )
    at = lambda name, side: F.max(F.when((F.col("_r.q") == name) & (F.col("_r.side") == side), F.col("_v")))
    ends = hits.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[at(name, side).alias(f"_{side}_{name}") for name in probs for side in ("lo", "hi")],
    )

    def blend(name: str, p: float) -> Column:
        low, high, pos = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), _position(p)
        return F.when(low == high, low).otherwise(
            numeric.weighted_sum(low, F.ceil(pos) - pos, high, pos - F.floor(pos))
        )

    return ends.select(
        *keys,
        *([F.col("_total").alias(count_as)] if count_as else []),
        *[blend(name, p).alias(name) for name, p in probs.items()],
    )
