"""Temperature mixing: sources at target weights, realised as budgeted block permutations."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

EXPONENT_BITS = 20
BITS_A_PASS = 5
KEY_BITS = 52
SLICE_BITS = 10


def n_words(text: Column) -> Column:
    """Runs of characters that are not ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def order_key(doc_id: Column, epoch: Column, seed: int) -> Column:
    """KEY_BITS bits of md5 over id, epoch and seed: every epoch is a permutation of its own."""
    named = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), epoch.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def _bisect(holds: Callable[[list[float]], list[bool]]) -> float:
    """The largest dyadic exponent in [0, 1] that holds; bisection, several bits to a pass over the shares."""
    low, width = 0, 1 << EXPONENT_BITS
    if holds([1.0])[0]:
        return 1.0
    while width > 1:
        step = max(1, width >> BITS_A_PASS)
        grid = list(range(low + step, low + width, step))
        for point, held in zip(grid, holds([g / (1 << EXPONENT_BITS) for g in grid]), strict=True):
            if not held:
                break
            low = point
        width = step
    return low / (1 << EXPONENT_BITS)


def exponent(shares: DataFrame, entropy: float | None = None, repetitions: float | None = None) -> float:
    """The exponent of the shares ``p`` that meets the target.

    entropy: the largest exponent whose weights have at least that fraction of the greatest possible
    entropy. repetitions: the smallest whose weights repeat no source more than so many times as often
    as the largest one.
    """
    log_p = F.log("p")
    n, least, most = shares.agg(F.count("*"), F.min("p"), F.max("p")).first()
    if n < 2:
        return 1.0

    def evened(exponents: list[float]) -> list[bool]:
        sums = [x for a in exponents for x in (F.sum(F.exp(log_p * a)), F.sum(F.exp(log_p * a) * log_p))]
        row = shares.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()
        pairs = zip(exponents, row[0::2], row[1::2], strict=True)
        return [math.log(z) - a * s / z >= entropy * math.log(n) for a, z, s in pairs]

    def repeated(exponents: list[float]) -> list[bool]:
        return [(least / most) ** (-(1 - a)) <= repetitions for a in (1 - x for x in exponents)]

    return _bisect(evened) if entropy is not None else 1 - _bisect(repeated)


def mixing_plan(
    docs: DataFrame,
    entropy: float | None = None,
    repetitions: float | None = None,
    budget: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 1,
) -> DataFrame:
    """A row for each source: tokens, weight, budget, whole epochs and the key where the last epoch ends.

    With an entropy target the budget is the corpus's own number of tokens unless one is given. With a
    repetition limit it is what lets the largest source be read once, so no document is left out. The
    documents of the last epoch are those of the lowest keys whose tokens fit into what is left of the
    budget; equal keys stand or fall together. A null source is a source like any other; one without
    tokens is read once. Whatever the size of a source, only sums of slices of keys meet in one task.
    """
    if (entropy is None) == (repetitions is None):
        raise ValueError("give either entropy or repetitions")
    rows = saved(
        docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("src"), n_words(F.col(f"`{text}`")).alias("n")),
        "mixing-rows",
    )
    sums = saved(rows.groupBy("src").agg(F.sum("n").alias("tokens")), "mixing-sources")
    total, most = sums.agg(F.sum("tokens"), F.max("tokens")).first()
    shares = sums.filter("tokens > 0").withColumn("p", F.col("tokens") / F.lit(total or 1))
    power = exponent(shares, entropy, repetitions) if total else 1.0
    tempered = F.when(F.col("tokens") > 0, F.exp(F.log(F.col("tokens") / F.lit(total or 1)) * power)).otherwise(0.0)
    sums = sums.withColumn("tempered", tempered)
    norm = sums.agg(F.sum("tempered")).first()[0] or 1.0
    weighted = sums.withColumn("weight", F.col("tempered") / norm).drop("tempered")
    if budget is None and repetitions is not None and total:
        budget = math.ceil(most / (math.exp(math.log(most / total) * power) / norm))
    budget = budget if budget is not None else total or 0
    # A millionth keeps an exact whole number of tokens, such as the largest source's, from rounding down.
    granted = F.floor(F.col("weight") * budget + 1e-6)
    sized = weighted.withColumn("budget", F.when(F.col("tokens") > 0, granted).otherwise(0))
    sized = sized.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1))
    sized = saved(
        sized.withColumn("left", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(0)),
        "mixing-budgets",
    )
    cut = _cut(rows, sized, seed)
    return saved(
        sized.join(cut, F.col("src").eqNullSafe(F.col("cut_src")), "left").select(
            "src", "tokens", "weight", "budget", "epochs", F.coalesce("key_end", F.lit(0)).alias("key_end")
        ),
        "mixing-plan",
    )


def _cut(rows: DataFrame, sized: DataFrame, seed: int) -> DataFrame:
    """(cut_src, key_end): keys below key_end are in the last epoch, found slice by slice."""
    wanted = sized.filter("left > 0").select(F.col("src").alias("of"), F.col("epochs"), F.col("left"))
    keyed = rows.join(wanted, F.col("src").eqNullSafe(F.col("of"))).select(
        "src", "left", "n", order_key(F.col("id"), F.col("epochs"), seed).alias("key")
    )
    keyed = saved(keyed, "mixing-keys")
    base = keyed.select("src", "n", "key", F.lit(0).cast("long").alias("before"), "left")
    for shift in (KEY_BITS - SLICE_BITS, KEY_BITS - 2 * SLICE_BITS, 0):
        slices = base.groupBy("src", "left", "before", F.shiftright("key", shift).alias("slice")).agg(F.sum("n").alias("n"))
        running = Window.partitionBy("src").orderBy("slice")
        upto = slices.withColumn("upto", F.col("before") + F.sum("n").over(running))
        edge = upto.filter(F.col("upto") > F.col("left")).groupBy("src").agg(
            F.min("slice").alias("edge"), F.min_by(F.col("upto") - F.col("n"), "slice").alias("start")
        )
        edge = saved(edge.withColumnRenamed("src", "edge_src"), "mixing-edges")
        same = F.col("src").eqNullSafe(F.col("edge_src")) & (F.shiftright("key", shift) == F.col("edge"))
        base = base.join(edge, same).select("src", "n", "key", F.col("start").alias("before"), "left")
    return edge.select(F.col("edge_src").alias("cut_src"), F.col("edge").alias("key_end"))


def realised(
    docs: DataFrame, plan: DataFrame, doc_id: str = "doc_id", source: str = "source", seed: int = 1
) -> DataFrame:
    """Each input row as ``row``, once for every epoch that has it, with epoch, key and block.

    Ordered by (epoch, key) the rows of a source are its permutations one after another; the block is
    the leading bits of the key.
    """
    packed = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    joined = packed.join(plan, F.col(f"row.`{source}`").eqNullSafe(F.col("src")))
    number = F.col(f"row.`{doc_id}`")
    extra = (order_key(number, F.col("epochs"), seed) < F.col("key_end")).cast("long")
    copies = joined.withColumn("copies", F.col("epochs") + extra).filter("copies > 0")
    told = copies.select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("epoch"))
    key = order_key(number, F.col("epoch"), seed)
    return told.select("row", "epoch", key.alias("key")).withColumn("block", F.shiftright("key", KEY_BITS - SLICE_BITS))


def mixed(docs: DataFrame, repetitions: float = 1.5, **columns: str) -> DataFrame:
    """The input's rows with small sources repeated up to the limit; every row stays at least once."""
    plan = mixing_plan(docs, repetitions=repetitions, **columns)
    names = {k: v for k, v in columns.items() if k in ("doc_id", "source")}
    return realised(docs, plan, **names).select("row.*")
