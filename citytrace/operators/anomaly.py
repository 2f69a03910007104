"""Fare context statistics, thresholds, flags and summaries of anomalous trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citytrace.functions import numeric, times
from citytrace.operators import prepare
from citytrace.operators.lookup import attach_context, attach_hour_threshold, with_labels, with_row
from citytrace.operators.quantiles import exact_quantiles, stacked_quantiles, value_counts
from citytrace.session import cut_lineage

TARGET_RATE = 0.01
# The model inputs, in model order.
SPEED_FEATURES = (
    "speed_mph",
    "trip_distance_miles",
    "eta_minutes",
    "fare_amount",
    "fare_per_mile",
    "pickup_hour",
    "day_of_week",
    "is_weekend",
    "pickup_hour_sin",
    "pickup_hour_cos",
)
FARE_FEATURES = (
    "fare_amount",
    "trip_distance_miles",
    "eta_minutes",
    "fare_per_mile",
    "fare_per_minute",
    "pickup_hour",
    "day_of_week",
    "is_weekend",
    "context_median_fare",
    "context_iqr_fare",
    "context_count_log1p",
    "fare_to_context_median_ratio",
    "pickup_hour_sin",
    "pickup_hour_cos",
)
RATE_COLUMNS = ("trip_distance_miles", "fare_amount", "eta_minutes", "speed_mph", "fare_per_mile", "fare_per_minute")

# Calibration grids.
SPEED_SCORE_Q = (0.98, 0.985, 0.99)
SPEED_MPH_Q = (0.99, 0.995, 0.997)
FARE_SCORE_Q = (0.98, 0.985, 0.99)
FARE_IQR_MULTIPLIERS = (1.5, 2.0, 2.5, 3.0)
FARE_RATIO_Q = (0.97, 0.98, 0.99)
CONTEXT_KEYS = ("source_id", "destination_id", "pickup_hour", "is_weekend")
QUARTILES = {"fare_q1": 0.25, "fare_median": 0.5, "fare_q3": 0.75}
KINDS = {
    "extreme_speed": ("is_extreme_speed_anomaly", "speed_anomaly_score"),
    "fare_outlier": ("is_fare_outlier_anomaly", "fare_anomaly_score"),
}


def fare_counts(df: DataFrame) -> DataFrame:
    """Trips per context and fare. Written once, it serves all three statistics below."""
    counts = value_counts(df, CONTEXT_KEYS, "fare_amount")
    return counts.withColumnsRenamed({"_v": "fare_amount", "_n": "trips"})


def _fare_stats(df: DataFrame, keys: Sequence[str], prefix: str, count_as: str, folded: bool = False) -> DataFrame:
    """Count and quartiles of trips, or of a fare count table."""
    probs = {f"{prefix}_{name}": p for name, p in QUARTILES.items()}
    weight = "trips" if "trips" in df.columns else None
    return exact_quantiles(df, keys, "fare_amount", probs, count_as, weight, folded)


def context_stats(df: DataFrame) -> DataFrame:
    return _fare_stats(df, CONTEXT_KEYS, "context", "context_trip_count", folded="trips" in df.columns)


def route_stats(df: DataFrame) -> DataFrame:
    return _fare_stats(df, CONTEXT_KEYS[:2], "route", "route_trip_count")


def global_stats(df: DataFrame) -> DataFrame:
    """One row over all trips; the count is at least 1."""
    stats = _fare_stats(df, (), "global", "global_context_count")
    count = F.coalesce("global_context_count", F.lit(1).cast("long"))
    return stats.withColumn("global_context_count", count)


def context_features(df: DataFrame) -> DataFrame:
    """Spread, log count and fare ratio of the attached context."""
    median = F.col("context_fare_median")
    spread = numeric.at_least(F.col("context_fare_q3") - F.col("context_fare_q1"), 0.0)
    return df.withColumns(
        {
            "context_iqr_fare": spread,
            "context_median_fare": median,
            "context_count_log1p": F.log1p(F.col("context_trip_count").cast("double")),
            "fare_to_context_median_ratio": F.col("fare_amount") / numeric.at_least(median, 0.1),
        }
    )


def anomaly_features(
    prepared: DataFrame, context: DataFrame, route: DataFrame, overall: DataFrame, fills: DataFrame | None = None
) -> DataFrame:
    """All inputs of both models. ``fills`` are training-time medians for non-finite measures."""
    rated = prepare.rate_features(prepared)
    if fills is not None:
        rated = prepare.impute(rated, fills, RATE_COLUMNS)
    return prepare.hour_cycle(context_features(attach_context(rated, context, route, overall)))


def _best(rates: DataFrame, combos: Column, target: float) -> DataFrame:
    """The grid entry whose rate is nearest the target, the first one in grid order on ties."""
    gap = F.transform("_combos", lambda c: F.struct(F.abs(c["rate"] - target).alias("gap"), c.alias("combo")))
    return rates.select(combos.alias("_combos")).select(F.array_min(gap)["combo"].alias("c"))


def calibrate_speed(scored: DataFrame, target: float = TARGET_RATE) -> DataFrame:
    """Thresholds of score and speed per hour, 24 rows.

    All quantiles, per hour and of all rows, come from one call; one further pass rates all nine
    combinations. The frame is read twice, so pass a written one.
    """
    score_q = {f"s{i}": q for i, q in enumerate(SPEED_SCORE_Q)}
    speed_q = {f"m{i}": q for i, q in enumerate(SPEED_MPH_Q)}
    measures = {"speed_anomaly_score": score_q, "speed_mph": speed_q}
    found = cut_lineage(stacked_quantiles(scored, measures, "pickup_hour"))
    hourly, overall = found.where(F.col("pickup_hour").isNotNull()), found.where(F.col("pickup_hour").isNull())
    # 24 hours at most, so the broadcast is bounded by the key.
    rows = scored.select("pickup_hour", "speed_anomaly_score", "speed_mph").join(
        F.broadcast(hourly), "pickup_hour", "inner"
    )
    flag = lambda s, m: (F.col("speed_anomaly_score") >= F.col(s)) & (F.col("speed_mph") >= F.col(m))
    grid = [(s, m) for s in score_q for m in speed_q]
    rates = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(flag(s, m)).alias(s + m) for s, m in grid])
    combos = F.array(
        *[
            F.struct(
                F.lit(order).alias("order"),
                F.lit(s).alias("s"),
                F.lit(m).alias("m"),
                F.lit(score_q[s]).alias("score_quantile"),
                F.lit(speed_q[m]).alias("speed_quantile"),
                (F.col(s + m).cast("double") / F.col("_n")).alias("rate"),
            )
            for order, (s, m) in enumerate(grid)
        ]
    )
    hours = scored.sparkSession.range(24).select(F.col("id").cast("int").alias("pickup_hour"))
    rows = hours.join(hourly, "pickup_hour", "left").withColumn("_best", _best(rates, combos, target).scalar())
    rows = with_row(rows, overall.select(*score_q), "_score")
    rows = with_row(rows, overall.select(*speed_q), "_mph")
    chosen = lambda name, options, of: F.coalesce(*[F.when(F.col(f"_best.{name}") == o, F.col(of(o))) for o in options])
    return rows.select(
        "pickup_hour",
        times.hour_label(F.col("pickup_hour")).alias("hour_label"),
        chosen("s", score_q, str).alias("speed_score_threshold"),
        chosen("m", speed_q, str).alias("speed_mph_threshold"),
        "_best.score_quantile",
        "_best.speed_quantile",
        F.col("_best.rate").alias("estimated_anomaly_rate"),
        chosen("s", score_q, "_score.{}".format).alias("global_speed_score_threshold"),
        chosen("m", speed_q, "_mph.{}".format).alias("global_speed_mph_threshold"),
    ).withColumns({n: F.coalesce(n, f"global_{n}") for n in ("speed_score_threshold", "speed_mph_threshold")})


def calibrate_fare(scored: DataFrame, target: float = TARGET_RATE) -> DataFrame:
    """The one-row fare threshold: score, spread multiplier and ratio, chosen from 36 combinations.

    The frame is read twice, so pass a written one.
    """
    score_q = {f"s{i}": q for i, q in enumerate(FARE_SCORE_Q)}
    ratio_q = {f"r{i}": q for i, q in enumerate(FARE_RATIO_Q)}
    measures = ("fare_amount", "context_fare_median", "context_iqr_fare")
    rows = scored.select(*measures, "fare_anomaly_score", "fare_to_context_median_ratio")
    found = cut_lineage(
        stacked_quantiles(scored, {"fare_anomaly_score": score_q, "fare_to_context_median_ratio": ratio_q})
    )
    rows = with_row(rows, found.select(*score_q), "_score")
    rows = with_row(rows, found.select(*ratio_q), "_ratio")
    scores = {s: F.col(f"_score.{s}") for s in score_q}
    ratios = {r: F.col(f"_ratio.{r}") for r in ratio_q}
    above = lambda k: F.col("fare_amount") >= F.col("context_fare_median") + F.col("context_iqr_fare") * k
    flag = lambda s, k, r: (
        (F.col("fare_anomaly_score") >= scores[s])
        & above(k)
        & (F.col("fare_to_context_median_ratio") >= ratios[r])
    )
    grid = [(s, i, r) for s in score_q for i in range(len(FARE_IQR_MULTIPLIERS)) for r in ratio_q]
    name = lambda s, i, r: f"{s}k{i}{r}"
    rates = rows.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.any_value(c).alias(n) for n, c in (scores | ratios).items()],
        *[F.count_if(flag(s, FARE_IQR_MULTIPLIERS[i], r)).alias(name(s, i, r)) for s, i, r in grid],
    )
    combos = F.array(
        *[
            F.struct(
                F.lit(order).alias("order"),
                F.lit(score_q[s]).alias("score_quantile"),
                F.col(s).alias("score_threshold"),
                F.lit(FARE_IQR_MULTIPLIERS[i]).alias("iqr_multiplier"),
                F.lit(ratio_q[r]).alias("ratio_quantile"),
                F.col(r).alias("ratio_threshold"),
                (F.col(name(s, i, r)).cast("double") / F.col("_n")).alias("rate"),
            )
            for order, (s, i, r) in enumerate(grid)
        ]
    )
    return _best(rates, combos, target).select(
        "c.score_quantile",
        "c.score_threshold",
        "c.iqr_multiplier",
        "c.ratio_quantile",
        "c.ratio_threshold",
        F.col("c.rate").alias("estimated_anomaly_rate"),
    )


def flag_speed(scored: DataFrame, thresholds: DataFrame) -> DataFrame:
    flag = (F.col("speed_anomaly_score") >= F.col("speed_score_threshold")) & (
        F.col("speed_mph") >= F.col("speed_mph_threshold")
    )
    return attach_hour_threshold(scored, thresholds).withColumn("is_extreme_speed_anomaly", flag)


def flag_fare(scored: DataFrame, threshold: DataFrame) -> DataFrame:
    upper = F.col("context_median_fare") + F.col("_t.iqr_multiplier") * F.col("context_iqr_fare")
    flag = (
        (F.col("fare_anomaly_score") >= F.col("_t.score_threshold"))
        & (F.col("fare_amount") >= F.col("context_upper_fare_threshold"))
        & (F.col("fare_to_context_median_ratio") >= F.col("_t.ratio_threshold"))
    )
    rows = with_row(scored, threshold, "_t").withColumn("context_upper_fare_threshold", upper)
    return rows.withColumn("is_fare_outlier_anomaly", flag).drop("_t")


def hourly_variation(flagged: DataFrame, flag: str) -> DataFrame:
    """24 rows: trips, anomalies and their percentage per pickup hour."""
    counts = flagged.groupBy("pickup_hour").agg(
        F.count(F.lit(1)).alias("_total"), F.count_if(F.col(flag)).alias("_hits")
    )
    hours = flagged.sparkSession.range(24).select(F.col("id").cast("int").alias("pickup_hour"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return hours.join(counts, "pickup_hour", "left").select(
        "pickup_hour",
        times.hour_label(F.col("pickup_hour")).alias("hour_label"),
        zero("_total").alias("total_records"),
        zero("_hits").alias("anomaly_count"),
        numeric.percent(zero("_hits"), zero("_total"), 4).alias("anomaly_percentage"),
    )


def top_anomaly_pairs(flagged: DataFrame, flag: str, zones: DataFrame, k: int = 10) -> DataFrame:
    top = (
        flagged.where(F.col(flag))
        .groupBy("source_id", "destination_id")
        .agg(F.count(F.lit(1)).alias("anomaly_frequency"))
        .orderBy(F.desc("anomaly_frequency"), "source_id", "destination_id")
        .limit(k)
    )
    return with_labels(top, zones).select(
        "source_id",
        "destination_id",
        F.col("origin_label").alias("origin"),
        F.col("destination_label").alias("destination"),
        "anomaly_frequency",
    ).orderBy(F.desc("anomaly_frequency"), "source_id", "destination_id")


def anomaly_rows(flagged: DataFrame, kind: str, zones: DataFrame) -> DataFrame:
    """Anomalies of one kind in the published 15 columns."""
    flag, score = KINDS[kind]
    return with_labels(flagged.where(F.col(flag)), zones).select(
        F.date_format("pickup_timestamp", "yyyy-MM-dd HH:mm:ss").alias("pickup_timestamp"),
        "pickup_hour",
        "source_id",
        "destination_id",
        "origin_label",
        "destination_label",
        "fare_amount",
        "trip_distance_miles",
        "eta_minutes",
        "speed_mph",
        "fare_to_context_median_ratio",
        "context_median_fare",
        "context_iqr_fare",
        F.col(score).alias("anomaly_score"),
        F.lit(kind).alias("anomaly_type"),
    )


def top_anomalies(rows: DataFrame, kind: str, k: int = 10) -> DataFrame:
    """Highest scores first, ties by the trip's own columns, rounded as published."""
    digits = {"fare_amount": 2, "trip_distance_miles": 3, "eta_minutes": 2, "anomaly_score": 6}
    if kind == "extreme_speed":
        digits["speed_mph"] = 2
    else:
        digits |= {"fare_to_context_median_ratio": 3, "context_median_fare": 2, "context_iqr_fare": 2}
    ties = ("pickup_timestamp", "source_id", "destination_id", "fare_amount", "trip_distance_miles", "eta_minutes")
    top = rows.orderBy(F.desc("anomaly_score"), *ties).limit(k)
    return top.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


def anomaly_totals(flagged: DataFrame) -> DataFrame:
    """One row: valid trips, and anomalies of both kinds with their percentage."""
    counts = flagged.agg(
        F.count(F.lit(1)).alias("total_valid_records"),
        *[F.count_if(F.col(flag)).alias(f"{kind}_records") for kind, (flag, _) in KINDS.items()],
    )
    total = F.col("total_valid_records")
    return counts.select(
        "*", *[numeric.percent(F.col(f"{kind}_records"), total, 4).alias(f"{kind}_percentage") for kind in KINDS]
    )
