"""Anomalous trips: statistics, two forests, thresholds, flags and summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrace.operators import anomaly, iforest, prepare
from citytrace.operators.lookup import as_list
from citytrace.session import cut_lineage
from citytrace.sources.artifacts import check_inputs
from citytrace.sources.sinks import save_tables, write_rows, write_summary


@dataclass(frozen=True)
class AnomalyConfig:
    target_rate: float = anomaly.TARGET_RATE
    forest: iforest.ForestConfig = iforest.ForestConfig()


def score_both(features: DataFrame, forests: dict[str, DataFrame]) -> DataFrame:
    speed = iforest.score_iforest(features, forests["speed"], anomaly.SPEED_FEATURES, "speed_anomaly_score")
    return iforest.score_iforest(speed, forests["fare"], anomaly.FARE_FEATURES, "fare_anomaly_score")


def _summary(flagged: DataFrame, zones: DataFrame, kind: str, rows: DataFrame):
    flag, _ = anomaly.KINDS[kind]
    pair = [F.col("source_id"), F.col("destination_id")]
    return F.struct(
        as_list(anomaly.hourly_variation(flagged, flag), F.col("pickup_hour")).alias("hourly_variation"),
        as_list(anomaly.top_anomaly_pairs(flagged, flag, zones), -F.col("anomaly_frequency"), *pair).alias("top_od_pairs"),
        as_list(anomaly.top_anomalies(rows, kind), -F.col("anomaly_score"), F.col("pickup_timestamp"), *pair).alias("top_10_records"),
    ).alias(kind)


def run_anomaly(
    trips: DataFrame,
    zones: DataFrame,
    out: str,
    config: AnomalyConfig = AnomalyConfig(),
    forests: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The whole product. All trips are scored in one pass; what follows reads the written scores.

    ``forests`` are those of an earlier run (``models/speed`` and ``models/fare``), in place of new ones.
    """
    spark = trips.sparkSession
    check_inputs({"trips": trips, "zones": zones})
    prepared = cut_lineage(prepare.prepare_anomaly(trips))
    counts = cut_lineage(anomaly.fare_counts(prepared))
    stats = {
        "context_stats": anomaly.context_stats(counts),
        "route_stats": anomaly.route_stats(counts),
        "global_stats": anomaly.global_stats(counts),
        "fill_medians": prepare.medians(prepare.rate_features(prepared), anomaly.RATE_COLUMNS),
    }
    save_tables(stats, f"{out}/bundle")
    stats = {name: spark.read.parquet(f"{out}/bundle/{name}") for name in stats}
    tables = [stats[f"{name}_stats"] for name in ("context", "route", "global")]

    features = anomaly.anomaly_features(prepared, *tables, fills=stats["fill_medians"])
    if not forests:  # two fits and the scoring read them; given forests only score
        features = cut_lineage(features)
    check_inputs({"training rows": features})
    # Only the rows of each tree are drawn, from all trips: that is the algorithm, not a cut of it.
    forests = forests or {
        "speed": iforest.fit_iforest(features, anomaly.SPEED_FEATURES, config.forest),
        "fare": iforest.fit_iforest(features, anomaly.FARE_FEATURES, config.forest),
    }
    save_tables(forests, f"{out}/models")
    forests = {name: spark.read.parquet(f"{out}/models/{name}") for name in forests}
    scored = cut_lineage(score_both(features, forests))
    thresholds = {
        "speed_thresholds": anomaly.calibrate_speed(scored, config.target_rate),
        "fare_thresholds": anomaly.calibrate_fare(scored, config.target_rate),
    }
    save_tables(thresholds, f"{out}/bundle")
    thresholds = {name: spark.read.parquet(f"{out}/bundle/{name}") for name in thresholds}
    # Two comparisons a row beside the written scores, so the trips are not written once more.
    flagged = anomaly.flag_fare(anomaly.flag_speed(scored, thresholds["speed_thresholds"]), thresholds["fare_thresholds"])
    rows = {}
    for kind in anomaly.KINDS:
        write_rows(anomaly.anomaly_rows(flagged, kind, zones), f"{out}/outputs/{kind}", "parquet")
        rows[kind] = spark.read.parquet(f"{out}/outputs/{kind}")
    used = F.struct(
        as_list(thresholds["speed_thresholds"], F.col("pickup_hour")).alias("speed_by_hour"),
        as_list(thresholds["fare_thresholds"], F.col("score_quantile")).alias("fare"),
        F.lit(config.target_rate).alias("target_rate"),
        F.lit(config.forest.trees).alias("trees"),
        F.lit(config.forest.max_samples).alias("max_samples"),
    )
    summary = anomaly.anomaly_totals(flagged).select(
        "*", *[_summary(flagged, zones, kind, rows[kind]) for kind in anomaly.KINDS], used.alias("thresholds")
    )
    write_summary(summary, f"{out}/anomaly_summary")
    return {"summary": spark.read.json(f"{out}/anomaly_summary"), "flagged": flagged, **rows, **thresholds}
