"""Every checked query: one per operator, over the whole driver tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrace.functions import bins, numeric, times
from citytrace.operators import (
    anomaly,
    clean,
    cluster,
    flow,
    forecast,
    hulls,
    iforest,
    lookup,
    prepare,
    rules,
    sampling,
    stats,
)
from citytrace.operators.boosting import Boosted
from citytrace.plans import anomalies
from citytrace.session import checkpoint_dir
from verification.tables import (
    FIXED_ROWS,
    FIXED_TREES,
    KEY_SPACE,
    checked,
    coords,
    fixed_tree,
    raw_trips,
    row_key,
    trips,
    written,
    zones,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

WINDOW = (dt.date(1996, 3, 1), dt.date(1999, 8, 31))
HOURS = (7, 21)
ENDS = ["source_id", "destination_id"]


def query(make: Query) -> Query:
    REGISTRY[make.__name__] = lambda spark, sf_dir: checked(make(spark, sf_dir))
    return make


def _renamed(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"pickup_location_id": "source_id", "dropff_location_id": "destination_id"})


# ---- cleaning and preparation ----


@query
def clean_trips(spark, sf):
    return clean.clean_trips(raw_trips(spark, sf))


@query
def prepare_anomaly(spark, sf):
    return prepare.rate_features(prepare.prepare_anomaly(trips(spark, sf)))


@query
def prepare_forecast(spark, sf):
    return prepare.prepare_forecast(trips(spark, sf))


@query
def prepare_rules(spark, sf):
    return prepare.prepare_rules(trips(spark, sf), zones(spark, sf))


@query
def impute_median(spark, sf):
    ends = F.col("pickup_location_id")
    holes = F.when(ends % 7 == 0, F.lit(float("inf"))).when(ends % 11 != 0, F.col("fare_amount"))
    df = trips(spark, sf).select("pickup_location_id", "pickup_date", "pickup_time", holes.alias("fare_amount"))
    return prepare.impute_median(df, ["fare_amount"])


@query
def hour_cycle(spark, sf):
    return (
        prepare.hour_cycle(prepare.prepare_anomaly(trips(spark, sf)))
        .groupBy("pickup_hour", "pickup_hour_sin", "pickup_hour_cos")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query
def known_boroughs(spark, sf):
    return prepare.known_boroughs(zones(spark, sf))


@query
def filter_window(spark, sf):
    return prepare.filter_window(trips(spark, sf), *WINDOW, *HOURS)


@query
def segment_trips(spark, sf):
    return prepare.segment_trips(trips(spark, sf)).select(
        "segment", "pickup_location_id", "dropff_location_id", "pickup_date", "pickup_time"
    )


@query
def numeric_guards(spark, sf):
    """The guards of the boosted models' target: clip, log1p and back, absolute error."""
    fare = F.col("fare_amount")
    held = numeric.clip(fare, 5.0, 60.0)
    back = numeric.at_least(F.expm1(F.log1p(held) + 0.01), 0.0)
    return trips(spark, sf).select(
        "pickup_location_id",
        "dropff_location_id",
        "pickup_date",
        "pickup_time",
        held.alias("held"),
        F.log1p(numeric.finite(F.try_divide(fare, F.col("tip_amount")))).alias("ratio_log1p"),
        back.alias("back"),
        F.abs(fare - back).alias("error"),
    )


# ---- joins ----


@query
def with_zones(spark, sf):
    pairs = _renamed(trips(spark, sf).select("pickup_location_id", "dropff_location_id", "fare_amount"))
    return lookup.with_zones(pairs, zones(spark, sf))


@query
def with_coords(spark, sf):
    pairs = _renamed(trips(spark, sf).select("pickup_location_id", "dropff_location_id", "fare_amount"))
    return lookup.with_coords(pairs, coords(spark, sf), "inner")


@query
def route_distance(spark, sf):
    pairs = _renamed(trips(spark, sf).select("pickup_location_id", "dropff_location_id", "fare_amount"))
    return lookup.route_distance(pairs, coords(spark, sf))


@query
def with_labels(spark, sf):
    pairs = _renamed(trips(spark, sf).select("pickup_location_id", "dropff_location_id"))
    return lookup.with_labels(pairs, zones(spark, sf))


@query
def with_date_dim(spark, sf):
    df = trips(spark, sf)
    return lookup.with_date_dim(df.select("pickup_date", "pickup_time", "fare_amount"), stats.date_dim(df))


def _stats(spark, sf):
    """Fare statistics of all trips, as the job takes them."""
    counts = written(spark, sf, "fare_counts", lambda: anomaly.fare_counts(_prepared(spark, sf)))
    table = lambda make: written(spark, sf, f"prepared_{make.__name__}", lambda: checked(make(counts)))
    return [table(make) for make in (anomaly.context_stats, anomaly.route_stats, anomaly.global_stats)]


def _prepared(spark, sf):
    """Written once: the statistics and the features read it."""
    return written(spark, sf, "prepared", lambda: prepare.prepare_anomaly(trips(spark, sf)))


def _features(spark, sf):
    prepared = _prepared(spark, sf)
    return anomaly.anomaly_features(prepared, *_stats(spark, sf))


@query
def attach_context(spark, sf):
    prepared = _prepared(spark, sf)
    filled = lookup.attach_context(prepared, *_stats(spark, sf))
    return anomaly.context_features(filled).drop("pickup_timestamp", "eta_minutes")


@query
def anomaly_features(spark, sf):
    return _features(spark, sf).select(
        "pickup_timestamp", *ENDS, *dict.fromkeys(anomaly.SPEED_FEATURES + anomaly.FARE_FEATURES)
    )


@query
def od_points(spark, sf):
    return lookup.od_points(trips(spark, sf), coords(spark, sf), keep=["pickup_date", "pickup_time"])


@query
def nearest_borough(spark, sf):
    return cluster.nearest_borough(_points(spark, sf), _centroids(spark, sf))


@query
def unsampled_rows(spark, sf):
    df = trips(spark, sf).select("pickup_location_id", "pickup_date", "pickup_time", "fare_amount", row_key().alias("k"))
    return lookup.unsampled_rows(df, df.where(F.col("k") < KEY_SPACE // 3), ["k"])


@query
def location_catalog(spark, sf):
    return lookup.location_catalog(zones(spark, sf), coords(spark, sf))


# ---- statistics ----


@query
def date_dim(spark, sf):
    return stats.date_dim(trips(spark, sf))


@query
def monthly_counts(spark, sf):
    return stats.monthly_counts(trips(spark, sf), dt.date(1994, 11, 1), dt.date(2001, 12, 31))


@query
def weekday_weekend_avg(spark, sf):
    df = trips(spark, sf)
    return stats.weekday_weekend_avg(df, stats.date_dim(df))


@query
def weekpart_bucket_avg(spark, sf):
    df = trips(spark, sf)
    return stats.weekpart_bucket_avg(df, stats.date_dim(df), *WINDOW)


@query
def weekpart_bucket_pivot(spark, sf):
    df = trips(spark, sf)
    return stats.weekpart_bucket_pivot(stats.weekpart_bucket_avg(df, stats.date_dim(df)))


@query
def kpis(spark, sf):
    return stats.kpis(trips(spark, sf))


@query
def borough_avg(spark, sf):
    return stats.borough_avg(trips(spark, sf), zones(spark, sf))


@query
def bucket_avg(spark, sf):
    return stats.bucket_avg(trips(spark, sf))


@query
def weekpart_totals(spark, sf):
    return stats.weekpart_totals(trips(spark, sf))


@query
def od_counts(spark, sf):
    return stats.od_counts(trips(spark, sf))


@query
def top_frequent_pairs(spark, sf):
    return stats.top_frequent_pairs(trips(spark, sf), zones(spark, sf), coords(spark, sf))


@query
def top_tipped_pairs(spark, sf):
    return stats.top_tipped_pairs(trips(spark, sf), zones(spark, sf))


@query
def describe(spark, sf):
    return stats.describe(trips(spark, sf))


@query
def correlations(spark, sf):
    return stats.correlations(trips(spark, sf))


def _flow(spark, sf):
    return flow.od_flow(trips(spark, sf), zones(spark, sf), coords(spark, sf), *WINDOW, *HOURS)


@query
def od_flow(spark, sf):
    return _flow(spark, sf)


@query
def flow_centre(spark, sf):
    return flow.flow_centre(_flow(spark, sf))


@query
def statistics_document(spark, sf):
    document = stats.statistics_document(trips(spark, sf), zones(spark, sf), coords(spark, sf))
    return document.select(F.to_json(F.struct("*")).alias("document"))


# ---- samples ----


@query
def sample_capped(spark, sf):
    return sampling.sample_capped(trips(spark, sf), 0.5, 9000, row_key(), KEY_SPACE)


@query
def sample_n(spark, sf):
    return sampling.sample_n(trips(spark, sf), 2500, row_key(), KEY_SPACE)


@query
def stratified_sample(spark, sf):
    df = trips(spark, sf).select(
        bins.distance_bin(F.col("trip_distance")).alias("stratum"),
        "pickup_location_id",
        "dropff_location_id",
        "pickup_date",
        "pickup_time",
        "fare_amount",
    )
    return sampling.stratified_sample(df, "stratum", 3001, row_key(), KEY_SPACE)


# ---- anomalies ----


@query
def context_stats(spark, sf):
    return anomaly.context_stats(prepare.prepare_anomaly(trips(spark, sf)))


@query
def route_stats(spark, sf):
    return anomaly.route_stats(prepare.prepare_anomaly(trips(spark, sf)))


@query
def global_stats(spark, sf):
    return anomaly.global_stats(prepare.prepare_anomaly(trips(spark, sf)))


def _with_scores(features):
    """Closed-form scores in place of the forest's, so that SQL can repeat them."""
    pace = F.col("speed_mph") + F.col("eta_minutes")
    cost = F.col("fare_to_context_median_ratio") + F.col("fare_per_minute")
    return features.withColumns(
        {"speed_anomaly_score": pace / (pace + 60.0) - 0.5, "fare_anomaly_score": cost / (cost + 1.0) - 0.5}
    )


SCORED = (
    "pickup_timestamp", "pickup_hour", *ENDS, "fare_amount", "trip_distance_miles", "eta_minutes", "speed_mph",
    "fare_to_context_median_ratio", "context_fare_median", "context_median_fare", "context_iqr_fare",
    *[score for _, score in anomaly.KINDS.values()],
)


def _scored(spark, sf):
    """The columns that thresholds, flags and published rows take."""
    return written(spark, sf, "scored", lambda: _with_scores(_features(spark, sf)).select(*SCORED))


def _thresholds(spark, sf):
    scored = _scored(spark, sf)
    return (
        written(spark, sf, "speed_thresholds", lambda: anomaly.calibrate_speed(scored)),
        written(spark, sf, "fare_thresholds", lambda: anomaly.calibrate_fare(scored)),
    )


def _flagged(spark, sf):
    """Two comparisons a row beside the written scores, so the trips are not written once more."""
    speed, fare = _thresholds(spark, sf)
    return anomaly.flag_fare(anomaly.flag_speed(_scored(spark, sf), speed), fare)


@query
def calibrate_speed(spark, sf):
    return anomaly.calibrate_speed(_scored(spark, sf))


@query
def calibrate_fare(spark, sf):
    return anomaly.calibrate_fare(_scored(spark, sf))


@query
def attach_hour_threshold(spark, sf):
    scored = _scored(spark, sf)
    thresholds = _thresholds(spark, sf)[0]
    return lookup.attach_hour_threshold(scored.select("pickup_timestamp", *ENDS, "pickup_hour", "speed_mph"), thresholds)


@query
def flag_speed(spark, sf):
    return anomaly.flag_speed(_scored(spark, sf), _thresholds(spark, sf)[0]).select(
        "pickup_timestamp", *ENDS, "speed_mph", "speed_anomaly_score", "is_extreme_speed_anomaly"
    )


@query
def flag_fare(spark, sf):
    return anomaly.flag_fare(_scored(spark, sf), _thresholds(spark, sf)[1]).select(
        "pickup_timestamp", *ENDS, "fare_amount", "context_upper_fare_threshold", "is_fare_outlier_anomaly"
    )


@query
def hourly_variation(spark, sf):
    return anomaly.hourly_variation(_flagged(spark, sf), "is_extreme_speed_anomaly")


@query
def top_anomaly_pairs(spark, sf):
    return anomaly.top_anomaly_pairs(_flagged(spark, sf), "is_fare_outlier_anomaly", zones(spark, sf))


@query
def anomaly_rows(spark, sf):
    flagged, places = _flagged(spark, sf), zones(spark, sf)
    both = [anomaly.anomaly_rows(flagged, kind, places) for kind in anomaly.KINDS]
    return both[0].unionByName(both[1])


@query
def top_anomalies(spark, sf):
    return anomaly.top_anomalies(
        anomaly.anomaly_rows(_flagged(spark, sf), "extreme_speed", zones(spark, sf)), "extreme_speed"
    )


@query
def top_fare_anomalies(spark, sf):
    return anomaly.top_anomalies(
        anomaly.anomaly_rows(_flagged(spark, sf), "fare_outlier", zones(spark, sf)), "fare_outlier"
    )


@query
def anomaly_totals(spark, sf):
    return anomaly.anomaly_totals(_flagged(spark, sf))


@query
def iforest_scores(spark, sf):
    rated = prepare.hour_cycle(prepare.rate_features(prepare.prepare_anomaly(trips(spark, sf))))
    forest = iforest.fit_iforest(rated, anomaly.SPEED_FEATURES)
    scored = iforest.score_iforest(rated, forest, anomaly.SPEED_FEATURES, "speed_anomaly_score")
    return scored.select("pickup_timestamp", *ENDS, "speed_mph", "speed_anomaly_score")


def _fixed_forests(spark):
    """Forests made by rule, so that SQL can repeat their scores."""

    def forest(cols):
        heaps = [(t, FIXED_ROWS, *iforest.heap(fixed_tree(t, cols))) for t in range(FIXED_TREES)]
        return spark.createDataFrame(heaps, iforest.FOREST_SCHEMA)

    return {"speed": forest(anomaly.SPEED_FEATURES), "fare": forest(anomaly.FARE_FEATURES)}


@query
def forest_scores(spark, sf):
    scored = anomalies.score_both(_features(spark, sf), _fixed_forests(spark))
    return scored.select("pickup_timestamp", *ENDS, "speed_anomaly_score", "fare_anomaly_score")


@query
def anomaly_job(spark, sf):
    """The whole job with given forests; the hours and totals of its written summary."""
    out = f"{checkpoint_dir(spark)}/anomaly-job-{uuid.uuid4().hex}"
    summary = anomalies.run_anomaly(trips(spark, sf), zones(spark, sf), out, forests=_fixed_forests(spark))["summary"]
    kinds = [
        summary.select(
            F.lit(kind).alias("kind"),
            F.inline(f"{kind}.hourly_variation"),
            F.col(f"{kind}_records").alias("records"),
            F.col(f"{kind}_percentage").alias("percentage"),
        )
        for kind in anomaly.KINDS
    ]
    return reduce(DataFrame.unionByName, kinds).withColumn("pickup_hour", F.col("pickup_hour").cast("int"))


# ---- forecasting ----


def _agg(spark, sf):
    return written(spark, sf, "agg", lambda: forecast.agg_trip_frame(prepare.prepare_forecast(trips(spark, sf))))


def _forecast_frames(spark, sf, keep=("trip_count", "avg_fare_amount", "avg_eta_minutes")):
    train, test = forecast.split_months(_agg(spark, sf))
    prior, overall = forecast.route_priors(train), forecast.global_prior(train)
    make = lambda df: forecast.forecast_features(df, prior, overall, coords(spark, sf), keep)
    return make(train), make(test), prior, overall


@query
def agg_trip_frame(spark, sf):
    return _agg(spark, sf)


@query
def split_months(spark, sf):
    train, test = forecast.split_months(_agg(spark, sf))
    size = lambda df, name: df.agg(
        F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"), F.sum("trip_count").alias("trips")
    )
    return size(train, "train").unionByName(size(test, "test"))


@query
def route_priors(spark, sf):
    return forecast.route_priors(forecast.split_months(_agg(spark, sf))[0])


@query
def global_prior(spark, sf):
    return forecast.global_prior(forecast.split_months(_agg(spark, sf))[0])


@query
def attach_route_prior(spark, sf):
    train, test = forecast.split_months(_agg(spark, sf))
    return lookup.attach_route_prior(test, forecast.route_priors(train), forecast.global_prior(train))


@query
def forecast_features(spark, sf):
    return _forecast_frames(spark, sf)[1]


@query
def regression_metrics(spark, sf):
    test = _forecast_frames(spark, sf)[1]
    return forecast.regression_metrics(test, "avg_fare_amount", "route_hist_avg_fare")


def _requests(spark, sf):
    """One request per trip pair and day, at hours 1 to 24."""
    return (
        trips(spark, sf)
        .select(
            F.col("pickup_location_id").alias("source_location_id"),
            F.col("dropff_location_id").alias("destination_location_id"),
            "pickup_date",
            (times.hour_of_text(F.col("pickup_time")) + 1).alias("pickup_hour"),
        )
        .distinct()
    )


@query
def request_features(spark, sf):
    train, _ = forecast.split_months(_agg(spark, sf))
    prior = forecast.route_priors(train)
    return forecast.request_features(_requests(spark, sf), prior, forecast.global_prior(train), coords(spark, sf))


def _bundle(spark, sf):
    train, test, prior, overall = _forecast_frames(spark, sf)
    # Both fits read the training rows a dozen times, so their joins are done once, as in the job.
    rows = written(spark, sf, "train_features", lambda: train)
    of = lambda name, features, fit: Boosted.of_frame(written(spark, sf, name, lambda: fit().frame(spark)), features)
    fare = of("fare_model", forecast.FEATURES, lambda: forecast.fit_fare(rows))
    eta = of("eta_model", forecast.ETA_FEATURES, lambda: forecast.fit_eta(rows, fare))
    return forecast.Bundle(fare, eta, prior, overall, coords(spark, sf)), test


@query
def test_predictions(spark, sf):
    bundle, test = _bundle(spark, sf)
    return forecast.test_predictions(test, bundle)


test_predictions.__test__ = False


@query
def score_requests(spark, sf):
    return forecast.score_requests(_requests(spark, sf), _bundle(spark, sf)[0])


# ---- clusters ----


def _start(spark, sf):
    """Fixed start centres: the coordinates of zones 2, 7, 12, 17 and 22 for every segment."""
    key = F.col("location_id")
    five = coords(spark, sf).where((key % 5 == 2) & (key < 25))
    return five.select(
        F.explode(F.lit(list(cluster.SEGMENTS))).alias("segment"),
        F.floor((key - 2) / 5).cast("int").alias("cluster_id"),
        F.col("long").alias("center_long"),
        F.col("lat").alias("center_lat"),
    )


def _points(spark, sf):
    return written(spark, sf, "points", lambda: cluster.weighted_points(trips(spark, sf), coords(spark, sf)))


def _centroids(spark, sf):
    """Rounded, so that a point between two centroids has one nearest for every engine."""
    return checked(cluster.borough_centroids(zones(spark, sf), coords(spark, sf)))


def _refined(spark, sf):
    return written(spark, sf, "refined", lambda: cluster.refine_centres(_points(spark, sf), _start(spark, sf)))


def _labelled(spark, sf):
    return cluster.label_points(_points(spark, sf), _start(spark, sf))


@query
def weighted_points(spark, sf):
    return _points(spark, sf)


@query
def segment_point_counts(spark, sf):
    return cluster.segment_point_counts(_points(spark, sf))


@query
def borough_centroids(spark, sf):
    return _centroids(spark, sf)


@query
def label_points(spark, sf):
    return cluster.label_points(_points(spark, sf), _start(spark, sf))


@query
def refine_centres(spark, sf):
    return _refined(spark, sf)


@query
def cluster_summary(spark, sf):
    labelled = _labelled(spark, sf)
    return cluster.cluster_summary(labelled, cluster.display_points(labelled))


@query
def bounds(spark, sf):
    return cluster.bounds(_points(spark, sf), _refined(spark, sf))


@query
def axis_bounds(spark, sf):
    return cluster.axis_bounds(coords(spark, sf))


@query
def borough_share(spark, sf):
    return cluster.borough_share(_points(spark, sf), _centroids(spark, sf))


@query
def cluster_snapshots(spark, sf):
    return cluster.cluster_snapshots(_refined(spark, sf), _centroids(spark, sf))


@query
def concentration_summary(spark, sf):
    centroids = _centroids(spark, sf)
    shares = cluster.borough_share(_points(spark, sf), centroids)
    return cluster.concentration_summary(cluster.cluster_snapshots(_refined(spark, sf), centroids), shares)


@query
def cluster_payload(spark, sf):
    """Shown points of all segments, next to the totals of their payloads."""
    labelled, refined, centroids = _labelled(spark, sf), _refined(spark, sf), _centroids(spark, sf)
    parts = [cluster.cluster_payload(labelled, refined, centroids, segment) for segment in cluster.SEGMENTS]
    each = [p["points"].join(p["totals"].drop("selected_k"), "segment") for p in parts]
    return reduce(DataFrame.unionByName, each)


@query
def fit_segments(spark, sf):
    return cluster.fit_segments(_points(spark, sf))


@query
def cluster_diagnostics(spark, sf):
    return cluster.cluster_diagnostics(_points(spark, sf), _refined(spark, sf))


@query
def cluster_hulls(spark, sf):
    return hulls.cluster_hulls(_labelled(spark, sf))


# ---- rules ----


def _baskets(spark, sf):
    return written(spark, sf, "baskets", lambda: rules.transactions(trips(spark, sf), zones(spark, sf)))


@query
def transactions(spark, sf):
    return _baskets(spark, sf).select(F.array_join("items", "|").alias("items"))


def _mined(spark, sf):
    """All rules at the published support and confidence, with their text."""
    return written(spark, sf, "mined", lambda: rules.rule_text(rules.mine_rules(_baskets(spark, sf))))


@query
def mine_rules(spark, sf):
    return _mined(spark, sf).drop("antecedent", "consequent")


@query
def pair_rules(spark, sf):
    return _mined(spark, sf).where(F.size("antecedent") == 1).drop("antecedent", "consequent")


@query
def rank_rules(spark, sf):
    ranked = rules.interesting(rules.rank_rules(_mined(spark, sf)))
    return ranked.drop("antecedent", "consequent")


@query
def categorise(spark, sf):
    return rules.categorise(_mined(spark, sf)).select("rule", "place", "category", "match_kind")


@query
def showcase(spark, sf):
    return rules.showcase(rules.rank_rules(checked(_mined(spark, sf))))


@query
def insight(spark, sf):
    return rules.insight(_mined(spark, sf)).select("rule", "insight")


@query
def rule_sentence(spark, sf):
    return rules.rule_sentence(_mined(spark, sf)).select("rule", "sentence")


@query
def airport_spotlight(spark, sf):
    listed = rules.all_rules(checked(_mined(spark, sf)))
    return rules.airport_spotlight(listed)


@query
def rule_kpis(spark, sf):
    found = _mined(spark, sf)
    top = rules.showcase(rules.rank_rules(checked(found)))
    return rules.rule_kpis(_baskets(spark, sf), found, top)
