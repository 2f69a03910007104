"""Fare and duration prediction: aggregate, priors, features, two stacked boosted models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrace.functions import numeric
from citytrace.operators import prepare
from citytrace.operators.boosting import BoostConfig, Boosted, fit_boosted
from citytrace.operators.lookup import attach_route_prior, route_distance
from citytrace.operators.quantiles import exact_quantiles
from citytrace.session import cut_lineage

TRAIN_MONTHS = (1, 9)
TEST_MONTHS = (10, 11)
# The model inputs, in model order.
FEATURES = (
    "source_id",
    "destination_id",
    "pickup_hour",
    "day_of_week",
    "is_weekend",
    "month",
    "route_distance_km",
    "route_hist_avg_fare",
    "route_hist_avg_eta",
    "route_hist_trip_count_log1p",
)
ETA_FEATURES = (*FEATURES, "predicted_fare_feature")
ETA_CLIP_QUANTILE = 0.999
KEYS = ("source_id", "destination_id", "pickup_hour", "day_of_week", "is_weekend", "month")


# Published model settings.
FARE_BOOST = BoostConfig(rounds=500, depth=8, min_leaf=40)
ETA_BOOST = BoostConfig(rounds=450, depth=10, min_leaf=30)


@dataclass(frozen=True)
class Bundle:
    """Everything scoring needs: two models and the tables behind the features."""

    fare: Boosted
    eta: Boosted
    prior: DataFrame
    overall: DataFrame
    coords: DataFrame


def agg_trip_frame(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy(*KEYS).agg(
        F.avg("fare_amount").alias("avg_fare_amount"),
        F.avg("eta_minutes").alias("avg_eta_minutes"),
        F.count(F.lit(1)).alias("trip_count"),
    )


def split_months(
    agg: DataFrame, train: tuple[int, int] = TRAIN_MONTHS, test: tuple[int, int] = TEST_MONTHS
) -> tuple[DataFrame, DataFrame]:
    part = lambda months: agg.where(F.col("month").between(*months))
    return part(train), part(test)


def _weighted(target: str):
    return F.sum(F.col(target) * F.col("trip_count")) / F.sum("trip_count")


def route_priors(train: DataFrame) -> DataFrame:
    return train.groupBy("source_id", "destination_id").agg(
        _weighted("avg_fare_amount").alias("route_hist_avg_fare"),
        _weighted("avg_eta_minutes").alias("route_hist_avg_eta"),
        F.log1p(F.sum("trip_count").cast("double")).alias("route_hist_trip_count_log1p"),
    )


def global_prior(train: DataFrame) -> DataFrame:
    return train.agg(
        _weighted("avg_fare_amount").alias("route_hist_avg_fare"),
        _weighted("avg_eta_minutes").alias("route_hist_avg_eta"),
        F.lit(0.0).alias("route_hist_trip_count_log1p"),
    )


def forecast_features(
    frame: DataFrame, prior: DataFrame, overall: DataFrame, coords: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Model inputs of a training or test frame; a missing distance takes the frame's median."""
    joined = route_distance(attach_route_prior(frame, prior, overall), coords)
    # The median runs on distances per pair, so it reads the frame without the prior join.
    median = (
        exact_quantiles(route_distance(frame.select("source_id", "destination_id"), coords), [], "route_distance_km", {"m": 0.5})
        .select("m")
        .scalar()
    )
    filled = joined.withColumn("route_distance_km", F.coalesce(numeric.finite(F.col("route_distance_km")), median))
    return filled.select(*[F.col(c).cast("int").alias(c) for c in KEYS], *FEATURES[len(KEYS) :], *keep)


def predict_fare(df: DataFrame, model: Boosted, out: str) -> DataFrame:
    return df.withColumn(out, model.prediction())


def predict_eta(df: DataFrame, model: Boosted, out: str) -> DataFrame:
    return df.withColumn(out, F.expm1(model.prediction()))


def fit_fare(train_features: DataFrame, config: BoostConfig = FARE_BOOST) -> Boosted:
    """Absolute-loss boosting of the average fare, weighted by trips. Runs Spark jobs."""
    return fit_boosted(train_features, FEATURES, "avg_fare_amount", "trip_count", config, "absolute")


def fit_eta(train_features: DataFrame, fare_model: Boosted, config: BoostConfig = ETA_BOOST) -> Boosted:
    """Squared-loss boosting of log minutes, clipped at a high quantile, with the predicted fare as input."""
    upper = exact_quantiles(train_features, [], "avg_eta_minutes", {"q": ETA_CLIP_QUANTILE}).select("q").scalar()
    stacked = predict_fare(train_features, fare_model, "predicted_fare_feature").withColumn(
        "_label", F.log1p(numeric.clip(F.col("avg_eta_minutes"), 0.0, upper))
    )
    # The fit reads its inputs several times; the fare model's trees are walked once.
    stacked = cut_lineage(stacked.select(*ETA_FEATURES, "trip_count", "_label"))
    return fit_boosted(stacked, ETA_FEATURES, "_label", "trip_count", config, "squared")


def predict_both(features: DataFrame, bundle: Bundle) -> DataFrame:
    stacked = predict_fare(features, bundle.fare, "predicted_fare_feature")
    return predict_eta(stacked, bundle.eta, "predicted_eta_minutes")


def test_predictions(test_features: DataFrame, bundle: Bundle) -> DataFrame:
    """Actual and predicted averages of the test frame with absolute errors."""
    scored = predict_both(test_features, bundle)
    fare, eta = F.col("predicted_fare_feature"), F.col("predicted_eta_minutes")
    return scored.select(
        *KEYS,
        "trip_count",
        F.col("avg_fare_amount").alias("actual_avg_fare"),
        fare.alias("predicted_avg_fare"),
        F.abs(F.col("avg_fare_amount") - fare).alias("abs_error_fare"),
        F.col("avg_eta_minutes").alias("actual_avg_eta_minutes"),
        eta.alias("predicted_avg_eta_minutes"),
        F.abs(F.col("avg_eta_minutes") - eta).alias("abs_error_eta_minutes"),
    )


test_predictions.__test__ = False


def regression_metrics(pred: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Unweighted MAE, RMSE and R2 in one pass."""
    y, error = F.col(actual), F.col(actual) - F.col(predicted)
    sums = pred.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("_mse"),
        F.var_pop(y).alias("_var"),
    )
    return sums.select(
        "mae", F.sqrt("_mse").alias("rmse"), (1.0 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2")
    )


def request_features(requests: DataFrame, bundle_prior: DataFrame, overall: DataFrame, coords: DataFrame) -> DataFrame:
    """Model inputs of scoring requests; a missing coordinate gives distance 0, an unknown route the global prior."""
    dated = prepare.normalise_pickup(requests).select(
        F.col("source_location_id").cast("int").alias("source_id"),
        F.col("destination_location_id").cast("int").alias("destination_id"),
        "pickup_date",
        F.col("pickup_hour").alias("requested_hour"),
        F.col("_hour").cast("int").alias("pickup_hour"),
        "day_of_week",
        "is_weekend",
        "month",
    )
    joined = route_distance(attach_route_prior(dated, bundle_prior, overall), coords)
    return joined.withColumn("route_distance_km", F.coalesce(numeric.finite(F.col("route_distance_km")), F.lit(0.0)))


def score_requests(requests: DataFrame, bundle: Bundle) -> DataFrame:
    """Predicted fare and minutes of a whole frame of requests."""
    scored = predict_both(request_features(requests, bundle.prior, bundle.overall, bundle.coords), bundle)
    return scored.select(
        F.col("source_id").alias("source_location_id"),
        F.col("destination_id").alias("destination_location_id"),
        "pickup_date",
        F.col("requested_hour").alias("pickup_hour"),
        F.col("predicted_fare_feature").alias("predicted_fare_amount"),
        "predicted_eta_minutes",
    )
