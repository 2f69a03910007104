"""Fare and duration models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrace.operators import forecast
from citytrace.operators.prepare import prepare_forecast
from citytrace.session import checkpoint_dir, cut_lineage
from citytrace.sources.artifacts import check_inputs
from citytrace.operators.boosting import Boosted
from citytrace.sources.sinks import save_tables, write_rows, write_summary

# The published serving window.
SERVING_WINDOW = (dt.date(2025, 10, 1), dt.date(2025, 12, 31))


BUNDLE_VERSION = 1
BUNDLE_TABLES = ("route_prior", "global_prior", "coordinates", "fare_model", "eta_model")


def _stamps(spark: SparkSession, folder: str) -> list:
    """Rows and an order-free checksum of each table of a bundle."""
    stamp = lambda df: df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("*").cast("decimal(38)")).cast("string").alias("sum"))
    return [stamp(spark.read.parquet(f"{folder}/{name}")).select(F.struct("*")).scalar().alias(name) for name in BUNDLE_TABLES]


def _write_manifest(spark: SparkSession, folder: str) -> None:
    """The last file of a bundle: without it, or with one of other tables, nothing is loaded."""
    row = spark.range(1).select(
        F.lit(BUNDLE_VERSION).alias("version"),
        F.lit(list(forecast.FEATURES)).alias("fare_features"),
        F.lit(list(forecast.ETA_FEATURES)).alias("eta_features"),
        F.struct(*_stamps(spark, folder)).alias("tables"),
    )
    write_summary(row, f"{folder}/manifest")


def load_bundle(spark: SparkSession, out: str) -> forecast.Bundle:
    """The bundle that a forecast job wrote, in any session; its tables are held against the manifest."""
    folder = f"{out}/bundle"
    manifest = spark.read.json(f"{folder}/manifest").first()
    if manifest["version"] != BUNDLE_VERSION:
        raise ValueError(f"bundle version {manifest['version']} is not {BUNDLE_VERSION}")
    if tuple(manifest["fare_features"]) != forecast.FEATURES or tuple(manifest["eta_features"]) != forecast.ETA_FEATURES:
        raise ValueError("the bundle's models have other inputs")
    found = spark.range(1).select(*_stamps(spark, folder)).first()
    changed = [name for name in BUNDLE_TABLES if found[name].asDict() != manifest["tables"][name].asDict()]
    if changed:
        raise ValueError(f"bundle tables differ from the manifest: {', '.join(changed)}")
    prior, overall, coords, fare, eta = (spark.read.parquet(f"{folder}/{name}") for name in BUNDLE_TABLES)
    return forecast.Bundle(
        Boosted.of_frame(fare, forecast.FEATURES), Boosted.of_frame(eta, forecast.ETA_FEATURES), prior, overall, coords
    )


def run_forecast(
    trips: DataFrame,
    coords: DataFrame,
    out: str,
    fare: forecast.BoostConfig = forecast.FARE_BOOST,
    eta: forecast.BoostConfig = forecast.ETA_BOOST,
) -> tuple[forecast.Bundle, DataFrame]:
    """Aggregate once, train on months 1 to 9, test on 10 and 11, write models, tables and metrics."""
    spark = trips.sparkSession
    checkpoint_dir(spark)
    agg = cut_lineage(forecast.agg_trip_frame(prepare_forecast(trips)))
    train, test = forecast.split_months(agg)
    check_inputs({"aggregate": agg, "training months": train, "test months": test})
    tables = {
        "route_prior": forecast.route_priors(train),
        "global_prior": forecast.global_prior(train),
        "coordinates": coords,
    }
    save_tables(tables, f"{out}/bundle")
    prior, overall, coords = (spark.read.parquet(f"{out}/bundle/{name}") for name in tables)
    keep = ("trip_count", "avg_fare_amount", "avg_eta_minutes")
    train_x = cut_lineage(forecast.forecast_features(train, prior, overall, coords, keep))
    test_x = forecast.forecast_features(test, prior, overall, coords, keep)
    fare_model = forecast.fit_fare(train_x, fare)
    eta_model = forecast.fit_eta(train_x, fare_model, eta)
    save_tables({"fare_model": fare_model.frame(spark), "eta_model": eta_model.frame(spark)}, f"{out}/bundle")
    _write_manifest(spark, f"{out}/bundle")
    bundle = load_bundle(spark, out)
    write_rows(forecast.test_predictions(test_x, bundle), f"{out}/test_predictions", "parquet")
    predictions = spark.read.parquet(f"{out}/test_predictions")
    metric = lambda what, predicted: forecast.regression_metrics(predictions, what, predicted).select(F.struct("*"))
    size = lambda df: df.agg(F.count(F.lit(1)).alias("rows"), F.sum("trip_count").alias("trips")).select(F.struct("*"))
    metadata = spark.range(1).select(
        size(train).scalar().alias("train_size"),
        size(test).scalar().alias("test_size"),
        metric("actual_avg_fare", "predicted_avg_fare").scalar().alias("fare_model_test_metrics"),
        metric("actual_avg_eta_minutes", "predicted_avg_eta_minutes").scalar().alias("eta_model_test_metrics"),
        *[F.lit(day).alias(f"serving_{name}_date") for name, day in zip(("start", "end"), SERVING_WINDOW)],
    )
    write_summary(metadata, f"{out}/forecasting_metadata")
    return bundle, spark.read.json(f"{out}/forecasting_metadata")
