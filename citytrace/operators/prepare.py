"""Filters and feature columns that turn trip details into the input of one product."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citytrace.functions import bins, numeric, times
from citytrace.operators.lookup import with_row, with_zones
from citytrace.operators.quantiles import stacked_quantiles
from citytrace.session import cut_lineage

MAX_ETA_MINUTES = 240
FORECAST_MAX_MINUTES = 1440
FORECAST_MONTHS = (1, 11)
RULE_MAX_MILES = 30
RULE_MAX_FARE = 1000


def _once(**parts: Column) -> Column:
    """Columns that are computed once a row: a filter on plain ones would compute them again in itself."""
    return F.inline(F.array(F.struct(*[c.alias(name) for name, c in parts.items()])))


def prepare_anomaly(df: DataFrame, max_minutes: float = MAX_ETA_MINUTES) -> DataFrame:
    """Typed trips with fractional minutes and calendar columns; unusable rows are dropped."""
    number = lambda name: F.col(name).try_cast("double")
    pickup = times.ts_of_text(F.col("pickup_date"), F.col("pickup_time"))
    dropff = times.ts_of_text(F.col("dropff_date"), F.col("dropff_time"))
    typed = df.select(
        number("pickup_location_id").alias("source_id"),
        number("dropff_location_id").alias("destination_id"),
        _once(pickup_timestamp=pickup, _dropff=dropff),
        number("trip_distance").alias("trip_distance_miles"),
        number("fare_amount").alias("fare_amount"),
    ).withColumn("eta_minutes", times.minutes_exact(F.col("pickup_timestamp"), F.col("_dropff")))
    kept = typed.where(
        (F.col("source_id") != F.col("destination_id"))
        & (F.col("trip_distance_miles") > 0)
        & ~F.isnan("trip_distance_miles")
        & (F.col("fare_amount") >= 0)
        & ~F.isnan("fare_amount")
        & (F.col("eta_minutes") > 0)
        & (F.col("eta_minutes") <= max_minutes)
    )
    ts = F.col("pickup_timestamp")
    return kept.select(
        F.col("source_id").cast("int").alias("source_id"),
        F.col("destination_id").cast("int").alias("destination_id"),
        times.date_part(ts).alias("pickup_date"),
        times.time_text(ts).alias("pickup_time"),
        ts,
        F.hour(ts).alias("pickup_hour"),
        times.dow0(ts).alias("day_of_week"),
        times.is_weekend(ts).alias("is_weekend"),
        "trip_distance_miles",
        "fare_amount",
        "eta_minutes",
    )


def rate_features(df: DataFrame) -> DataFrame:
    """Miles per hour, fare per mile and fare per minute; tiny divisors are lifted to 0.001."""
    miles, minutes, fare = F.col("trip_distance_miles"), F.col("eta_minutes"), F.col("fare_amount")
    return df.withColumns(
        {
            "speed_mph": miles / (minutes / 60.0),
            "fare_per_mile": fare / numeric.at_least(miles, 1e-3),
            "fare_per_minute": fare / numeric.at_least(minutes, 1e-3),
        }
    )


def medians(df: DataFrame, cols: Sequence[str], default: float = 0.0) -> DataFrame:
    """One row with the exact median of each column's finite values, or the default without any."""
    picked = df.select(*[numeric.finite(F.col(c)).alias(c) for c in cols])
    found = cut_lineage(stacked_quantiles(picked, {c: {f"_median_{c}": 0.5} for c in cols}))
    value = lambda c: F.coalesce(found.select(f"_median_{c}").scalar(), F.lit(default)).alias(c)
    return df.sparkSession.range(1).select(*[value(c) for c in cols])


def impute(df: DataFrame, fills: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace unreadable or non-finite values by the columns of a one-row frame."""
    filled = {c: F.coalesce(numeric.finite(F.col(c)), F.col(f"_fills.{c}")) for c in cols}
    return with_row(df, fills, "_fills").withColumns(filled).drop("_fills")


def impute_median(df: DataFrame, cols: Sequence[str], default: float = 0.0) -> DataFrame:
    """One global median per column, so the result does not depend on how the data is cut."""
    return impute(df, medians(df, cols, default), cols)


def hour_cycle(df: DataFrame) -> DataFrame:
    angle = F.col("pickup_hour").cast("double") / 24.0 * (2.0 * math.pi)
    return df.withColumns({"pickup_hour_sin": F.sin(angle), "pickup_hour_cos": F.cos(angle)})


def prepare_forecast(df: DataFrame, months: tuple[int, int] = FORECAST_MONTHS) -> DataFrame:
    """Trips with boundary minutes and calendar columns, as the forecasting aggregate needs them."""
    pickup = times.ts_of_text(F.col("pickup_date"), F.col("pickup_time"))
    dropff = times.ts_of_text(F.col("dropff_date"), F.col("dropff_time"))
    day = F.col("pickup_date").try_cast("date")
    typed = df.select(
        F.col("pickup_location_id").cast("int").alias("source_id"),
        F.col("dropff_location_id").cast("int").alias("destination_id"),
        times.hour_of_text(F.col("pickup_time")).alias("pickup_hour"),
        times.dow0(day).alias("day_of_week"),
        times.is_weekend(day).alias("is_weekend"),
        times.month_no(day).alias("month"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        _once(_pickup=pickup, _dropff=dropff),
    ).withColumn("eta_minutes", times.minutes_boundary(F.col("_pickup"), F.col("_dropff")))
    kept = typed.where(
        (F.col("source_id") != F.col("destination_id"))
        & F.col("pickup_hour").between(0, 23)
        & (F.col("fare_amount") >= 0)
        & (F.col("eta_minutes") > 0)
        & (F.col("eta_minutes") <= FORECAST_MAX_MINUTES)
        & F.col("month").between(*months)
    )
    return kept.drop("_pickup", "_dropff")


def prepare_rules(
    df: DataFrame,
    zones: DataFrame,
    max_miles: float = RULE_MAX_MILES,
    max_fare: float = RULE_MAX_FARE,
) -> DataFrame:
    """Trips between known zones with usable numbers, joined to both zones."""
    typed = df.select(
        F.col("pickup_location_id").cast("int").alias("source_id"),
        F.col("dropff_location_id").cast("int").alias("destination_id"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.col("tip_amount").cast("double").alias("tip_amount"),
        F.col("payment_type").cast("int").alias("payment_type"),
        F.to_date("pickup_date").alias("pickup_date"),
        times.hour_of_text(F.col("pickup_time")).alias("pickup_hour"),
    ).where(
        F.col("pickup_date").isNotNull()
        & F.col("payment_type").isNotNull()
        & F.col("pickup_hour").between(0, 23)
        & (F.col("trip_distance") > 0)
        & (F.col("trip_distance") < max_miles)
        & (F.col("fare_amount") >= 0)
        & (F.col("fare_amount") < max_fare)
        & (F.col("tip_amount") >= 0)
    )
    joined = with_zones(typed, zones)
    names = ("source_zone", "destination_zone", "source_borough", "destination_borough")
    for name in names:
        joined = joined.where(~bins.is_unknown(F.col(name)))
    return joined


def known_boroughs(zones: DataFrame) -> DataFrame:
    return zones.where(~bins.is_unknown(F.col("borough")))


def filter_window(
    df: DataFrame,
    first_day: dt.date,
    last_day: dt.date,
    first_hour: int = 0,
    end_hour: int = 24,
) -> DataFrame:
    """Trips of an inclusive date range and a half-open hour range."""
    if first_day > last_day:
        raise ValueError("the first day must not be after the last day")
    if not 0 <= first_hour <= 23:
        raise ValueError("the first hour must be 0 to 23")
    if not 1 <= end_hour <= 24:
        raise ValueError("the end hour must be 1 to 24")
    if first_hour >= end_hour:
        raise ValueError("the first hour must be lower than the end hour")
    hour = times.hour_of_text(F.col("pickup_time"))
    return df.where(
        F.col("pickup_date").between(F.lit(first_day), F.lit(last_day))
        & (hour >= first_hour)
        & (hour < end_hour)
    )


def segments_of(hour):
    """The segments of one hour: ``all`` for every row, plus its time bucket if it has one."""
    return F.array_compact(F.array(F.lit(bins.ALL_DAY), bins.time_bucket(hour)))


def segment_trips(df: DataFrame) -> DataFrame:
    hour = times.hour_of_text(F.col("pickup_time"))
    return df.withColumn("segment", F.explode(segments_of(hour)))


def normalise_pickup(requests: DataFrame) -> DataFrame:
    """Calendar columns of requests; hour 24 is midnight of the next day, other hours are an error."""
    hour = F.col("pickup_hour").cast("int")
    checked = F.when(hour.between(0, 24), hour).otherwise(
        F.raise_error(F.lit("pickup_hour must be 0 to 24")).cast("int")
    )
    day = F.date_add(F.col("pickup_date"), F.floor(checked / 24).cast("int"))
    return requests.withColumns({"_day": day, "_hour": checked % 24}).select(
        "*",
        times.dow0(F.col("_day")).alias("day_of_week"),
        times.is_weekend(F.col("_day")).alias("is_weekend"),
        times.month_no(F.col("_day")).alias("month"),
    )
