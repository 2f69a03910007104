"""Descriptive statistics of trip details.

Trips are aggregated to days, buckets, locations or pairs first; calendar, zone and coordinate
tables join the small result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrace.functions import bins, times
from citytrace.operators.lookup import as_list, route_distance, with_zones
from citytrace.operators.prepare import known_boroughs

MEASURES = ("trip_distance", "fare_amount", "tip_amount", "extra_amount", "total_trip_amount")
BUCKETS = tuple(bins.TIME_BUCKETS)
_trips = lambda: F.count(F.lit(1))


def _values(spark: SparkSession, **lists: Sequence) -> DataFrame:
    """All combinations of short literal lists, one generated row at a time."""
    frame = spark.range(1)
    for name, values in lists.items():
        frame = frame.select("*", F.explode(F.lit(list(values))).alias(name))
    return frame.drop("id")


def _weekpart(flag: Column) -> Column:
    return F.when(flag == 1, "Weekend").otherwise("Weekday")


def date_dim(df: DataFrame) -> DataFrame:
    """Every pickup date with its day name and weekend flag."""
    day = F.col("date")
    return (
        df.select(F.col("pickup_date").alias("date"))
        .where(day.isNotNull())
        .distinct()
        .select("date", times.day_name(day).alias("day"), times.is_weekend(day).alias("is_weekend"))
    )


def _per_day(df: DataFrame, *extra: Column) -> DataFrame:
    return df.groupBy(F.col("pickup_date"), *extra).agg(_trips().alias("_n"))


def days_of(dates: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    if first is not None:
        dates = dates.where(F.col("date") >= F.lit(first))
    if last is not None:
        dates = dates.where(F.col("date") <= F.lit(last))
    return dates


def monthly_counts(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Trips per calendar month of the window; months without trips show 0."""
    start = lambda c: F.trunc(c, "month")
    counts = (
        df.where(F.col("pickup_date").between(F.lit(first), F.lit(last)))
        .groupBy(start(F.col("pickup_date")).alias("_month"))
        .agg(_trips().alias("_n"))
    )
    span = F.sequence(start(F.lit(first)), start(F.lit(last)), F.expr("interval 1 month"))
    spine = df.sparkSession.range(1).select(F.explode(span).alias("_month"))
    month = F.col("_month")
    return spine.join(counts, "_month", "left").select(
        F.year(month).alias("year"),
        times.month_no(month).alias("month_no"),
        times.month_label(month).alias("month"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("trip_count"),
    )


def weekday_weekend_avg(
    df: DataFrame, dates: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Trips per day of weekdays and weekends; the divisor is the number of such days in the calendar.

    ``first`` and ``last`` bound trips and days alike.
    """
    days = days_of(dates, first, last).groupBy("is_weekend").agg(_trips().alias("_days"))
    counted = _per_day(df)
    if first is not None:
        counted = counted.where(F.col("pickup_date") >= F.lit(first))
    if last is not None:
        counted = counted.where(F.col("pickup_date") <= F.lit(last))
    totals = (
        counted.groupBy(times.is_weekend(F.col("pickup_date")).alias("is_weekend")).agg(F.sum("_n").alias("_n"))
    )
    spine = _values(df.sparkSession, is_weekend=[0, 1])
    joined = spine.join(totals, "is_weekend", "left").join(days, "is_weekend", "left")
    return joined.select(
        _weekpart(F.col("is_weekend")).alias("segment"),
        F.coalesce(F.try_divide(F.col("_n").cast("double"), F.col("_days")), F.lit(0.0)).alias("avg_trips"),
    )


def weekpart_bucket_avg(
    df: DataFrame, dates: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Eight dense rows: average trips per calendar day by weekday part and time bucket."""
    calendar = days_of(dates, first, last).select("date", "is_weekend")
    bucket = bins.time_bucket(times.hour_of_text(F.col("pickup_time"))).alias("time_of_day")
    per_day = _per_day(df, bucket).where(F.col("time_of_day").isNotNull())
    totals = (
        per_day.join(calendar.withColumnRenamed("date", "pickup_date"), "pickup_date", "inner")
        .groupBy("is_weekend", "time_of_day")
        .agg(F.sum("_n").alias("_n"))
    )
    days = calendar.groupBy("is_weekend").agg(_trips().alias("_days"))
    grid = _values(df.sparkSession, is_weekend=[0, 1], time_of_day=BUCKETS)
    joined = grid.join(days, "is_weekend", "inner").join(totals, ["is_weekend", "time_of_day"], "left")
    return joined.select(
        "is_weekend",
        _weekpart(F.col("is_weekend")).alias("segment"),
        "time_of_day",
        F.coalesce(F.try_divide(F.coalesce("_n", F.lit(0)).cast("double"), F.col("_days")), F.lit(0.0)).alias(
            "avg_trips"
        ),
    )


def weekpart_bucket_pivot(averages: DataFrame) -> DataFrame:
    """Weekday and weekend rows with one rounded column per time bucket, 0 where absent."""
    labels = [name.title() for name in BUCKETS]
    spine = _values(averages.sparkSession, segment=["Weekday", "Weekend"])
    wide = (
        averages.withColumn("time_of_day", F.initcap("time_of_day"))
        .groupBy("segment")
        .pivot("time_of_day", labels)
        .agg(F.sum("avg_trips"))
    )
    return spine.join(wide, "segment", "left").select(
        "segment", *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 2).alias(c) for c in labels]
    )


def kpis(df: DataFrame) -> DataFrame:
    """Trips, first and last pickup date, and trips per distinct pickup date."""
    day = F.col("pickup_date")
    totals = _per_day(df).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_no_of_trips"),
        F.min(day).alias("start_date"),
        F.max(day).alias("end_date"),
        F.count(day).alias("_days"),
    )
    average = F.try_divide(F.col("total_no_of_trips").cast("double"), F.col("_days"))
    return totals.withColumn("avg_no_of_trips_per_day", F.coalesce(average, F.lit(0.0))).drop("_days")


def borough_avg(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Pickups per zone averaged over all zones of a borough; a zone without trips counts as 0."""
    pickups = df.groupBy(F.col("pickup_location_id").alias("location_id")).agg(_trips().alias("_n"))
    known = known_boroughs(zones).select("location_id", F.trim("borough").alias("borough"))
    return (
        known.join(pickups, "location_id", "left")
        .groupBy("borough")
        .agg(
            F.avg(F.coalesce("_n", F.lit(0)).cast("double")).alias("avg_trips_per_location"),
            _trips().alias("location_count"),
        )
    )


def bucket_avg(df: DataFrame) -> DataFrame:
    """Average trips per pickup date in each time bucket, four rows."""
    bucket = bins.time_bucket(times.hour_of_text(F.col("pickup_time"))).alias("time_of_day")
    slot = lambda name: F.sum(F.when(F.col("time_of_day") == name, F.col("_n")))
    row = _per_day(df, bucket).agg(F.countDistinct("pickup_date").alias("_days"), *[slot(b).alias(b) for b in BUCKETS])
    entry = lambda b: F.struct(
        F.lit(b).alias("time_of_day"),
        F.coalesce(F.try_divide(F.col(b).cast("double"), F.col("_days")), F.lit(0.0)).alias("avg_trips"),
    )
    return row.select(F.explode(F.array(*[entry(b) for b in BUCKETS])).alias("e")).select("e.*")


def weekpart_totals(df: DataFrame) -> DataFrame:
    flag = times.is_weekend(F.col("pickup_date"))
    part = lambda wanted: F.coalesce(F.sum(F.when(flag == wanted, F.col("_n"))), F.lit(0))
    return _per_day(df).agg(
        part(0).alias("total_no_of_weekday_trips"), part(1).alias("total_no_of_weekend_trips")
    )


def od_counts(df: DataFrame, k: int = 400) -> DataFrame:
    """The ``k`` busiest origin-destination pairs, ties by the ids."""
    source, destination = F.col("pickup_location_id"), F.col("dropff_location_id")
    return (
        df.where(source != destination)
        .groupBy(source.alias("source_id"), destination.alias("destination_id"))
        .agg(_trips().alias("trip_count"))
        .orderBy(F.desc("trip_count"), "source_id", "destination_id")
        .limit(k)
    )


def _pairs(df: DataFrame, *aggs: Column) -> DataFrame:
    return df.groupBy(
        F.col("pickup_location_id").alias("source_id"), F.col("dropff_location_id").alias("destination_id")
    ).agg(_trips().alias("frequency_of_trips"), *aggs)


def top_frequent_pairs(df: DataFrame, zones: DataFrame, coords: DataFrame, k: int = 10) -> DataFrame:
    top = (
        _pairs(df, F.avg("fare_amount").alias("avg_fare_amount"))
        .orderBy(F.desc("frequency_of_trips"), "source_id", "destination_id")
        .limit(k)
    )
    named = with_zones(route_distance(top, coords), zones)
    return named.select(
        "source_id",
        "destination_id",
        "source_zone",
        "destination_zone",
        F.col("route_distance_km").alias("distance_km"),
        "frequency_of_trips",
        "avg_fare_amount",
    ).orderBy(F.desc("frequency_of_trips"), "source_id", "destination_id")


def top_tipped_pairs(df: DataFrame, zones: DataFrame, min_trips: int = 1, k: int = 10) -> DataFrame:
    top = (
        _pairs(df, F.avg("tip_amount").alias("avg_tip_amount"))
        .where(F.col("frequency_of_trips") >= min_trips)
        .orderBy(F.desc("avg_tip_amount"), "source_id", "destination_id")
        .limit(k)
    )
    return with_zones(top, zones).select(
        "source_id", "destination_id", "source_zone", "destination_zone", "avg_tip_amount", "frequency_of_trips"
    ).orderBy(F.desc("avg_tip_amount"), "source_id", "destination_id")


def describe(df: DataFrame, cols: Sequence[str] = MEASURES) -> DataFrame:
    """Count, mean, deviation, minimum and maximum per measure from one scan."""
    shape: Mapping = {
        "count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    row = df.agg(*[F.struct(*[f(c).alias(n) for n, f in shape.items()]).alias(c) for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("s")) for c in cols])
    return row.select(F.explode(entries).alias("e")).select("e.measure", "e.s.*")


def correlations(df: DataFrame, cols: Sequence[str] = MEASURES) -> DataFrame:
    """Pearson correlation of every pair of measures from one scan."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"{a}~{b}") for a, b in pairs])
    entries = F.array(
        *[
            F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"`{a}~{b}`").alias("correlation"))
            for a, b in pairs
        ]
    )
    return row.select(F.explode(entries).alias("e")).select("e.*")


def statistics_document(df: DataFrame, zones: DataFrame, coords: DataFrame) -> DataFrame:
    """All statistics as one nested row, the shape of the published document."""
    pair = [F.col("source_id"), F.col("destination_id")]
    averages = bucket_avg(df).agg(F.map_from_entries(F.collect_list(F.struct("time_of_day", "avg_trips")))).scalar()
    return kpis(df).select(
        "*",
        as_list(borough_avg(df, zones), F.col("borough")).alias("avg_trips_by_location_for_each_borough"),
        averages.alias("avg_trips_by_time_of_day"),
        weekpart_totals(df).select(F.struct("*")).scalar().alias("weekday_weekend_trip_totals"),
        as_list(top_frequent_pairs(df, zones, coords), -F.col("frequency_of_trips"), *pair).alias(
            "top_10_frequent_source_destination_pairs"
        ),
        as_list(top_tipped_pairs(df, zones), -F.col("avg_tip_amount"), *pair).alias(
            "top_10_most_tipped_source_destination_pairs"
        ),
    )
