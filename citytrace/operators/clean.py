"""Cleaning of raw monthly trips into trip details."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrace.functions import times

# Accepted spellings per required raw column, first match wins.
ALTERNATIVES: dict[str, tuple[str, ...]] = {
    "pickup_ts": ("tpep_pickup_datetime",),
    "dropff_ts": ("tpep_dropff_datetime", "tpep_dropoff_datetime"),
    "pickup_location_id": ("PULocationID",),
    "dropff_location_id": ("DOLocationID",),
    "trip_distance": ("trip_distance",),
    "fare_amount": ("fare_amount",),
    "tip_amount": ("tip_amount",),
    "extra": ("extra",),
    "tolls_amount": ("tolls_amount",),
    "congestion_surcharge": ("congestion_surcharge",),
    "airport_fee": ("airport_fee", "Airport_fee"),
}

# Source columns that never reach the processed table.
DROPPED = (
    "VendorID",
    "RatecodeID",
    "store_and_fwd_flag",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
)
TIMESTAMPS = ("pickup_ts", "dropff_ts")
SORT_KEYS = ("pickup_date", "pickup_time", "dropff_date", "dropff_time")
MAX_TRIP_SECONDS = times.DAY_SECONDS


def resolve(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """The frame's own spelling of the first candidate it has, in any case."""
    own = {name.lower(): name for name in df.columns}
    return next((own[c.lower()] for c in candidates if c.lower() in own), None)


def harmonise(df: DataFrame, alternatives: Mapping[str, Sequence[str]] = ALTERNATIVES) -> DataFrame:
    """Give every required column its one name; other columns stay. Missing ones are an error."""
    found = {name: resolve(df, candidates) for name, candidates in alternatives.items()}
    missing = {name: list(alternatives[name]) for name, own in found.items() if own is None}
    if missing:
        raise ValueError(f"required columns not found, candidates: {missing}")
    return df.withColumnsRenamed({own: name for name, own in found.items() if own != name})


def drop_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    unwanted = {name.lower() for name in names}
    return df.drop(*[c for c in df.columns if c.lower() in unwanted])


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def valid_trips(df: DataFrame, max_seconds: int = MAX_TRIP_SECONDS) -> DataFrame:
    """Positive distance, two ends that differ, a wall-clock duration of 0 to a day, fare not negative."""
    pickup, dropff = (F.col(c).cast("timestamp_ntz") for c in TIMESTAMPS)
    return df.where(
        (F.col("trip_distance").cast("double") > 0)
        & (F.col("pickup_location_id") != F.col("dropff_location_id"))
        & (dropff >= pickup)
        & (dropff <= F.timestamp_add("SECOND", F.lit(max_seconds), pickup))
        & (F.col("fare_amount").cast("double") >= 0)
    )


def dedupe(df: DataFrame) -> DataFrame:
    """Drop equal rows. The aggregate combines on the map side, so a mass of copies never travels."""
    return df.dropDuplicates()


def split_ts(df: DataFrame) -> DataFrame:
    pickup, dropff = F.col("pickup_ts"), F.col("dropff_ts")
    return df.withColumns(
        {
            "pickup_date": times.date_part(pickup),
            "pickup_time": times.time_text(pickup),
            "dropff_date": times.date_part(dropff),
            "dropff_time": times.time_text(dropff),
        }
    )


def add_amounts(df: DataFrame) -> DataFrame:
    """Measures as doubles, the sum of the extras, and fare + tip + extras."""
    extras = F.col("extra") + F.col("tolls_amount") + F.col("congestion_surcharge") + F.col("airport_fee")
    measures = {name: F.col(name).cast("double") for name in ("trip_distance", "fare_amount", "tip_amount")}
    return df.withColumns(
        {
            **measures,
            "extra_amount": extras,
            "total_trip_amount": F.col("fare_amount") + F.col("tip_amount") + extras,
        }
    )


def trip_details(raw: DataFrame, alternatives: Mapping[str, Sequence[str]] = ALTERNATIVES) -> DataFrame:
    """Valid trips in the processed schema, copies kept: a narrow job without any shuffle."""
    return _details(valid_trips(harmonise(raw, alternatives)))


def clean_trips(
    raw: DataFrame,
    alternatives: Mapping[str, Sequence[str]] = ALTERNATIVES,
    sort: bool = False,
) -> DataFrame:
    """The whole cleaning job.

    Copies are removed before the unwanted columns go, so rows that differ only in those
    columns survive as equal rows. The derived columns are functions of the raw ones; removing
    copies on the raw row gives the same rows and shuffles less.
    """
    valid = valid_trips(harmonise(drop_any_null(raw), alternatives))
    cleaned = _details(dedupe(valid))
    return cleaned.orderBy(*SORT_KEYS) if sort else cleaned


def _details(valid: DataFrame) -> DataFrame:
    return drop_existing(add_amounts(split_ts(valid)), (*DROPPED, *TIMESTAMPS))


def union_months(months: Mapping[tuple[int, int], DataFrame]) -> DataFrame:
    """Monthly frames as one, keyed by (year, month) and in calendar order."""
    if not months:
        raise ValueError("no months to combine")
    keyed = [
        df.withColumns({"year": F.lit(year), "month": F.lit(month)})
        for (year, month), df in sorted(months.items())
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), keyed)
