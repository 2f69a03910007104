"""Bins and labels of trip attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from citytrace.functions.tokens import safe_text

# Time buckets as [first hour, end hour). Hours 0 to 7 belong to no bucket.
TIME_BUCKETS = {"morning": (8, 12), "afternoon": (12, 16), "evening": (16, 20), "night": (20, 24)}
ALL_DAY = "all"

# Upper edges (exclusive) and labels; the last label takes the rest.
DISTANCE_BINS = ((2, "0-2mi"), (5, "2-5mi"), (10, "5-10mi"), (20, "10-20mi"))
DISTANCE_REST = "20-30mi"
FARE_BINS = (
    (10, "$0-$10"),
    (20, "$10-$20"),
    (40, "$20-$40"),
    (80, "$40-$80"),
    (100, "$80-$100"),
    (140, "$100-$140"),
    (180, "$140-$180"),
    (300, "$180-$300"),
)
FARE_REST = "$300-$1000"

# Texts that mean "no zone known".
UNKNOWN_TEXTS = ("unknown", "nan", "")


def _ladder(value: Column, steps, rest: str) -> Column:
    (edge, label), *others = steps
    chain = F.when(value < edge, F.lit(label))
    return reduce(lambda acc, step: acc.when(value < step[0], F.lit(step[1])), others, chain).otherwise(rest)


def time_bucket(hour: Column) -> Column:
    """Lower-case bucket of an hour, NULL outside 8 to 23."""
    return F.coalesce(
        *[F.when((hour >= lo) & (hour < hi), F.lit(name)) for name, (lo, hi) in TIME_BUCKETS.items()]
    )


def distance_bin(miles: Column) -> Column:
    return _ladder(miles, DISTANCE_BINS, DISTANCE_REST)


def fare_bin(fare: Column) -> Column:
    return _ladder(fare, FARE_BINS, FARE_REST)


def tip_bin(tip: Column, fare: Column) -> Column:
    ratio = F.coalesce(F.try_divide(tip, F.when(fare > 0, fare)), F.lit(0.0))
    return F.when(tip <= 0, "NoTip").otherwise(
        _ladder(ratio, ((0.10, "LowTip"), (0.20, "MidTip")), "HighTip")
    )


def payment_label(code: Column) -> Column:
    return F.when(code == 1, "CreditCard").when(code == 2, "Cash").otherwise("Other")


def is_unknown(text: Column) -> Column:
    return safe_text(text).isin(*UNKNOWN_TEXTS)


def airport_code(zone: Column, borough: Column) -> Column:
    """JFK, LGA or EWR by the words in the zone (EWR also by borough), else NULL."""
    name = safe_text(zone)
    return (
        F.when(name.contains("jfk"), "JFK")
        .when(name.contains("laguardia"), "LGA")
        .when(name.contains("newark") | (safe_text(borough) == "ewr"), "EWR")
    )


def route_type(source_airport: Column, destination_airport: Column) -> Column:
    end = lambda code: F.when(code.isNull(), "city").otherwise("airport")
    return F.concat_ws("_to_", end(source_airport), end(destination_airport))
