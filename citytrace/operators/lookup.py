"""Joins of trips with the zone, coordinate, calendar and statistics tables.

No join forces a broadcast: Spark measures the lookup side against
``spark.sql.autoBroadcastJoinThreshold`` when it plans and again at run time, and falls back to
a shuffled join that adaptive execution splits where a key is hot. The one exception is a frame
whose size is fixed by its key domain (24 hours). Single-row values are scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citytrace.functions import bins, geo
from citytrace.session import cut_lineage

# Order of boroughs in the location catalogue.
BOROUGH_ORDER = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR")
ENDS = ("source", "destination")


def _both_ends(df: DataFrame, table: DataFrame, cols: Sequence[str]) -> DataFrame:
    """LEFT join of a location table once per trip end, columns prefixed with the end."""
    for end in ENDS:
        side = table.select(F.col("location_id").alias(f"{end}_id"), *[F.col(c).alias(f"{end}_{c}") for c in cols])
        df = df.join(side, f"{end}_id", "left")
    return df


def with_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Add a one-row frame as a struct column. A scalar subquery carries it, not a join."""
    return df.withColumn(name, row.select(F.struct("*")).scalar())


def as_list(df: DataFrame, *order: Column) -> Column:
    """The rows of a short result as one array value in the given order."""
    keys = [key.alias(f"k{i}") for i, key in enumerate(order)]
    entry = F.struct(*keys, F.struct(*df.columns).alias("row"))
    sorted_rows = df.agg(F.sort_array(F.collect_list(entry)).alias("_list"))
    return sorted_rows.select(F.transform("_list", lambda e: e["row"])).scalar()


def with_zones(df: DataFrame, zones: DataFrame) -> DataFrame:
    return _both_ends(df, zones, ("borough", "zone"))


def with_coords(df: DataFrame, coords: DataFrame, how: str = "left") -> DataFrame:
    """Coordinates of both ends; ``how='inner'`` drops rows that lack any of the four."""
    joined = _both_ends(df, coords, ("lat", "long"))
    if how == "inner":
        return joined.dropna(subset=[f"{end}_{axis}" for end in ENDS for axis in ("lat", "long")])
    return joined


def with_labels(df: DataFrame, zones: DataFrame) -> DataFrame:
    """``zone (borough)`` labels of both ends, ``Unknown`` where the zone is missing."""
    joined = with_zones(df, zones)
    names = {
        f"{end}_{c}": F.coalesce(F.col(f"{end}_{c}"), F.lit("Unknown")) for end in ENDS for c in ("zone", "borough")
    }
    label = lambda end: F.concat(names[f"{end}_zone"], F.lit(" ("), names[f"{end}_borough"], F.lit(")"))
    return joined.withColumns({"origin_label": label("source"), "destination_label": label("destination")}).drop(*names)


def with_date_dim(df: DataFrame, dates: DataFrame) -> DataFrame:
    return df.join(dates.withColumnRenamed("date", "pickup_date"), "pickup_date", "inner")


def route_distance(df: DataFrame, coords: DataFrame) -> DataFrame:
    """Great-circle kilometres between the two ends, NULL where a coordinate is missing."""
    points = with_coords(df, coords)
    four = [F.col(f"{end}_{axis}") for end in ENDS for axis in ("lat", "long")]
    return points.withColumn("route_distance_km", geo.haversine_km(*four)).drop(
        *[f"{end}_{axis}" for end in ENDS for axis in ("lat", "long")]
    )


def attach_context(df: DataFrame, context: DataFrame, route: DataFrame, overall: DataFrame) -> DataFrame:
    """Fare statistics of a trip from its context, else its route, else all trips.

    The contexts of a route (48 at most: hours by weekend) are one map beside the route's own numbers,
    so trips are joined once, on their route. That table is written first (a Spark job): its size is
    known when the join is planned, and trips travel only if it is too large for a broadcast.
    """
    keys, names = ["source_id", "destination_id"], ("fare_q1", "fare_median", "fare_q3", "trip_count")
    slot = F.col("pickup_hour").cast("int") * 2 + F.col("is_weekend").cast("int")
    entry = F.struct(slot.alias("slot"), F.struct(*[F.col(f"context_{n}").alias(n) for n in names]).alias("of"))
    contexts = context.where(slot.isNotNull()).groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_slots"))
    routes = cut_lineage(route.join(contexts, keys, "full"))
    joined = df.join(routes, keys, "left").withColumn("_slot", F.try_element_at("_slots", slot))
    pick = lambda name, last: F.coalesce(F.col(f"_slot.{name}"), F.col(f"route_{name}"), F.col(f"_all.{last}"))
    filled = with_row(joined, overall, "_all").withColumns(
        {
            "context_fare_q1": pick("fare_q1", "global_fare_q1"),
            "context_fare_median": pick("fare_median", "global_fare_median"),
            "context_fare_q3": pick("fare_q3", "global_fare_q3"),
            "context_trip_count": pick("trip_count", "global_context_count"),
        }
    )
    return filled.drop("_all", "_slots", "_slot", *[f"route_{n}" for n in names])


def attach_route_prior(df: DataFrame, prior: DataFrame, overall: DataFrame) -> DataFrame:
    keys = ["source_id", "destination_id"]
    joined = with_row(df.join(prior, keys, "left"), overall, "_all")
    filled = {c: F.coalesce(F.col(c), F.col(f"_all.{c}")) for c in prior.columns if c not in keys}
    return joined.withColumns(filled).drop("_all")


def attach_hour_threshold(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Speed thresholds of the pickup hour, else the global ones.

    ``thresholds`` holds one row per hour, 24 at most, so its broadcast is bounded by the key.
    """
    names = ("speed_score_threshold", "speed_mph_threshold")
    by_hour = thresholds.select("pickup_hour", *names)
    every = thresholds.agg(*[F.max(f"global_{n}").alias(n) for n in names])
    joined = with_row(df.join(F.broadcast(by_hour), "pickup_hour", "left"), every, "_all")
    return joined.withColumns({n: F.coalesce(F.col(n), F.col(f"_all.{n}")) for n in names}).drop("_all")


def located(coords: DataFrame) -> DataFrame:
    """Coordinates that are present and finite."""
    return coords.where(
        F.col("location_id").isNotNull()
        & F.col("lat").isNotNull()
        & F.col("long").isNotNull()
        & ~F.isnan("lat")
        & ~F.isnan("long")
    )


def od_points(df: DataFrame, coords: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per known trip end; an unknown end drops out without taking the other one along."""
    ends = df.select(*keep, F.explode(F.array("pickup_location_id", "dropff_location_id")).alias("location_id"))
    return ends.join(located(coords).select("location_id", "long", "lat"), "location_id", "inner")


def nearest(long: Column, lat: Column, centres: Column) -> Column:
    """The struct of the nearest centre: squared degrees, first in order on ties.

    ``centres`` is an array column of structs: the order field first, then long and lat. It must be
    a column of the frame, since a subquery cannot stand inside a higher-order function.
    """
    gap = lambda c: (c["long"] - long) * (c["long"] - long) + (c["lat"] - lat) * (c["lat"] - lat)
    best = F.array_min(F.transform(centres, lambda c: F.struct(gap(c).alias("d2"), c.alias("centre"))))
    return best


def centre_array(centres: DataFrame, order: str, *extra: str) -> Column:
    """Centres as one sorted array value (as many entries as there are clusters or boroughs)."""
    fields = F.struct(F.col(order).alias("ord"), F.col("long"), F.col("lat"), *extra)
    return centres.agg(F.sort_array(F.collect_list(fields))).scalar()


def unsampled_rows(df: DataFrame, sample: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(sample.select(*keys).distinct(), list(keys), "left_anti")


def location_catalog(zones: DataFrame, coords: DataFrame) -> DataFrame:
    """Zones with optional coordinates, a pick-list label and the place of their borough in the list."""
    known = zones.where(F.col("location_id").isNotNull() & ~bins.is_unknown(F.col("borough"))).select(
        "location_id", F.trim("borough").alias("borough"), F.trim("zone").alias("zone")
    )
    place = F.array_position(F.lit(list(BOROUGH_ORDER)), F.col("borough")).cast("int")
    return known.join(coords.select("location_id", "lat", "long"), "location_id", "left").select(
        "location_id",
        "borough",
        "zone",
        F.col("lat").try_cast("double").alias("lat"),
        F.col("long").try_cast("double").alias("long"),
        F.concat_ws(" - ", F.col("location_id").cast("string"), F.col("zone")).alias("option_label"),
        F.when(place > 0, place - 1).otherwise(len(BOROUGH_ORDER)).alias("borough_place"),
    )
