"""Zone lookup, polygon centroids and the coordinate table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citytrace.functions.geo import ConicProjection
from citytrace.operators.clean import drop_existing

ZONE_COLUMNS = ("location_id", "borough", "zone")


def load_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV under its three column names, in id order."""
    raw = spark.read.option("header", True).csv(path)
    named = drop_existing(raw, ["service_zone"]).withColumnsRenamed(
        {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}
    )
    missing = [c for c in ZONE_COLUMNS if c not in named.columns]
    if missing:
        raise ValueError(f"zone lookup lacks columns {missing}")
    return named.select(F.col("location_id").try_cast("int").alias("location_id"), "borough", "zone").orderBy(
        "location_id"
    )


def zone_centroids(vertices: DataFrame, crs: ConicProjection | None = None) -> DataFrame:
    """Area centroid of each zone as latitude and longitude.

    ``vertices`` holds (location_id, ring, seq, x, y), rings in the order of the polygon file:
    holes run against their outer ring, so their signed area is subtracted. Edges come from an
    equi-join of neighbouring vertices, which spreads one huge polygon over all tasks.
    """
    crs = crs or ConicProjection()
    rings = ["location_id", "ring"]
    points = vertices.select(*rings, "seq", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    ends = points.groupBy(*rings).agg(
        F.max("seq").alias("_last"),
        F.min_by("x", "seq").alias("x1"),
        F.min_by("y", "seq").alias("y1"),
    )
    following = points.select(
        *rings, (F.col("seq") - 1).alias("seq"), F.col("x").alias("x1"), F.col("y").alias("y1")
    )
    # An open ring closes itself: its last vertex is joined to the first one.
    closing = points.join(ends, rings, "inner").where(F.col("seq") == F.col("_last"))
    edges = points.join(following, [*rings, "seq"], "inner").unionByName(closing.drop("_last"))
    cross = F.col("x") * F.col("y1") - F.col("x1") * F.col("y")
    sums = edges.groupBy("location_id").agg(
        F.sum(cross).alias("_a"),
        F.sum((F.col("x") + F.col("x1")) * cross).alias("_x"),
        F.sum((F.col("y") + F.col("y1")) * cross).alias("_y"),
    )
    area = F.nullif(F.col("_a") * 3.0, F.lit(0.0))
    lat, long = crs.inverse(F.col("_x") / area, F.col("_y") / area)
    return sums.select(F.col("location_id").cast("long").alias("location_id"), lat.alias("lat"), long.alias("long"))


def zone_coordinates(zones: DataFrame, centroids: DataFrame) -> DataFrame:
    """Every zone id once, with its coordinate or NULL."""
    ids = zones.select(F.col("location_id").cast("long").alias("location_id")).distinct()
    first = F.row_number().over(Window.partitionBy("location_id").orderBy("lat", "long"))
    single = centroids.withColumn("_n", first).where(F.col("_n") == 1).drop("_n")
    return ids.join(single, "location_id", "left").select("location_id", "lat", "long")
