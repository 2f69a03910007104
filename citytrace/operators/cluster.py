"""Spatial clusters of trip ends.

A trip end is the coordinate of its zone, so a segment has at most one distinct point per zone.
Every operator works on these weighted points: the trips are counted once by (zone, hour) with
map-side combining, and everything after that count is as small as the zone table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citytrace.functions import bins, numeric, times
from citytrace.operators.lookup import centre_array, located, nearest
from citytrace.operators.prepare import known_boroughs, segments_of

K = 5
SEED = 42
SEGMENTS = (*bins.TIME_BUCKETS, bins.ALL_DAY)
PAD = 0.01
DISPLAYED = 25_000  #: points of a segment that a map shows
# The view when there is nothing to show.
EMPTY_BOUNDS = {"x_long_min": -74.10, "x_long_max": -73.70, "y_lat_min": 40.55, "y_lat_max": 40.92}
SEGMENT_LABELS = {
    "morning": "Morning",
    "afternoon": "Afternoon",
    "evening": "Evening",
    "night": "Night",
    "all": "Full Day",
}


@dataclass(frozen=True)
class KMeansConfig:
    k: int = K
    seed: int = SEED
    rounds: int = 220


def weighted_points(df: DataFrame, coords: DataFrame) -> DataFrame:
    """(segment, location, long, lat, weight): distinct trip-end points with their number of trips."""
    hour = times.hour_of_text(F.col("pickup_time"))
    ends = df.select(
        F.explode(F.array("pickup_location_id", "dropff_location_id")).alias("location_id"), hour.alias("_hour")
    )
    counted = ends.groupBy("location_id", "_hour").agg(F.count(F.lit(1)).alias("_n"))
    placed = counted.join(located(coords).select("location_id", "long", "lat"), "location_id", "inner")
    return (
        placed.withColumn("segment", F.explode(segments_of(F.col("_hour"))))
        .groupBy("segment", "location_id", "long", "lat")
        .agg(F.sum("_n").alias("weight"))
    )


def segment_point_counts(points: DataFrame) -> DataFrame:
    return points.groupBy("segment").agg(F.sum("weight").alias("points"))


def fit_segments(points: DataFrame, config: KMeansConfig = KMeansConfig()) -> DataFrame:
    """Centres of one weighted k-means per segment. Runs Spark jobs on a few hundred points each."""
    vectors = VectorAssembler(inputCols=["long", "lat"], outputCol="_xy").transform(points).persist()
    try:
        frames = []
        for segment in SEGMENTS:
            part = vectors.where(F.col("segment") == segment)
            if part.isEmpty():
                raise ValueError(f"no points in segment {segment!r}")
            model = KMeans(
                featuresCol="_xy", weightCol="weight", k=config.k, seed=config.seed, maxIter=config.rounds
            ).fit(part)
            frames += [
                (segment, i, float(centre[0]), float(centre[1])) for i, centre in enumerate(model.clusterCenters())
            ]
    finally:
        vectors.unpersist()
    return points.sparkSession.createDataFrame(
        frames, "segment string, cluster_id int, center_long double, center_lat double"
    )


def _centres(centres: DataFrame) -> Column:
    """Map from segment to its sorted array of centres: segments * k entries."""
    entry = F.struct(
        F.col("cluster_id").alias("ord"), F.col("center_long").alias("long"), F.col("center_lat").alias("lat")
    )
    arrays = centres.groupBy("segment").agg(F.sort_array(F.collect_list(entry)).alias("_a"))
    return arrays.agg(F.map_from_entries(F.collect_list(F.struct("segment", "_a")))).scalar()


def label_points(points: DataFrame, centres: DataFrame) -> DataFrame:
    """The nearest centre of every point and its squared distance in degrees."""
    by_segment = F.try_element_at(_centres(centres), F.col("segment"))
    best = points.withColumn("_centres", by_segment).withColumn(
        "_best", nearest(F.col("long"), F.col("lat"), F.col("_centres"))
    )
    return best.select(*points.columns, F.col("_best.centre.ord").alias("cluster_id"), F.col("_best.d2").alias("d2"))


def refine_centres(points: DataFrame, centres: DataFrame) -> DataFrame:
    """Centres as the exact mean of their points; an empty cluster keeps its place."""
    mean = lambda axis: F.sum(F.col(axis) * F.col("weight")) / F.sum("weight")
    means = (
        label_points(points, centres)
        .groupBy("segment", "cluster_id")
        .agg(mean("long").alias("_long"), mean("lat").alias("_lat"), F.sum("weight").alias("_n"))
    )
    return centres.join(means, ["segment", "cluster_id"], "left").select(
        "segment",
        "cluster_id",
        F.coalesce("_long", "center_long").alias("center_long"),
        F.coalesce("_lat", "center_lat").alias("center_lat"),
        F.coalesce("_n", F.lit(0).cast("long")).alias("cluster_count"),
    )


def refinement_summary(refined: DataFrame) -> DataFrame:
    return refined.groupBy("segment").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("cluster_id", "cluster_count"))), lambda c: c["cluster_count"]
        ).alias("cluster_counts"),
        F.count_if(F.col("cluster_count") == 0).alias("empty_clusters"),
    )


def silhouettes(labelled: DataFrame) -> DataFrame:
    """Exact Euclidean silhouette of each segment over all its points.

    A zone's points share one place, so the distances of a point to a cluster are sums over zones with their
    weights. The zones of a segment travel with each of its rows as one array; there are as many as zones exist,
    whatever the number of trips. A point that is alone in its cluster counts 0; one cluster alone gives NULL.
    """
    zone = F.struct("cluster_id", "long", "lat", F.col("weight").cast("double").alias("w"))
    zones = labelled.groupBy(F.col("segment").alias("_of")).agg(F.collect_list(zone).alias("_zones"))
    rows = labelled.join(zones, F.col("segment") == F.col("_of"))
    apart = lambda z: F.hypot(z["long"] - F.col("long"), z["lat"] - F.col("lat"))

    def cluster_sums(c: Column) -> Column:
        start = F.struct(c.alias("c"), F.lit(0.0).alias("d"), F.lit(0.0).alias("w"))
        add = lambda s, z: F.struct(s["c"].alias("c"), (s["d"] + z["w"] * apart(z)).alias("d"), (s["w"] + z["w"]).alias("w"))
        return F.aggregate(F.filter("_zones", lambda z: z["cluster_id"] == c), start, add)

    clusters = F.array_distinct(F.transform("_zones", lambda z: z["cluster_id"]))
    rows = rows.withColumn("_sums", F.transform(clusters, cluster_sums))
    own = F.filter("_sums", lambda s: s["c"] == F.col("cluster_id"))[0]
    near = F.array_min(F.transform(F.filter("_sums", lambda s: s["c"] != F.col("cluster_id")), lambda s: s["d"] / s["w"]))
    rows = rows.select("segment", "weight", own.alias("own"), near.alias("b"))
    a = F.col("own.d") / (F.col("own.w") - 1)
    each = F.when(F.col("b").isNull(), None).when(F.col("own.w") <= 1, 0.0)
    each = each.otherwise(F.coalesce(F.try_divide(F.col("b") - a, F.greatest("b", a)), F.lit(0.0)))
    return rows.groupBy("segment").agg((F.sum(each * F.col("weight")) / F.sum("weight")).alias("silhouette"))


def cluster_diagnostics(points: DataFrame, centres: DataFrame) -> DataFrame:
    """Inertia and Euclidean silhouette of the whole-day clusters over all points."""
    labelled = label_points(points.where(F.col("segment") == bins.ALL_DAY), centres)
    return labelled.agg(
        F.countDistinct("cluster_id").cast("int").alias("k"),
        F.sum(F.col("d2") * F.col("weight")).alias("inertia"),
        silhouettes(labelled).select("silhouette").scalar().alias("silhouette"),
    )


def borough_centroids(zones: DataFrame, coords: DataFrame) -> DataFrame:
    """Mean coordinate and number of locations of each known borough."""
    known = known_boroughs(zones.withColumn("borough", F.trim("borough")))
    return (
        known.join(coords, "location_id", "inner")
        .groupBy("borough")
        .agg(
            F.avg("long").alias("long"),
            F.avg("lat").alias("lat"),
            F.countDistinct("location_id").alias("location_count"),
        )
    )


def nearest_borough(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """Name of the borough whose centroid is nearest; ``Unknown`` without any centroid."""
    boroughs = centre_array(centroids.where(F.col("long").isNotNull() & F.col("lat").isNotNull()), "borough")
    best = nearest(F.col("long"), F.col("lat"), F.col("_centres"))["centre"]["ord"]
    named = points.withColumn("_centres", boroughs)
    return named.withColumn("nearest_borough", F.coalesce(best, F.lit("Unknown"))).drop("_centres")


def borough_share(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """Share of each segment's points per nearest borough."""
    counts = nearest_borough(points, centroids).groupBy("segment", "nearest_borough").agg(F.sum("weight").alias("points"))
    total = F.sum("points").over(Window.partitionBy("segment"))
    return counts.select(
        "segment",
        F.col("nearest_borough").alias("borough"),
        "points",
        numeric.percent(F.col("points"), total, 2).alias("share_pct"),
    )


def cluster_snapshots(refined: DataFrame, centroids: DataFrame) -> DataFrame:
    """Every cluster with its count, share of the segment and nearest borough."""
    total = F.sum("cluster_count").over(Window.partitionBy("segment"))
    named = nearest_borough(
        refined.withColumnsRenamed({"center_long": "long", "center_lat": "lat"}), centroids
    )
    return named.select(
        "segment",
        "cluster_id",
        F.col("cluster_count").alias("total_count"),
        numeric.percent(F.col("cluster_count"), total, 2).alias("share_pct"),
        F.col("long").alias("center_long"),
        F.col("lat").alias("center_lat"),
        "nearest_borough",
    )


def display_points(labelled: DataFrame, n: int = DISPLAYED) -> DataFrame:
    """Cells of zone and cluster with the number of their points that a map of ``n`` points a segment shows.

    Clusters get their share of ``n`` and one point at least, which the largest cluster makes up for; zones get
    their share of the cluster's. What is left goes to the largest remainders. Only counts are read, so totals stay those of all points.
    """
    cells = labelled.groupBy("segment", "cluster_id", "location_id", "long", "lat").agg(F.sum("weight").alias("weight"))
    of = lambda *keys: Window.partitionBy("segment", *keys)
    clusters = cells.groupBy("segment", "cluster_id").agg(F.sum("weight").alias("size"))
    total = F.sum("size").over(of())
    part = clusters.withColumn("_all", total).withColumn("_n", F.least(F.lit(n).cast("long"), "_all") * F.col("size"))
    part = part.withColumn("_base", F.greatest(F.expr("_n div _all"), F.lit(1).cast("long")))
    left = F.least(F.lit(n).cast("long"), "_all") - F.sum("_base").over(of())
    turn = F.row_number().over(of().orderBy(F.desc(F.col("_n") % F.col("_all")), "cluster_id"))
    over = F.when(F.row_number().over(of().orderBy(F.desc("size"), "cluster_id")) == 1, F.greatest(-left, F.lit(0))).otherwise(0)
    quota = F.greatest(F.least("size", F.col("_base") + (turn <= left).cast("long")) - over, F.lit(1).cast("long"))
    quotas = part.select("segment", "cluster_id", "size", quota.alias("_quota"))
    dealt = cells.join(quotas, ["segment", "cluster_id"]).withColumn("_n", F.col("_quota") * F.col("weight"))
    dealt = dealt.withColumn("_base", F.expr("_n div size"))
    rest = F.col("_quota") - F.sum("_base").over(of("cluster_id"))
    place = F.row_number().over(of("cluster_id").orderBy(F.desc(F.col("_n") % F.col("size")), "location_id"))
    shown = (F.col("_base") + (place <= rest).cast("long")).alias("display_count")
    return dealt.select("segment", "location_id", "long", "lat", "cluster_id", shown).where("display_count > 0")


def cluster_summary(labelled: DataFrame, shown: DataFrame, k: int = K) -> DataFrame:
    """Dense rows per segment and cluster: all points, displayed points and their percentage."""
    count = lambda df, weight, name: df.groupBy("segment", "cluster_id").agg(F.sum(weight).alias(name))
    spine = labelled.select("segment").distinct().select(
        "segment", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cluster_id")
    )
    keys = ["segment", "cluster_id"]
    joined = spine.join(count(labelled, "weight", "_all"), keys, "left").join(count(shown, "display_count", "_shown"), keys, "left")
    total, display = (F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("_all", "_shown"))
    return joined.select(
        *keys,
        display.alias("display_count"),
        total.alias("total_count"),
        numeric.percent(display, total, 2).alias("display_pct_of_cluster"),
    )


def bounds(points: DataFrame, centres: DataFrame, pad: float = PAD) -> DataFrame:
    """Padded box around points and centres; a fixed box when both are empty."""
    both = points.select("long", "lat").unionByName(
        centres.select(F.col("center_long").alias("long"), F.col("center_lat").alias("lat"))
    )
    box = both.agg(
        (F.min("long") - pad).alias("x_long_min"),
        (F.max("long") + pad).alias("x_long_max"),
        (F.min("lat") - pad).alias("y_lat_min"),
        (F.max("lat") + pad).alias("y_lat_max"),
    )
    return box.select(*[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in EMPTY_BOUNDS.items()])


def axis_bounds(coords: DataFrame, pad: float = PAD) -> DataFrame:
    """Padded box of the coordinate table."""
    nothing = coords.limit(0).select(F.col("long").alias("center_long"), F.col("lat").alias("center_lat"))
    return bounds(located(coords), nothing, pad)


def cluster_payload(
    labelled: DataFrame, refined: DataFrame, centroids: DataFrame, segment: str, n: int = DISPLAYED, k: int = K
) -> dict[str, DataFrame]:
    """Map payload of one segment as frames: totals, shown points, summary, bounds, centres, borough labels."""
    if segment not in SEGMENTS:
        raise ValueError(f"segment must be one of {SEGMENTS}")
    points = labelled.where((F.col("segment") == segment) & F.col("cluster_id").between(0, k - 1))
    centres = refined.where(F.col("segment") == segment)
    shown = display_points(points, n)
    count = lambda df, weight, name: df.agg(F.coalesce(F.sum(weight), F.lit(0).cast("long")).alias(name))
    return {
        "totals": count(points, "weight", "total_points_available").select(
            F.lit(segment).alias("segment"),
            F.lit(k).alias("selected_k"),
            "total_points_available",
            count(shown, "display_count", "display_points_count").scalar().alias("display_points_count"),
        ),
        "points": shown,
        "cluster_summary": cluster_summary(points, shown, k),
        "bounds": bounds(shown, centres),
        "centers": centres.select("cluster_id", "center_long", "center_lat"),
        "borough_labels": centroids,
    }


def top2_share(snapshots: DataFrame, id_col: str, count_col: str, share_col: str = "share_pct") -> DataFrame:
    """Largest and second largest entry per segment; a single entry also stands in for the second."""
    turn = F.row_number().over(Window.partitionBy("segment").orderBy(F.desc(count_col), id_col))
    ranked = snapshots.withColumn("_turn", turn).where(F.col("_turn") <= 2)
    at = lambda n, col: F.max(F.when(F.col("_turn") == n, F.col(col)))
    second = lambda col: F.coalesce(at(2, col), at(1, col))
    return ranked.groupBy("segment").agg(
        at(1, id_col).alias("first"),
        at(1, share_col).alias("first_share_pct"),
        second(id_col).alias("second"),
        second(share_col).alias("second_share_pct"),
        F.round(at(1, share_col) + second(share_col), 2).alias("top2_share_pct"),
        F.count(F.lit(1)).cast("int").alias("entries"),
    )


def segment_extremes(ranked: DataFrame) -> DataFrame:
    """Labels of the most concentrated and the most distributed period, calendar order on ties."""
    label = F.coalesce(*[F.when(F.col("segment") == key, F.lit(text)) for key, text in SEGMENT_LABELS.items()])
    place = F.array_position(F.lit(list(SEGMENTS)), F.col("segment")).cast("int")
    period = ranked.where(F.col("segment") != bins.ALL_DAY).withColumn("_place", place)
    return period.agg(
        F.min_by(label, F.struct(-F.col("first_share_pct"), "_place")).alias("most_concentrated_period"),
        F.min_by(label, F.struct("top2_share_pct", "_place")).alias("most_distributed_period"),
    )


def segment_gap(ranked: DataFrame) -> DataFrame:
    """Percentage points between the top-2 shares of afternoon and evening."""
    of = lambda name: F.max(F.when(F.col("segment") == name, F.col("top2_share_pct")))
    return ranked.agg(F.round(of("afternoon") - of("evening"), 2).alias("concentration_gap"))


def concentration_summary(snapshots: DataFrame, shares: DataFrame) -> DataFrame:
    """One row per segment: dominant clusters and boroughs, plus the period extremes and the gap."""
    clusters = top2_share(snapshots, "cluster_id", "total_count")
    boroughs = top2_share(shares, "borough", "points").select(
        "segment",
        F.col("first").alias("top_borough"),
        F.col("first_share_pct").alias("top_borough_pct"),
        F.col("second").alias("second_borough"),
        F.when(F.col("entries") > 1, F.col("second_share_pct")).otherwise(0.0).alias("second_borough_pct"),
        F.when(F.col("entries") > 1, F.concat_ws(" + ", "first", "second")).otherwise(F.col("first")).alias(
            "top_2_boroughs"
        ),
        F.when(F.col("entries") > 1, F.col("top2_share_pct")).otherwise(F.col("first_share_pct")).alias(
            "top_2_borough_pct"
        ),
    )
    extremes = segment_extremes(clusters).select(F.struct("*")).scalar()
    gap = segment_gap(clusters).scalar()
    named = clusters.withColumnsRenamed(
        {
            "first": "dominant_cluster_id",
            "first_share_pct": "dominant_cluster_share_pct",
            "second": "second_cluster_id",
            "second_share_pct": "second_cluster_share_pct",
        }
    ).drop("entries")
    return named.join(boroughs, "segment", "left").select(
        "*",
        extremes["most_concentrated_period"].alias("most_concentrated_period"),
        extremes["most_distributed_period"].alias("most_distributed_period"),
        gap.alias("concentration_gap"),
    )
