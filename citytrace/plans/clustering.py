"""Clusters of trip ends for five segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrace.operators import cluster, hulls
from citytrace.sources.artifacts import check_inputs
from citytrace.sources.sinks import write_rows, write_summary

def run_clustering(
    trips: DataFrame,
    zones: DataFrame,
    coords: DataFrame,
    out: str,
    config: cluster.KMeansConfig = cluster.KMeansConfig(),
    displayed: int = cluster.DISPLAYED,
) -> dict[str, DataFrame]:
    """Fit, refine, diagnose and summarise. Trips are scanned once, to count points."""
    check_inputs({"trips": trips, "coordinates": coords})
    points = cluster.weighted_points(trips, coords).persist()
    try:
        centres = cluster.fit_segments(points, config)
        refined = cluster.refine_centres(points, centres)
        write_rows(refined, f"{out}/cluster_centers", "parquet")
        refined = trips.sparkSession.read.parquet(f"{out}/cluster_centers")
        centroids = cluster.borough_centroids(zones, coords)
        write_rows(cluster.label_points(points, refined), f"{out}/labeled_points", "parquet")
        labelled = trips.sparkSession.read.parquet(f"{out}/labeled_points")
        write_rows(hulls.cluster_hulls(labelled), f"{out}/cluster_hulls", "parquet")
        write_rows(cluster.display_points(labelled, displayed), f"{out}/display_points", "parquet")
        shown = trips.sparkSession.read.parquet(f"{out}/display_points")
        write_rows(cluster.cluster_summary(labelled, shown, config.k), f"{out}/cluster_summary", "parquet")
        shares = cluster.borough_share(points, centroids)
        summary = cluster.concentration_summary(cluster.cluster_snapshots(refined, centroids), shares)
        write_rows(summary, f"{out}/concentration", "parquet")
        metadata = cluster.axis_bounds(coords).select(
            F.lit(config.k).alias("selected_k"),
            cluster.segment_point_counts(points)
            .agg(F.map_from_entries(F.collect_list(F.struct("segment", "points"))))
            .scalar()
            .alias("point_counts"),
            F.struct("*").alias("axis_bounds"),
            cluster.refinement_summary(refined).agg(F.collect_list(F.struct("*"))).scalar().alias("refinement_summary"),
            cluster.cluster_diagnostics(points, refined).select(F.struct("*")).scalar().alias("diagnostics"),
        )
        write_summary(metadata, f"{out}/clustering_metadata")
    finally:
        points.unpersist()
    read = trips.sparkSession.read
    return {
        "centers": refined,
        "points": read.parquet(f"{out}/labeled_points"),
        "hulls": read.parquet(f"{out}/cluster_hulls"),
        "displayed": read.parquet(f"{out}/display_points"),
        "summary": read.parquet(f"{out}/cluster_summary"),
        "concentration": read.parquet(f"{out}/concentration"),
        "metadata": read.json(f"{out}/clustering_metadata"),
    }
