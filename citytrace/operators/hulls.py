"""Convex hulls of clusters, combined from partial hulls."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HULL_SCHEMA = "segment string, cluster_id int, seq int, long double, lat double"
FLAT = 1e-12  #: square degrees; a corner that is so little off the line of its neighbours is none


def _hull_function():
    """The hull of a point array as a closure, so workers need no copy of this package."""
    flat = FLAT

    def hull(points):
        points = np.unique(points, axis=0)
        if len(points) < 3:
            return points

        def chain(ordered):
            kept = []
            for x, y in ordered:
                while len(kept) > 1:
                    (ax, ay), (bx, by) = kept[-2], kept[-1]
                    if (bx - ax) * (y - ay) - (by - ay) * (x - ax) > flat:
                        break
                    kept.pop()
                kept.append((x, y))
            return kept[:-1]

        return np.array(chain(points) + chain(points[::-1]))

    return hull


def cluster_hulls(points: DataFrame) -> DataFrame:
    """Corners of each segment's clusters' hulls, counter-clockwise from the leftmost point (the lowest of several).

    Every input partition first reduces its points to one hull per segment and cluster, batch by batch, so a
    cluster with most of the rows sends corners only. Fewer than three points, or points on one
    line, give no hull. Points without a place or a cluster count for none; a NULL segment is one of its own.
    """
    hull = _hull_function()

    def corners_of(segment, cluster, found) -> pd.DataFrame:
        return pd.DataFrame(
            {"segment": segment, "cluster_id": int(cluster), "seq": range(len(found)), "long": found[:, 0], "lat": found[:, 1]}
        )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        corners: dict[tuple, object] = {}
        for batch in batches:
            for (segment, cluster), part in batch.groupby(["segment", "cluster_id"], dropna=False):
                key = (segment if isinstance(segment, str) else None, int(cluster))
                found = part[["long", "lat"]].to_numpy(dtype=np.float64)
                known = corners.get(key)
                corners[key] = hull(found if known is None else np.vstack([known, found]))
        for key, found in corners.items():
            yield corners_of(*key, found)

    def whole(key, part):
        found = hull(part[["long", "lat"]].to_numpy(dtype=np.float64))
        return corners_of(*key, found if len(found) >= 3 else found[:0])

    placed = points.select(F.col("segment").cast("string").alias("segment"), F.col("cluster_id").cast("int").alias("cluster_id"), "long", "lat")
    placed = placed.dropna(subset=["cluster_id", "long", "lat"])
    return placed.mapInPandas(partial, HULL_SCHEMA).groupBy("segment", "cluster_id").applyInPandas(whole, HULL_SCHEMA)
