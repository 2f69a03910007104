"""Origin-destination flow frame for maps: widths, bins and the middle of the view."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citytrace.operators.lookup import with_coords, with_zones
from citytrace.operators.prepare import filter_window, known_boroughs
from citytrace.operators.stats import od_counts

# The frames here hold the pairs of one map (a top-k result), so one window over them is small.
_ALL = Window.partitionBy


def scale_minmax(df: DataFrame, col: str, low: float, span: float, constant: float, out: str) -> DataFrame:
    """Spread a column over [low, low + span]; a constant where all values are equal."""
    value = F.col(col).cast("double")
    smallest, largest = F.min(value).over(_ALL()), F.max(value).over(_ALL())
    scaled = (value - smallest) / F.nullif(largest - smallest, F.lit(0.0)) * span + low
    return df.withColumn(out, F.coalesce(scaled, F.lit(constant)))


def equal_width_bins(df: DataFrame, col: str, n: int = 4) -> DataFrame:
    """Equal-width bins between minimum and maximum; a value on an inner edge goes up.

    Adds ``bucket_index`` and ``range_label``. Without any spread there is one label and no index.
    """
    value = F.col(col).cast("double")
    smallest, largest = F.min(value).over(_ALL()), F.max(value).over(_ALL())
    step = (largest - smallest) / float(n)
    edge = lambda i: smallest + step * F.lit(i).cast("double")
    index = sum((F.when(value >= edge(i), 1).otherwise(0) for i in range(1, n)), F.lit(0))
    number = lambda c: F.format_number(c.cast("long"), 0)
    lower = F.floor(F.col("_lower")) + F.when(F.col("bucket_index") > 0, 1).otherwise(0)
    binned = df.withColumns(
        {
            "bucket_index": F.when(largest > smallest, index),
            "_lower": edge(F.coalesce(index, F.lit(0))),
            "_upper": F.when(index == n - 1, largest).otherwise(edge(index + 1)),
        }
    )
    label = F.concat(number(lower), F.lit(" - "), number(F.ceil("_upper")), F.lit(" trips"))
    return binned.withColumn(
        "range_label",
        F.when(F.col("bucket_index").isNull(), F.concat(number(value), F.lit(" trips"))).otherwise(label),
    ).drop("_lower", "_upper")


def od_flow(
    df: DataFrame,
    zones: DataFrame,
    coords: DataFrame,
    first_day: dt.date,
    last_day: dt.date,
    first_hour: int = 0,
    end_hour: int = 24,
    k: int = 400,
) -> DataFrame:
    """Busiest pairs of a window with coordinates, zones, widths and trip ranges.

    Trips are counted before any join, so the dimension joins see at most ``k`` rows.
    """
    pairs = od_counts(filter_window(df, first_day, last_day, first_hour, end_hour), k)
    named = with_zones(with_coords(pairs, coords, "inner"), known_boroughs(zones))
    arcs = named.drop("source_borough", "destination_borough")
    wide = scale_minmax(arcs, "trip_count", 1.5, 10.0, 3.0, "line_width")
    styled = scale_minmax(wide, "trip_count", 1.2, 10.0, 4.0, "styled_width")
    return equal_width_bins(styled, "trip_count").orderBy(F.desc("trip_count"), "source_id", "destination_id")


def flow_centre(arcs: DataFrame) -> DataFrame:
    """Middle of a flow map: the mean of the mean origin and the mean destination."""
    middle = lambda axis: (F.avg(f"source_{axis}") + F.avg(f"destination_{axis}")) / 2.0
    return arcs.agg(middle("lat").alias("latitude"), middle("long").alias("longitude"))
