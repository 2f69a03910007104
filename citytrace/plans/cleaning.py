"""Raw monthly files to the processed table and its reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citytrace.operators.clean import clean_trips
from citytrace.operators.stats import date_dim
from citytrace.sources.artifacts import check_inputs
from citytrace.sources.sinks import write_processed, write_rows
from citytrace.sources.trips import read_processed, read_trips
from citytrace.sources.zones import load_zones, zone_centroids, zone_coordinates


def run_cleaning(
    spark: SparkSession, raw_folder: str, out: str, zone_csv: str | None = None, vertices: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Clean all months, write them partitioned, and derive the reference tables from the written table."""
    # Copies are looked for within a month: the file's month is one of the columns compared.
    cleaned = read_trips(spark, raw_folder, each=lambda df: clean_trips(df, alternatives={}))
    write_processed(cleaned, f"{out}/trip_details")
    tables = {"trip_details": read_processed(spark, f"{out}/trip_details")}
    check_inputs({"cleaned trips": tables["trip_details"]})
    tables["date_day_data"] = date_dim(tables["trip_details"])
    if zone_csv:
        tables["location_zone_data"] = load_zones(spark, zone_csv)
    if zone_csv and vertices is not None:
        tables["location_coordinates_data"] = zone_coordinates(
            tables["location_zone_data"], zone_centroids(vertices)
        )
    for name in tables.keys() - {"trip_details"}:
        write_rows(tables[name], f"{out}/{name}", "parquet")
        tables[name] = spark.read.parquet(f"{out}/{name}")
    return tables
