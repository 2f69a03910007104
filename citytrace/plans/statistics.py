"""The statistics document."""

from __future__ import annotations

from pyspark.sql import DataFrame

from citytrace.operators.stats import statistics_document
from citytrace.sources.artifacts import check_inputs
from citytrace.sources.sinks import write_summary


def run_statistics(trips: DataFrame, zones: DataFrame, coords: DataFrame, out: str) -> DataFrame:
    """Write the document and return it as written, so that later uses repeat no scan of the trips."""
    check_inputs({"trips": trips, "zones": zones})
    document = statistics_document(trips, zones, coords)
    write_summary(document, f"{out}/statistics")
    return trips.sparkSession.read.schema(document.schema).json(f"{out}/statistics")
