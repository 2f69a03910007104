"""Monthly raw trip files and processed trip tables."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citytrace.operators.clean import ALTERNATIVES, harmonise

# Fixed value: name of a monthly file.
MONTH_FILE = r"yellow_tripdata_(\d{4})-(\d{2})\.parquet$"

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("pickup_location_id", T.IntegerType()),
        T.StructField("dropff_location_id", T.IntegerType()),
        T.StructField("pickup_date", T.DateType()),
        T.StructField("pickup_time", T.StringType()),
        T.StructField("dropff_date", T.DateType()),
        T.StructField("dropff_time", T.StringType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("extra_amount", T.DoubleType()),
        T.StructField("total_trip_amount", T.DoubleType()),
    ]
)


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Files of a folder on any file system Spark reads; the content column is never touched."""
    try:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        found = sorted(row["path"] for row in listing.select("path").collect())
    except AnalysisException as missing:
        raise FileNotFoundError(f"no folder {folder}") from missing
    if not found:
        raise FileNotFoundError(f"no files {pattern} under {folder}")
    return found


def month_of(path: str) -> tuple[int, int]:
    """(year, month) of a monthly file name."""
    match = re.search(MONTH_FILE, path)
    if not match or not 1 <= int(match[2]) <= 12:
        raise ValueError(f"unexpected file name: {path.rsplit('/', 1)[-1]}")
    return int(match[1]), int(match[2])


def read_trips(
    spark: SparkSession,
    folder: str,
    alternatives: Mapping[str, Sequence[str]] = ALTERNATIVES,
    each: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Raw trips of all monthly files with harmonised names and the year and month of their file.

    Files of one schema are read as one scan, so the number of scans is the number of schema
    variants. ``each`` runs on every scan before they are united: a step that looks at all columns
    must not see the NULLs of columns that only other months have.
    """
    by_schema: dict[str, list[str]] = defaultdict(list)
    for path in list_files(spark, folder, "yellow_tripdata_*.parquet"):
        month_of(path)
        by_schema[spark.read.parquet(path).schema.json()].append(path)
    name = F.col("_metadata.file_name")
    part = lambda group: F.regexp_extract(name, MONTH_FILE, group).cast("int")
    frames = [
        each(harmonise(spark.read.parquet(*paths).withColumns({"year": part(1), "month": part(2)}), alternatives))
        for paths in by_schema.values()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_trip_csv(spark: SparkSession, paths: Sequence[str], schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """CSV files with headers, united by column name under an explicit schema.

    Files with one header are one scan. A column a file lacks is NULL; unreadable text is NULL.
    """
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path in paths:
        by_header[tuple(spark.read.option("header", True).csv(path).columns)].append(path)
    if not by_header:
        raise FileNotFoundError("no trip files given")

    def scan(header: tuple[str, ...], files: list[str]) -> DataFrame:
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        rows = spark.read.option("header", True).schema(text).csv(files)
        return rows.select(
            *[
                (F.col(f.name) if f.name in header else F.lit(None)).try_cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )

    return reduce(lambda a, b: a.unionByName(b), [scan(h, files) for h, files in by_header.items()])


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """The processed parquet table, partitioned by year and month."""
    return spark.read.parquet(path)
