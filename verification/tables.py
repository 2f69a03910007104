"""The driver tables seen as trips, zones and coordinates.

The same mapping is written as leading SQL expressions in ``oracle.py``. Amounts go through whole
cents so that both engines round alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrace.operators.clean import clean_trips
from citytrace.session import checkpoint_dir
from citytrace.sources.trips import read_processed

KEY_SPACE = 1_000_003

# The columns the mapping reads, so that no job is spent on schema inference.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "customer": "c_custkey long, c_nationkey int",
    "supplier": "s_suppkey long, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# Typical sizes of the features, from which the fixed forests take their thresholds.
FEATURE_SCALES = {
    "speed_mph": 4, "trip_distance_miles": 4, "eta_minutes": 16, "fare_amount": 8, "fare_per_mile": 1,
    "fare_per_minute": 0.25, "pickup_hour": 7, "day_of_week": 2, "is_weekend": 0.25, "pickup_hour_sin": 0.25,
    "pickup_hour_cos": 0.25, "context_median_fare": 8, "context_iqr_fare": 8, "context_count_log1p": 1,
    "fare_to_context_median_ratio": 0.25,
}
FIXED_TREES = 24
FIXED_ROWS = 256


def fixed_tree(tree: int, cols: Sequence[str], node: int = 0, level: int = 0):
    """A tree made by rule, (column, threshold, low side, high side) or a depth, that SQL can repeat."""
    if level == 3:
        return 1.0 + (tree * 5 + node * 3) % 8
    k = (tree * 3 + node) % len(cols)
    threshold = FEATURE_SCALES[cols[k]] * (1 + (tree * 7 + node * 5) % 13) / 4
    sides = (fixed_tree(tree, cols, 2 * node + side, level + 1) for side in (1, 2))
    return (k, threshold, *sides)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _cents(value: str, factor: int = 100) -> Column:
    return F.round(F.col(value) * factor).cast("long")


def _half_up(value: Column, divisor: int) -> Column:
    """Whole cents of a non-negative ratio, as money."""
    return F.floor((value + divisor // 2) / divisor).cast("double") / 100.0


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    joined = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    start = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 6007) % 86400
    length = (F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber") * 13) % 7200 - 60
    price, discount = _cents("l_extendedprice"), _cents("l_discount")
    return joined.select(
        F.timestamp_add("SECOND", start, F.col("o_orderdate")).alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", start + length, F.col("o_orderdate")).alias("tpep_dropoff_datetime"),
        F.col("s_nationkey").alias("PULocationID"),
        F.col("c_nationkey").alias("DOLocationID"),
        (F.col("l_quantity") * 0.6).alias("trip_distance"),
        _half_up(price, 1000).alias("fare_amount"),
        _half_up(price * discount, 40000).alias("tip_amount"),
        (1 + (F.col("l_orderkey") + F.col("l_linenumber")) % 4).cast("int").alias("payment_type"),
        (F.col("l_tax") * 10.0).alias("extra"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.0).alias("Airport_fee"),
    )


_WRITTEN: dict[tuple, str] = {}


def written(spark: SparkSession, sf_dir: str, stage: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A stage of a product as a table in the shared folder, as the jobs write theirs.

    It is made once per session and state of the source files (path, time, length); the queries
    that follow scan the columns they need.
    """
    sources = [f"{sf_dir}/{name}.parquet" for name in SCHEMAS]
    files = spark.read.format("binaryFile").load(sources).select("path", "modificationTime", "length")
    state = (spark.sparkContext.applicationId, stage, *sorted(tuple(row) for row in files.collect()))
    if state not in _WRITTEN:
        path = f"{checkpoint_dir(spark)}/{stage}-{uuid.uuid4().hex}"
        make().write.parquet(path)
        _WRITTEN[state] = path
    return read_processed(spark, _WRITTEN[state])


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trips in the processed schema, as the products read them.

    The removal of copies deals different rows by the hash of all their columns, so the files are even
    whatever the keys of the source tables are.
    """
    return written(spark, sf_dir, "trips", lambda: clean_trips(raw_trips(spark, sf_dir)))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        key.alias("location_id"),
        F.when(key <= 2, "EWR").when(key == 24, "Unknown").otherwise(F.col("r_name")).alias("borough"),
        F.when(key == 0, "JFK Airport")
        .when(key == 1, "LaGuardia Airport")
        .when(key == 2, "Newark Airport")
        .when(key == 24, "Unknown")
        .otherwise(F.col("n_name"))
        .alias("zone"),
    )


def coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.cast("long").alias("location_id"),
        F.when(key != 24, ((key * 37) % 25) * 0.015 + 40.55).alias("lat"),
        F.when(key != 24, ((key * 11) % 25) * 0.02 + F.lit(-74.2)).alias("long"),
    )


def row_key() -> Column:
    """A number below KEY_SPACE from the content of a trip."""
    clock = F.col("pickup_time")
    seconds = (
        F.substring(clock, 1, 2).cast("long") * 3600
        + F.substring(clock, 4, 2).cast("long") * 60
        + F.substring(clock, 7, 2).cast("long")
    )
    return (
        F.col("pickup_location_id").cast("long") * 7919
        + F.col("dropff_location_id").cast("long") * 104729
        + F.unix_date("pickup_date").cast("long") * 613
        + seconds * 31
        + _cents("fare_amount") * 17
    ) % KEY_SPACE


def checked(df: DataFrame) -> DataFrame:
    """Doubles to six digits.

    The shift keeps averages of cents off the rounding tie (32 trips give a 7-digit average that
    ends in 5), where the last bit of a sum would decide.
    """
    return df.select(
        *[
            F.round(F.col(name) + 1e-9, 6).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )
