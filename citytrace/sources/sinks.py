"""Writers: every output is one Spark job, counted while it is written."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

TABLE_NAME = r"[A-Za-z_][A-Za-z0-9_]*"
# Order of the month tables, then the reference tables.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
REFERENCE_TABLES = ("location_zone_data", "location_coordinates_data", "date_day_data")
JDBC_BATCH = 5000
STAGED, FORMER = "__staged", "__former"  #: endings of tables while one replaces the other


def write_processed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Trip details partitioned by year and month, those of the file if known, else of the pickup.

    The rebalance hint gathers a month into few files and lets adaptive execution split a month
    that holds most of the rows; rows are ordered by pickup date within a task, so parquet
    statistics prune date ranges.
    """
    day = F.col("pickup_date")
    derived = {name: part(day) for name, part in (("year", F.year), ("month", F.month)) if name not in df.columns}
    keyed = (df.withColumns(derived) if derived else df).hint("rebalance", "year", "month")
    ordered = keyed.sortWithinPartitions("year", "month", *[c for c in ("pickup_date", "pickup_time") if c in df.columns])
    ordered.write.mode("overwrite").partitionBy("year", "month").option("header", True).format(fmt).save(path)


def table_order(name: str) -> tuple[int, int, str]:
    """Months in calendar order (years in order), then the reference tables, then the rest."""
    match = re.fullmatch(r"trip_details_(?:(\d{4})_)?([a-z]{3})", name)
    if match and match[2] in MONTHS:
        return (0, int(match[1] or 0) * 12 + MONTHS.index(match[2]), name)
    return (1, REFERENCE_TABLES.index(name) if name in REFERENCE_TABLES else len(REFERENCE_TABLES), name)


def load_tables(
    tables: Mapping[str, DataFrame], save: Callable[[DataFrameWriter, str], None] | None = None
) -> dict[str, int]:
    """Replace each named table and return the rows written.

    The default target is the session catalogue: a table is written under a name of its own, its rows are
    counted against those sent, and only then it takes the place of the former one. A load that fails leaves
    the former table, also when the frame reads it. ``jdbc_target`` gives a target in a database, which
    replaces tables directly. An empty frame still replaces the table and keeps its schema.
    """
    bad = [name for name in tables if not re.fullmatch(TABLE_NAME, name)]
    if bad:
        raise ValueError(f"invalid table names: {bad}")
    counts = {}
    for name in sorted(tables, key=table_order):
        seen = Observation()
        writer = tables[name].observe(seen, F.count(F.lit(1)).alias("rows")).write
        if save:
            save(writer, name)
            counts[name] = int(seen.get["rows"])
            continue
        spark = tables[name].sparkSession
        restore_table(spark, name)
        staged = name + STAGED
        spark.sql(f"DROP TABLE IF EXISTS `{staged}`")
        try:
            writer.saveAsTable(staged)
            counts[name] = int(seen.get["rows"])
            found = spark.table(staged).count()
            if found != counts[name]:
                raise RuntimeError(f"{name}: {counts[name]} rows sent, {found} found")
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS `{staged}`")
            raise
        _swap(spark, staged, name)
    return counts


def restore_table(spark: SparkSession, name: str) -> None:
    """Bring back the former table where a session ended between the two renames of a swap."""
    if spark.catalog.tableExists(name + FORMER):
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE `{name + FORMER}`")
        else:
            spark.sql(f"ALTER TABLE `{name + FORMER}` RENAME TO `{name}`")


def _swap(spark: SparkSession, staged: str, name: str) -> None:
    """The staged table takes the name; the former table goes last."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE `{name}` RENAME TO `{name + FORMER}`")
    try:
        spark.sql(f"ALTER TABLE `{staged}` RENAME TO `{name}`")
    finally:
        restore_table(spark, name)


def jdbc_target(url: str, properties: Mapping[str, str], batch: int = JDBC_BATCH):
    """Save function for ``load_tables`` that writes to a database in batches."""

    def save(writer: DataFrameWriter, name: str) -> None:
        writer.mode("overwrite").option("batchsize", batch).jdbc(url, name, properties=dict(properties))

    return save


def write_rows(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Rows of a result, such as all anomalies of one kind."""
    df.write.mode("overwrite").option("header", True).format(fmt).save(path)


def write_summary(row: DataFrame, path: str) -> None:
    """A one-row nested frame as JSON."""
    row.write.mode("overwrite").json(path)


def save_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Priors, thresholds and other model inputs as parquet tables below one folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
