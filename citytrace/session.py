"""Session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "citytrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and one explicit zone, so wall-clock text never shifts."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; where none is named, one beside the tables of a local session.

    Only a local master may go without the setting: there the warehouse folder is the only disk.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_KEY)
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can read")
    scratch = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stages-{context.applicationId}"
    context.setCheckpointDir(scratch)
    return scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: later reads take the columns they need, and
    a lost executor never repeats the work above it."""
    path = f"{checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
