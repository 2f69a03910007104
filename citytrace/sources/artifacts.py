"""Reading of written artefacts and checks of job inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_artifact(
    spark: SparkSession,
    path: str,
    required: Sequence[str] = (),
    numeric: Sequence[str] = (),
    fmt: str = "csv",
) -> DataFrame:
    """A stored table; unreadable numbers become NULL, rows without a required value are dropped."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path)
    present = [c for c in numeric if c in df.columns]
    df = df.withColumns({c: F.col(c).try_cast("double") for c in present}) if present else df
    return df.dropna(subset=list(required)) if required else df


def check_inputs(frames: Mapping[str, DataFrame], rules: Mapping[str, Column] | None = None) -> None:
    """Stop the job when a frame is empty or holds a row that breaks a rule.

    ``rules`` maps a message to a condition every row of every frame with its columns must meet.
    Empty frames are found by their first row; rules are counted in one pass per frame.
    """
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"empty input: {', '.join(empty)}")
    for name, df in frames.items() if rules else ():
        broken = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(m) for m, c in rules.items()]).first()
        bad = [message for message in rules if broken[message]]
        if bad:
            raise ValueError(f"{name}: {', '.join(bad)}")
