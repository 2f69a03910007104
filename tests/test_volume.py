"""What the shared steps of the large queries may move and compute."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from citytrace.operators import anomaly, lookup, prepare, quantiles
from verification import catalog, tables


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_trips_are_dealt_once(spark, sf_dir, monkeypatch):
    made = {}
    monkeypatch.setattr(tables, "written", lambda spark, sf, stage, make: made.setdefault(stage, make()))
    tables.trips(spark, sf_dir)
    assert "roundrobin" not in plan(made["trips"]).lower()


def test_clock_texts_are_read_once(spark, sf_dir):
    trips = tables.trips(spark, sf_dir)
    for make in (prepare.prepare_anomaly, prepare.prepare_forecast):
        assert plan(make(trips)).count("concat_ws") <= 2


def test_routes_are_broadcast_with_known_size(spark, sf_dir):
    prepared = catalog._prepared(spark, sf_dir)
    joined = lookup.attach_context(prepared, *catalog._stats(spark, sf_dir))
    assert "SortMergeJoin" not in plan(joined) and "BroadcastHashJoin" in plan(joined)


def test_flags_are_not_written(spark, sf_dir, monkeypatch):
    catalog._thresholds(spark, sf_dir)
    stages, written = [], catalog.written
    monkeypatch.setattr(catalog, "written", lambda spark, sf, stage, make: (stages.append(stage), written(spark, sf, stage, make))[1])
    catalog._flagged(spark, sf_dir)
    assert "flagged" not in stages


def test_only_wanted_slices_travel(spark, monkeypatch):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({"h": rng.integers(0, 24, 60_000), "v": rng.normal(0, 40, 60_000)})
    kept, cut = [], quantiles.cut_lineage
    monkeypatch.setattr(quantiles, "cut_lineage", lambda df: (kept.append(cut(df)), kept[-1])[1])
    got = quantiles.stacked_quantiles(spark.createDataFrame(data), {"v": {"a": 0.02, "b": 0.985}}, "h").collect()
    assert sum(df.count() for df in kept) < len(data) / 10
    for row in got:
        vs = data["v"] if row["h"] is None else data["v"][data["h"] == row["h"]]
        np.testing.assert_allclose((row["a"], row["b"]), np.quantile(vs, (0.02, 0.985)), rtol=1e-12)
    assert len(got) == 25


def test_counted_contexts_are_not_counted_again(spark, sf_dir):
    counts = anomaly.fare_counts(catalog._prepared(spark, sf_dir))
    again = anomaly.context_stats(counts.select("*"))
    plain = anomaly.context_stats(catalog._prepared(spark, sf_dir))
    assert again.exceptAll(plain).count() == 0 and again.count() == plain.count()
    assert again.agg(F.sum("context_trip_count")).first()[0] == catalog._prepared(spark, sf_dir).count()
