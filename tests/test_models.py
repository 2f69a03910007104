import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from citytrace.functions import bins
from citytrace.operators import anomaly, cluster, forecast, hulls, iforest, lookup, rules
from citytrace.operators.stats import statistics_document
from citytrace.plans import anomalies
from citytrace.plans.anomalies import AnomalyConfig, run_anomaly
from citytrace.plans.clustering import run_clustering
from citytrace.plans.forecasting import load_bundle, run_forecast
from citytrace.plans.patterns import run_rules
from citytrace.plans.statistics import run_statistics
from citytrace.session import cut_lineage
from citytrace.sources import artifacts, sinks
from tests.conftest import rows
from verification import tables


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return cut_lineage(tables.trips(spark, sf_dir))


@pytest.fixture(scope="module")
def zones(spark, sf_dir):
    return tables.zones(spark, sf_dir)


@pytest.fixture(scope="module")
def coords(spark, sf_dir):
    return tables.coords(spark, sf_dir)


def blob(spark, n=600):
    rng = np.random.default_rng(3)
    data = [(float(a), float(b)) for a, b in rng.normal(0, 1, (n, 2))] + [(9.0, -9.0)]
    return spark.createDataFrame(data, "a double, b double").repartition(5)


def test_forest_finds_the_outlier(spark):
    df = blob(spark)
    config = iforest.ForestConfig(trees=25, max_samples=128)
    forest = cut_lineage(iforest.fit_iforest(df, ["a", "b"], config))
    assert rows(forest, "rows") == [(128,)] * 25
    scored = iforest.score_iforest(df, forest, ["a", "b"], "s")
    got = scored.orderBy(F.desc("s")).collect()
    assert (got[0]["a"], got[0]["b"]) == (9.0, -9.0)
    assert all(-0.5 < r["s"] < 0.5 for r in got)
    again = iforest.fit_iforest(df.repartition(2), ["a", "b"], config)
    assert rows(again.select("tree", "rows")) == rows(forest.select("tree", "rows"))
    same = iforest.score_iforest(df, cut_lineage(again), ["a", "b"], "s")
    assert rows(same.select(F.round("s", 9))) == rows(scored.select(F.round("s", 9)))


def test_forest_scores_are_those_of_a_plain_walk(spark):
    """Nulls go to the high side; a leaf holds its level and the mean depth of its rows."""
    df = blob(spark).unionByName(spark.createDataFrame([(None, 1.0)], "a double, b double"))
    forest = cut_lineage(iforest.fit_iforest(blob(spark), ["a", "b"], iforest.ForestConfig(trees=7, max_samples=1000)))
    trees = [
        (np.frombuffer(r["value"], "<f4"), np.frombuffer(r["feature"], np.uint8)) for r in forest.orderBy("tree").collect()
    ]
    assert rows(forest, "rows") == [(601,)] * 7
    for value, feature in trees:
        assert len(value) == len(feature) == 2**11 - 1  # ten levels hold 601 rows

    def depth(row, value, feature):
        at, level = 0, 0
        while feature[at] != iforest.LEAF:
            x = row[feature[at]]
            at, level = 2 * at + (1 if x is not None and np.float32(x) <= value[at] else 2), level + 1
        assert value[at] >= level
        return float(value[at])

    for row in iforest.score_iforest(df, forest, ["a", "b"], "s").collect():
        mean = sum(depth(row[:2], *tree) for tree in trees) / 7
        assert row["s"] == pytest.approx(2 ** (-mean / float(iforest.average_depth(601))) - 0.5, abs=1e-9)


def test_given_heaps_are_walked(spark):
    values, columns = iforest.heap((1, 2.0, 5.0, (0, 0.5, 3.0, 4.0)))
    assert np.frombuffer(values, "<f4").tolist() == [2.0, 5.0, 0.5, 0.0, 0.0, 3.0, 4.0]
    assert list(columns) == [1, 255, 0, 255, 255, 255, 255]
    forest = spark.createDataFrame([(0, 3, values, columns)], iforest.FOREST_SCHEMA)
    df = spark.createDataFrame([(0.0, 2.0), (0.5, 3.0), (0.75, 3.0)], "a double, b double")
    expected = float(iforest.average_depth(3))
    got = [r["s"] for r in iforest.score_iforest(df, forest, ["a", "b"], "s").orderBy("a").collect()]
    assert got == pytest.approx([2 ** (-d / expected) - 0.5 for d in (5, 3, 4)])
    with pytest.raises(ValueError, match="no trees"):
        iforest.score_iforest(df, forest.limit(0), ["a", "b"], "s")


def test_context_falls_back_to_route_and_all(spark):
    """One join on the route: contexts without a route row, routes without a context, and neither."""
    context = spark.createDataFrame(
        [(1, 2, 5, True, 9, 1.0, 2.0, 3.0), (7, 7, 0, False, 4, 4.0, 5.0, 6.0), (1, 2, None, True, 1, 0.0, 0.0, 0.0)],
        "source_id int, destination_id int, pickup_hour int, is_weekend boolean, context_trip_count long, "
        "context_fare_q1 double, context_fare_median double, context_fare_q3 double",
    )
    route = spark.createDataFrame(
        [(1, 2, 20, 10.0, 11.0, 12.0)],
        "source_id int, destination_id int, route_trip_count long, route_fare_q1 double, route_fare_median double, "
        "route_fare_q3 double",
    )
    overall = spark.createDataFrame(
        [(99, 7.0, 8.0, 9.0)],
        "global_context_count long, global_fare_q1 double, global_fare_median double, global_fare_q3 double",
    )
    trips = spark.createDataFrame(
        [(1, 2, 5, True), (1, 2, 5, False), (1, 2, None, True), (7, 7, 0, False), (7, 7, 1, False), (None, 2, 5, True)],
        "source_id int, destination_id int, pickup_hour int, is_weekend boolean",
    )
    got = rows(lookup.attach_context(trips, context, route, overall))
    columns = ("source_id", "destination_id", "pickup_hour", "is_weekend", "context_fare_q1", "context_fare_median",
               "context_fare_q3", "context_trip_count")
    assert set(lookup.attach_context(trips, context, route, overall).columns) == set(columns)
    assert sorted((r[0] or 0, r[2] if r[2] is not None else -1, r[3], r[-1]) for r in got) == [
        (0, 5, True, 99), (1, -1, True, 20), (1, 5, False, 20), (1, 5, True, 9), (7, 0, False, 4), (7, 1, False, 99),
    ]


def test_forest_of_copies_stays_bounded(spark):
    """Most rows equal: a tree still takes its number of rows, and equal rows share one score."""
    df = spark.createDataFrame([(1.0, 1.0)] * 900 + [(float(i), 5.0) for i in range(100)], "a double, b double")
    forest = cut_lineage(iforest.fit_iforest(df, ["a", "b"], iforest.ForestConfig(trees=10, max_samples=64)))
    assert rows(forest, "rows") == [(64,)] * 10
    scores = iforest.score_iforest(df, forest, ["a", "b"], "s").where("b = 1").select("s").distinct()
    assert scores.count() == 1


def test_expected_depth():
    assert iforest.average_depth(1) == 0.0
    assert iforest.average_depth(2) == 1.0
    assert iforest.average_depth(256) == pytest.approx(10.244, abs=1e-3)


def test_fallback_levels(spark):
    keys = "source_id int, destination_id int, pickup_hour int, is_weekend int, fare_amount double"
    df = spark.createDataFrame([(1, 2, 9, 0, 10.0), (1, 2, 10, 0, 10.0), (5, 6, 9, 0, 10.0)], keys)
    stat = "n long, a double, b double, c double"
    named = lambda p: [f"{p}_trip_count", f"{p}_fare_q1", f"{p}_fare_median", f"{p}_fare_q3"]
    context = spark.createDataFrame([(1, 2, 9, 0, 3, 1.0, 2.0, 4.0)], f"s int, d int, h int, w int, {stat}").toDF(
        "source_id", "destination_id", "pickup_hour", "is_weekend", *named("context"))
    route = spark.createDataFrame([(1, 2, 8, 5.0, 5.0, 4.0)], f"s int, d int, {stat}").toDF("source_id", "destination_id", *named("route"))
    every = spark.createDataFrame([(50, 0.0, 0.05, 9.0)], stat).toDF(
        "global_context_count", "global_fare_q1", "global_fare_median", "global_fare_q3")
    got = anomaly.context_features(lookup.attach_context(df, context, route, every))
    assert rows(got, "context_trip_count", "context_fare_median", "context_iqr_fare", "fare_to_context_median_ratio") == [
        (3, 2.0, 3.0, 5.0), (50, 0.05, 9.0, 100.0), (8, 5.0, 0.0, 2.0),
    ]


def test_calibration_takes_the_first_best(spark):
    """All scores and speeds equal: every combination flags every row, so grid order decides."""
    df = spark.createDataFrame([(3, 1.0, 50.0)] * 20, "pickup_hour int, speed_anomaly_score double, speed_mph double")
    got = anomaly.calibrate_speed(df)
    assert got.count() == 24
    assert rows(got, "score_quantile", "speed_quantile", "estimated_anomaly_rate", "speed_mph_threshold") == [(0.98, 0.99, 1.0, 50.0)] * 24
    fare = df.selectExpr("1.0D fare_amount", "1.0D context_fare_median", "0.0D context_iqr_fare",
                         "1.0D fare_to_context_median_ratio", "2.0D fare_anomaly_score")
    assert rows(anomaly.calibrate_fare(fare)) == [(0.98, 2.0, 1.5, 0.97, 1.0, 1.0)]


def test_hourly_rows_are_dense(spark):
    df = spark.createDataFrame([(5, True), (5, False), (5, False)], "pickup_hour int, f boolean")
    got = {r["pickup_hour"]: r for r in anomaly.hourly_variation(df, "f").collect()}
    assert len(got) == 24 and got[5]["anomaly_percentage"] == 33.3333
    assert (got[0]["total_records"], got[0]["anomaly_percentage"], got[0]["hour_label"]) == (0, 0.0, "00:00")


def test_anomaly_job(spark, trips, zones, tmp_path):
    config = AnomalyConfig(forest=iforest.ForestConfig(trees=10, max_samples=128))
    result = run_anomaly(trips, zones, str(tmp_path), config)
    summary = result["summary"].first()
    flagged = result["flagged"]
    assert summary["total_valid_records"] == flagged.count()
    for kind, (flag, _) in anomaly.KINDS.items():
        hits = flagged.where(flag).count()
        assert summary[f"{kind}_records"] == hits == result[kind].count()
        assert sum(h["anomaly_count"] for h in summary[kind]["hourly_variation"]) == hits
        assert len(result[kind].columns) == 15
    assert (tmp_path / "bundle" / "speed_thresholds").exists()
    with pytest.raises(ValueError, match="trips"):
        run_anomaly(trips.limit(0), zones, str(tmp_path / "x"), config)


SMALL = forecast.BoostConfig(rounds=3, depth=3, min_leaf=5, bins=32)


def test_forecast_job(spark, trips, coords, tmp_path):
    bundle, metadata = run_forecast(trips, coords, str(tmp_path), SMALL, SMALL)
    row = metadata.first()
    assert row["train_size"]["rows"] > row["test_size"]["rows"] > 0
    assert row["fare_model_test_metrics"]["rmse"] >= row["fare_model_test_metrics"]["mae"] > 0
    requests = spark.createDataFrame(
        [(3, 4, "2025-12-31", 24), (3, 999, "2025-10-01", 8)],
        "source_location_id int, destination_location_id int, pickup_date string, pickup_hour int",
    ).withColumn("pickup_date", F.to_date("pickup_date"))
    scored = forecast.score_requests(requests, bundle).collect()
    assert sorted(forecast.score_requests(requests, load_bundle(spark, str(tmp_path))).collect()) == sorted(scored)
    assert len(scored) == 2 and all(r["predicted_fare_amount"] > 0 and r["predicted_eta_minutes"] > 0 for r in scored)
    features = {r["destination_id"]: r for r in forecast.request_features(requests, bundle.prior, bundle.overall, coords).collect()}
    assert features[999]["route_distance_km"] == 0.0
    assert features[999]["route_hist_trip_count_log1p"] == 0.0
    assert (features[4]["pickup_hour"], features[4]["month"], features[4]["requested_hour"]) == (0, 1, 24)
    spark.range(1).write.mode("append").parquet(str(tmp_path / "bundle" / "coordinates"))
    with pytest.raises(ValueError, match="coordinates"):
        load_bundle(spark, str(tmp_path))
    with pytest.raises(ValueError, match="test months"):
        run_forecast(trips.where(F.month("pickup_date") < 10), coords, str(tmp_path / "x"), SMALL, SMALL)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, p double")
    row = forecast.regression_metrics(df, "y", "p").first()
    assert (row["mae"], row["rmse"], row["r2"]) == pytest.approx((1.0, (5 / 3) ** 0.5, 1 - 5 / 8))


def inertia(points, centres):
    return cluster.label_points(points, centres).agg(F.sum(F.col("d2") * F.col("weight"))).first()[0]


def test_refinement_never_raises_inertia(spark, trips, coords):
    points = cut_lineage(cluster.weighted_points(trips, coords))
    start = points.where("location_id < 5").select(
        "segment", F.col("location_id").cast("int").alias("cluster_id"), F.col("long").alias("center_long"), F.col("lat").alias("center_lat"))
    refined = cluster.refine_centres(points, start)
    assert inertia(points, refined) <= inertia(points, start)
    counts = dict(rows(refined.groupBy("segment").agg(F.sum("cluster_count"))))
    assert counts == dict(rows(cluster.segment_point_counts(points)))
    far = start.where("cluster_id < 2").withColumn("center_lat", F.when(F.col("cluster_id") == 1, 999.0).otherwise(F.col("center_lat")))
    empty = cluster.refine_centres(points, far).where("cluster_id = 1")
    assert rows(empty, "center_lat", "cluster_count") == [(999.0, 0)] * 5
    assert {r["empty_clusters"] for r in cluster.refinement_summary(cluster.refine_centres(points, far)).collect()} == {1}


def test_clustering_job(spark, trips, zones, coords, tmp_path):
    result = run_clustering(trips, zones, coords, str(tmp_path), displayed=300)
    metadata = result["metadata"].first()
    assert result["centers"].count() == 25
    assert metadata["diagnostics"]["inertia"] > 0
    assert sum(metadata["point_counts"][s] for s in bins.TIME_BUCKETS) < metadata["point_counts"]["all"]
    total = dict(rows(result["points"].groupBy("segment").agg(F.sum("weight"))))
    assert total == {s: metadata["point_counts"][s] for s in cluster.SEGMENTS}
    assert dict(rows(result["displayed"].groupBy("segment").agg(F.sum("display_count")))) == {s: min(300, n) for s, n in total.items()}
    assert dict(rows(result["summary"].groupBy("segment").agg(F.sum("total_count")))) == total
    assert result["concentration"].count() == 5
    assert {r["segment"] for r in result["hulls"].select("segment").distinct().collect()} == set(cluster.SEGMENTS)
    labelled = result["points"]
    payload = cluster.cluster_payload(labelled, result["centers"], cluster.borough_centroids(zones, coords), "night", 100)
    assert rows(payload["totals"]) == [("night", 5, total["night"], 100)]
    assert payload["cluster_summary"].agg(F.sum("display_count")).first()[0] == 100
    with pytest.raises(ValueError):
        cluster.cluster_payload(labelled, result["centers"], zones, "dawn")


def test_silhouette_is_that_of_repeated_points(spark):
    rng = np.random.default_rng(7)
    cells = [(i, float(x), float(y), int(w), int(c)) for i, (x, y, w, c) in enumerate(zip(*rng.normal(size=(2, 9)), rng.integers(1, 6, 9), [0, 0, 0, 1, 1, 1, 1, 2, 3]))]
    cells[-1] = (*cells[-1][:3], 1, 3)  # a point alone
    df = spark.createDataFrame([("all", *c) for c in cells] + [("night", 1, 0.0, 0.0, 4, 0)], "segment string, location_id long, long double, lat double, weight long, cluster_id int")
    points = np.array([c[1:3] for c in cells for _ in range(c[3])])
    label = np.array([c[4] for c in cells for _ in range(c[3])])
    apart = np.linalg.norm(points[:, None] - points, axis=2)
    each = []
    for k, own in enumerate(label):
        same = (label == own) & (np.arange(len(label)) != k)
        a, b = apart[k, same].mean() if same.any() else 0, min(apart[k, label == c].mean() for c in set(label) - {own})
        each.append((b - a) / max(a, b) if same.any() else 0)
    got = dict(rows(cluster.silhouettes(df)))
    assert got["all"] == pytest.approx(np.mean(each)) and got["night"] is None


def test_shown_points_are_shares_of_all(spark):
    cells = [("all", 1, 0.0, 0.0, 900, 0), ("all", 2, 0.0, 1.0, 95, 0), ("all", 3, 1.0, 1.0, 4, 1), ("all", 4, 1.0, 2.0, 1, 2)]
    df = spark.createDataFrame(cells, "segment string, location_id long, long double, lat double, weight long, cluster_id int")
    shown = lambda n: dict(rows(cluster.display_points(df, n).select("location_id", "display_count")))
    assert shown(100) == {1: 89, 2: 9, 3: 1, 4: 1} and shown(10**6) == {1: 900, 2: 95, 3: 4, 4: 1}
    assert cluster.display_points(df.limit(0), 5).count() == 0


def test_shown_points_do_not_depend_on_partitions(spark, trips, coords):
    points = cluster.weighted_points(trips, coords)
    start = points.where("location_id < 5").select(
        "segment", F.col("location_id").cast("int").alias("cluster_id"), F.col("long").alias("center_long"), F.col("lat").alias("center_lat"))
    labelled = cut_lineage(cluster.label_points(points, start))
    a, b = (cluster.display_points(df, 50) for df in (labelled, labelled.repartition(9)))
    assert rows(a) == rows(b)


def test_hulls(spark):
    rng = np.random.default_rng(1)
    cloud = [(0, float(x), float(y)) for x, y in rng.uniform(-1, 1, (500, 2))] + [(0, x, y) for x in (-2.0, 2.0) for y in (-2.0, 2.0)]
    data = cloud + [(1, 0.0, 0.0), (1, 1.0, 1.0)] + [(2, float(i), float(i)) for i in range(3)]
    data += [(3, 0.0, 0.0), (3, 1.0, 0.0), (3, 2.0, 0.0), (3, 2.0, 2.0), (3, 0.0, 2.0)]
    got = hulls.cluster_hulls(spark.createDataFrame(data, "cluster_id int, long double, lat double").withColumn("segment", F.lit("all")).repartition(6)).collect()
    corners = {}
    for r in sorted(got, key=lambda r: (r["cluster_id"], r["seq"])):
        corners.setdefault(r["cluster_id"], []).append((r["long"], r["lat"]))
    assert corners == {
        0: [(-2.0, -2.0), (2.0, -2.0), (2.0, 2.0), (-2.0, 2.0)],
        3: [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)],
    }


def test_hulls_of_segments_stay_apart(spark):
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    data = [(s, 0, x + 5 * k, y) for k, s in enumerate(["night", "all", None]) for x, y in square * 50]
    data += [("night", 0, None, 1.0), ("night", None, 9.0, 9.0)]
    df = spark.createDataFrame(data, "segment string, cluster_id int, long double, lat double").repartition(5)
    got = [(r["segment"], r["cluster_id"], r["seq"], r["long"], r["lat"]) for r in hulls.cluster_hulls(df).collect()]
    plain = [(s, 0, i, x + 5 * k, y) for k, s in enumerate(["night", "all", None]) for i, (x, y) in enumerate(square)]
    assert sorted(got, key=str) == sorted(plain, key=str)
    assert hulls.cluster_hulls(df.limit(0)).isEmpty()


def test_bounds_of_nothing(spark, coords):
    nothing = spark.createDataFrame([], "long double, lat double, center_long double, center_lat double")
    assert rows(cluster.bounds(nothing, nothing)) == [(-74.10, -73.70, 40.55, 40.92)]


def test_single_cluster_stands_in_for_the_second(spark):
    df = spark.createDataFrame([("morning", 0, 5, 100.0)], "segment string, cluster_id int, total_count long, share_pct double")
    assert rows(cluster.top2_share(df, "cluster_id", "total_count")) == [("morning", 0, 100.0, 0, 100.0, 200.0, 1)]


def test_rules_job(spark, trips, zones, tmp_path):
    result = run_rules(trips, zones, str(tmp_path), min_support=0.02)
    top = result["top"].collect()
    assert [r["place"] for r in sorted(top, key=lambda r: r["place"])] == list(range(10))
    missing = [r for r in top if r["match_kind"] == "none"]
    assert all(r["rule"] is None and r["support"] is None and r["insight"] is None for r in missing)
    names = [r["rule"] for r in top if r["rule"]]
    assert len(names) == len(set(names))
    assert result["metadata"].first()["total_rules"] == result["rules"].count()
    spot = rules.airport_spotlight(result["rules"]).collect()
    assert all("airport" in (r["rule"] + r["insight"]).lower() for r in spot) and len(spot) <= 6


def test_rule_confidence_is_a_support_ratio(spark):
    baskets = spark.createDataFrame([(["a=1", "b=1"],)] * 3 + [(["a=1", "b=2"],)], "items array<string>")
    got = {(tuple(r["antecedent"]), tuple(r["consequent"])): r for r in rules.mine_rules(baskets, 0.1, 0.1).collect()}
    rule = got[(("a=1",), ("b=1",))]
    assert (rule["support"], rule["confidence"], rule["lift"]) == (0.75, 0.75, 1.0)


def make_rules(spark, *items):
    schema = "antecedent array<string>, consequent array<string>, support double, confidence double, lift double"
    return rules.rule_text(spark.createDataFrame(list(items), schema))


def test_showcase_uses_a_rule_once(spark):
    cash = (["time_bin=Night", "day_type=Weekend", "distance_bin=0-2mi"], ["payment_type=Cash"], 0.1, 0.5, 2.0)
    tip = (["payment_type=Cash", "tip_bin=NoTip"], ["time_bin=Night"], 0.1, 0.9, 3.0)
    got = {r["category"]: r for r in rules.showcase(rules.rank_rules(make_rules(spark, cash, tip))).collect()}
    assert (got["tipping_pattern"]["match_kind"], got["cash_pattern"]["match_kind"]) == ("relaxed", "strict")
    assert got["cash_pattern"]["insight"] == "Weekend night trips in 0-2mi are more likely to be paid by cash."
    assert got["ewr_weekday"]["match_kind"] == "none"
    only = {r["category"]: r for r in rules.showcase(rules.rank_rules(make_rules(spark, tip))).collect()}
    assert only["tipping_pattern"]["rule"] and only["cash_pattern"]["rule"] is None


def test_sentences(spark):
    one = make_rules(spark, (["time_bin=Night"], ["fare_bin=$10-$20"], 0.1, 0.5625, 2.0))
    assert rules.rule_sentence(one).first()["sentence"] == (
        "When time of day is Night, fare is in $10-$20 is seen in about 56.2% of such trips.")
    assert rules.insight(one).first()["insight"] == (
        "Night travel patterns indicate consistent pricing behavior for these trips and fares in $10-$20.")
    air = make_rules(spark, (["destination_airport=JFK"], ["route_type=city_to_airport"], 0.1, 0.5, 2.0))
    assert rules.insight(air).first()["insight"] == (
        "Airport-linked trips (city to airport) are concentrated around JFK across time windows.")
    odd = spark.createDataFrame([("nothing", 0.5)], "rule string, confidence double")
    assert rules.rule_sentence(odd).first()["sentence"] == rules.NO_RULE_TEXT
    sure = spark.createDataFrame([("{payment_type=Cash} -> {tip_bin=NoTip}", None)], "rule string, confidence double")
    assert rules.rule_sentence(sure).first()["sentence"] == "When payment mode is cash, it is likely that tip behavior is NoTip."


def test_statistics_job(spark, trips, zones, coords, tmp_path):
    written = run_statistics(trips, zones, coords, str(tmp_path))
    assert written.first() == statistics_document(trips, zones, coords).first()
    (part,) = (tmp_path / "statistics").glob("part-*.json")
    document = json.loads(part.read_text())
    assert document["total_no_of_trips"] == trips.count()
    assert set(document["avg_trips_by_time_of_day"]) == set(bins.TIME_BUCKETS)
    assert len(document["top_10_frequent_source_destination_pairs"]) == 10


def test_tables_sink(spark, tmp_path):
    df = spark.range(7).toDF("x")
    counts = sinks.load_tables({"date_day_data": df, "trip_details_feb": df.limit(0), "trip_details_jan": df.limit(3)})
    assert list(counts.items()) == [("trip_details_jan", 3), ("trip_details_feb", 0), ("date_day_data", 7)]
    assert spark.table("trip_details_feb").columns == ["x"]
    assert sinks.load_tables({"date_day_data": df.limit(2)}) == {"date_day_data": 2}
    for name in counts:
        spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError):
        sinks.load_tables({"bad-name": df})


def test_artifacts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,2.5\n2,oops\n3,\n,4\n")
    assert rows(artifacts.read_artifact(spark, str(tmp_path / "a.csv"), ["id"], ["x", "y"])) == [("1", 2.5), ("2", None), ("3", None)]
    with pytest.raises(ValueError, match="empty input: b"):
        artifacts.check_inputs({"a": spark.range(1), "b": spark.range(0)})
    with pytest.raises(ValueError, match="ids below 3"):
        artifacts.check_inputs({"a": spark.range(5)}, {"ids below 3": F.col("id") < 3})


def test_checked_queries_name_the_same_columns():
    from verification.catalog import REGISTRY
    from verification.oracle import ORACLE

    assert set(ORACLE) <= set(REGISTRY)
    assert len(REGISTRY) >= 85


def test_a_failed_load_leaves_the_former_table(spark):
    df = spark.range(5)
    sinks.load_tables({"kept": df})
    broken = df.select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.load_tables({"kept": broken})
    assert rows(spark.table("kept")) == rows(df)
    assert not any(t.name.startswith("kept__") for t in spark.catalog.listTables())
    assert sinks.load_tables({"kept": spark.table("kept").where("id > 2")}) == {"kept": 2}  # a frame of the table itself
    assert rows(spark.table("kept")) == [(3,), (4,)]
    spark.sql("ALTER TABLE kept RENAME TO kept__former")  # a session that ended in the middle
    sinks.restore_table(spark, "kept")
    assert rows(spark.table("kept")) == [(3,), (4,)]
    spark.sql("DROP TABLE kept")

def test_forest_files_are_read_once_for_many_batches(tmp_path, monkeypatch):
    trees = [(0, 5.0, (1, 2.0, 1.0, 3.0), 4.0), 2.5, (1, 0.0, 6.0, (0, 9.0, 7.0, (1, 1.0, 8.0, 9.0)))]
    files = []
    for k, tree in enumerate(trees):
        value, feature = iforest.heap(tree)
        (tmp_path / str(k)).write_bytes(value + feature + b"\n")
        files.append(str(tmp_path / str(k)))
    opened, real = [], np.memmap
    monkeypatch.setattr(np, "memmap", lambda name, *rest: opened.append(name) or real(name, *rest))
    rng = np.random.default_rng(3)
    data = rng.integers(-2, 12, (4000, 2)).astype(np.float32)
    data[::7, 0], data[::11, 1] = np.nan, np.inf
    batches = [tuple(pd.Series(part[:, k]) for k in range(2)) for part in np.split(data, 40)]
    found = np.concatenate(list(iforest._depth_sum("", files).func(iter(batches))))

    def walk(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    assert found.tolist() == [sum(walk(t, row) for t in trees) for row in data]
    assert opened == files


def test_forest_draws_are_the_hashes_of_sql(spark):
    rows = spark.range(-300, 300).select(
        F.xxhash64("id").alias("_row"), (F.col("id") % 3 + 1).alias("_twin"), F.lit(0.3).alias("_share"),
        F.col("id").cast("float").alias("_f0"),
    )
    found = rows.mapInArrow(iforest._draws(7, 42), "tree int, _draw double, _f0 float")
    # What xxhash64 of (id, twin, seed) and of (row, tree) gives, as the draws are defined.
    drawn = F.pmod(F.xxhash64("_r", "tree"), F.lit(1 << 52)) / float(1 << 52)
    wanted = (
        spark.range(-300, 300)
        .select("id", F.xxhash64("id", F.col("id") % 3 + 1, F.lit(42)).alias("_r"))
        .select("id", "_r", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("tree"))
        .select("tree", drawn.alias("_draw"), F.col("id").cast("float").alias("_f0"))
        .where("_draw < 0.3")
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert wanted.count() > 1000


def test_given_forests_write_trips_once(spark, trips, zones, tmp_path, monkeypatch):
    values, columns = iforest.heap((0, 20.0, 3.0, (2, 10.0, 1.0, 2.0)))
    forest = spark.createDataFrame([(0, 256, values, columns)], iforest.FOREST_SCHEMA)
    written = []
    monkeypatch.setattr(anomalies, "cut_lineage", lambda df: written.append(df.columns) or cut_lineage(df))
    result = run_anomaly(trips, zones, str(tmp_path), forests={"speed": forest, "fare": forest})
    assert len(written) == 3  # prepared trips, fare counts and scores; neither features nor flags
    assert result["summary"].first()["total_valid_records"] == result["flagged"].count()
