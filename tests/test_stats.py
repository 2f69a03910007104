import datetime as dt

import pytest
from pyspark.sql import functions as F

from citytrace.operators import flow, lookup, stats
from citytrace.sources import zones as zone_files
from citytrace.functions.geo import ConicProjection
from tests.conftest import rows

D = dt.date


def trips(spark, data):
    return spark.createDataFrame(
        data, "pickup_location_id int, dropff_location_id int, pickup_date date, pickup_time string, "
        "fare_amount double, tip_amount double"
    )


@pytest.fixture(scope="module")
def few(spark):
    return trips(
        spark,
        [
            (1, 2, D(2025, 1, 3), "08:00:00", 10.0, 1.0),
            (1, 2, D(2025, 1, 4), "03:00:00", 20.0, 2.0),
            (2, 1, D(2025, 1, 4), "21:00:00", 30.0, 9.0),
            (1, 2, D(2025, 3, 4), "12:00:00", 10.0, 0.0),
        ],
    )


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(
        [(1, "Queens", "A"), (2, "Bronx", "B"), (3, "Queens", "C"), (9, "Unknown", "N/A"), (10, " NaN ", "x")],
        "location_id int, borough string, zone string",
    )


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(
        [(1, 40.0, -74.0), (2, 41.0, -74.0), (3, None, None)], "location_id long, lat double, long double"
    )


def test_months_are_dense_and_keep_years(spark, few):
    got = rows(stats.monthly_counts(few, D(2024, 12, 15), D(2025, 3, 31)))
    assert got == [(2024, 12, "Dec", 0), (2025, 1, "Jan", 3), (2025, 2, "Feb", 0), (2025, 3, "Mar", 1)]


def test_weekday_averages(few):
    dates = stats.date_dim(few)
    assert rows(dates) == [(D(2025, 1, 3), "Friday", 0), (D(2025, 1, 4), "Saturday", 1), (D(2025, 3, 4), "Tuesday", 0)]
    assert rows(stats.weekday_weekend_avg(few, dates)) == [("Weekday", 1.0), ("Weekend", 2.0)]
    assert rows(stats.weekday_weekend_avg(few, dates.where("is_weekend = 0"))) == [("Weekday", 1.0), ("Weekend", 0.0)]
    grid = stats.weekpart_bucket_avg(few, dates)
    assert grid.count() == 8
    assert rows(grid.where("avg_trips > 0"), "segment", "time_of_day", "avg_trips") == [
        ("Weekday", "afternoon", 0.5), ("Weekday", "morning", 0.5), ("Weekend", "night", 1.0),
    ]
    assert rows(stats.weekpart_bucket_pivot(grid)) == [("Weekday", 0.5, 0.5, 0.0, 0.0), ("Weekend", 0.0, 0.0, 0.0, 1.0)]


def test_totals(few, places):
    assert rows(stats.kpis(few)) == [(4, D(2025, 1, 3), D(2025, 3, 4), pytest.approx(4 / 3))]
    assert stats.kpis(few.limit(0)).first()["avg_no_of_trips_per_day"] == 0.0
    assert rows(stats.weekpart_totals(few)) == [(2, 2)]
    assert rows(stats.borough_avg(few, places)) == [("Bronx", 1.0, 1), ("Queens", 1.5, 2)]
    assert dict(rows(stats.bucket_avg(few))) == {
        "morning": pytest.approx(1 / 3), "afternoon": pytest.approx(1 / 3), "evening": 0.0, "night": pytest.approx(1 / 3),
    }


def test_pairs(spark, few, places, points):
    assert [tuple(r) for r in stats.od_counts(few).collect()] == [(1, 2, 3), (2, 1, 1)]
    top = stats.top_frequent_pairs(few, places, points, 1).first()
    assert (top["source_zone"], top["destination_zone"], top["frequency_of_trips"]) == ("A", "B", 3)
    assert top["distance_km"] == pytest.approx(111.19, abs=0.01)
    assert stats.top_tipped_pairs(few, places).first()["avg_tip_amount"] == 9.0
    assert stats.top_tipped_pairs(few, places, min_trips=2).first()["avg_tip_amount"] == 1.0


def test_flow_bins_and_widths(spark):
    df = spark.createDataFrame([(c,) for c in (0, 24, 25, 50, 74, 75, 100)], "n int")
    binned = {r["n"]: r for r in flow.equal_width_bins(df, "n").collect()}
    assert [binned[c]["bucket_index"] for c in sorted(binned)] == [0, 0, 1, 2, 2, 3, 3]
    assert binned[0]["range_label"] == "0 - 25 trips"
    assert binned[25]["range_label"] == "26 - 50 trips"
    assert binned[100]["range_label"] == "76 - 100 trips"
    same = spark.createDataFrame([(1500,), (1500,)], "n int")
    assert rows(flow.equal_width_bins(same, "n")) == [(1500, None, "1,500 trips")] * 2
    assert rows(flow.scale_minmax(same, "n", 1.5, 10.0, 3.0, "w"), "w") == [(3.0,)] * 2
    assert rows(flow.scale_minmax(df, "n", 1.5, 10.0, 3.0, "w").where("n in (0, 50, 100)"), "w") == [(1.5,), (11.5,), (6.5,)]


def test_flow_drops_pairs_without_coordinates(few, places, points):
    extra = few.union(few.selectExpr("3", "1", "pickup_date", "pickup_time", "fare_amount", "tip_amount"))
    arcs = flow.od_flow(extra, places, points, D(2025, 1, 1), D(2025, 12, 31))
    assert rows(arcs, "source_id", "destination_id", "trip_count") == [(1, 2, 3), (2, 1, 1)]
    assert rows(flow.flow_centre(arcs)) == [(40.5, -74.0)]


def test_lookups(spark, few, places, points):
    pairs = few.select(F.col("pickup_location_id").alias("source_id"), F.lit(77).alias("destination_id")).distinct()
    assert rows(lookup.with_labels(pairs, places), "origin_label", "destination_label") == [
        ("A (Queens)", "Unknown (Unknown)"), ("B (Bronx)", "Unknown (Unknown)"),
    ]
    ends = lookup.od_points(trips(spark, [(1, 3, D(2025, 1, 1), "08:00:00", 1.0, 0.0), (None, 2, D(2025, 1, 1), "x", 1.0, 0.0)]), points)
    assert rows(ends, "location_id") == [(1,), (2,)]
    catalog = rows(lookup.location_catalog(places, points), "location_id", "option_label", "lat", "borough_place")
    assert catalog == [(1, "1 - A", 40.0, 2), (2, "2 - B", 41.0, 3), (3, "3 - C", None, 2)]


def test_nearest_takes_the_first_on_ties(spark):
    from citytrace.operators import cluster

    boroughs = spark.createDataFrame([("B", 1.0, 0.0), ("A", -1.0, 0.0)], "borough string, long double, lat double")
    df = spark.createDataFrame([(0.0, 0.0), (0.5, 0.0)], "long double, lat double")
    assert rows(cluster.nearest_borough(df, boroughs)) == [(0.0, 0.0, "A"), (0.5, 0.0, "B")]
    assert rows(cluster.nearest_borough(df, boroughs.limit(0)), "nearest_borough") == [("Unknown",)] * 2


def test_describe(few):
    row = {r["measure"]: r for r in stats.describe(few, ["fare_amount", "tip_amount"]).collect()}
    assert (row["fare_amount"]["count"], row["fare_amount"]["mean"], row["tip_amount"]["max"]) == (4, 17.5, 9.0)
    corr = stats.correlations(few, ["fare_amount", "tip_amount"]).first()["correlation"]
    assert corr == pytest.approx(few.stat.corr("fare_amount", "tip_amount"))


def test_zone_lookup(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Borough,Zone,Service_Zone\n2,Queens,B,x\n1,EWR,A,y\n")
    assert [tuple(r) for r in zone_files.load_zones(spark, str(path)).collect()] == [(1, "EWR", "A"), (2, "Queens", "B")]
    path.write_text("LocationID,Zone\n1,A\n")
    with pytest.raises(ValueError, match="borough"):
        zone_files.load_zones(spark, str(path))


def test_zone_centroids(spark):
    """A square with a square hole off its middle, and an open ring; checked in map units."""
    x0, y0 = ConicProjection().forward(40.7, -73.9)
    ring = lambda pts, r, zone: [(zone, r, i, x0 + x, y0 + y) for i, (x, y) in enumerate(pts)]
    outer = [(0, 0), (0, 4000), (4000, 4000), (4000, 0), (0, 0)]
    hole = [(2000, 0), (4000, 0), (4000, 4000), (2000, 4000), (2000, 0)]
    data = ring(outer, 0, 1) + ring(hole, 1, 1) + ring(outer[:4], 0, 2)
    vertices = spark.createDataFrame([(z, r, s, float(x), float(y)) for z, r, s, x, y in data],
                                     "location_id int, ring int, seq int, x double, y double")
    got = {r["location_id"]: (r["lat"], r["long"]) for r in zone_files.zone_centroids(vertices).collect()}
    for zone, (x, y) in {1: (1000, 2000), 2: (2000, 2000)}.items():
        assert ConicProjection().forward(*got[zone]) == pytest.approx((x0 + x, y0 + y), abs=1e-3)
    known = spark.createDataFrame([(1,), (2,), (3,)], "location_id int")
    table = zone_files.zone_coordinates(known, zone_files.zone_centroids(vertices))
    assert [r[0] for r in rows(table.where("lat is null"), "location_id")] == [3]
