import datetime as dt

import pytest
from pyspark.sql import functions as F

from citytrace.operators import clean, prepare
from citytrace.sources import trips as trip_files
from citytrace.plans.cleaning import run_cleaning
from tests.conftest import rows

START = dt.datetime(2025, 1, 6, 10, 0, 0)


def raw(spark, changes=({},), fee="Airport_fee", dropff="tpep_dropoff_datetime", start=START):
    base = {
        "VendorID": 1, "tpep_pickup_datetime": start, dropff: start + dt.timedelta(minutes=10),
        "PULocationID": 1, "DOLocationID": 2, "trip_distance": 3.0, "fare_amount": 10.0, "tip_amount": 2.0,
        "extra": 1.0, "tolls_amount": 0.5, "congestion_surcharge": 2.5, fee: 1.75, "payment_type": 1,
    }
    data = [{**base, **change} for change in changes]
    kinds = {c: "timestamp_ntz" if "datetime" in c else "int" if "ID" in c or c == "payment_type" else "double" for c in base}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items())
    return spark.createDataFrame([tuple(d[c] for c in base) for d in data], schema)


def after(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_amounts_and_columns(spark):
    row = clean.clean_trips(raw(spark)).first()
    assert row["extra_amount"] == 5.75
    assert row["total_trip_amount"] == 17.75
    assert (row["pickup_time"], row["dropff_time"]) == ("10:00:00", "10:10:00")
    assert not {"VendorID", "extra", "airport_fee", "pickup_ts"} & set(row.asDict())


def test_sorted_trips_are_in_time_order(spark):
    hours = [14, 3, 9, 23, 0, 11]
    starts = [START.replace(day=6 + k % 3, hour=h) for k, h in enumerate(hours)]
    changes = [{"tpep_pickup_datetime": s, "tpep_dropoff_datetime": s + dt.timedelta(minutes=9)} for s in starts]
    found = clean.clean_trips(raw(spark, changes).repartition(3), sort=True).collect()
    assert [(r["pickup_date"], r["pickup_time"]) for r in found] == sorted((s.date(), f"{s:%H:%M:%S}") for s in starts)


@pytest.mark.parametrize("seconds, kept", [(0, 1), (1, 1), (86_400, 1), (86_401, 0), (-1, 0)])
def test_duration_limits(spark, seconds, kept):
    assert clean.clean_trips(raw(spark, [{"tpep_dropoff_datetime": after(seconds)}])).count() == kept


@pytest.mark.parametrize("change", [{"trip_distance": 0.0}, {"DOLocationID": 1}, {"fare_amount": -0.1}, {"tip_amount": None}])
def test_invalid_rows_go(spark, change):
    assert clean.clean_trips(raw(spark, [change])).isEmpty()


def test_copies_go_before_columns(spark):
    """Equal raw rows fold; rows that differ in a dropped column stay and become equal."""
    cleaned = clean.clean_trips(raw(spark, [{}, {}, {"VendorID": 2}]))
    assert cleaned.count() == 2
    assert cleaned.distinct().count() == 1


def test_column_spellings(spark):
    for fee, dropff in (("airport_fee", "tpep_dropff_datetime"), ("Airport_fee", "tpep_dropoff_datetime")):
        assert clean.clean_trips(raw(spark, fee=fee, dropff=dropff)).count() == 1
    with pytest.raises(ValueError, match="fare_amount"):
        clean.clean_trips(raw(spark).drop("fare_amount"))


def test_union_keeps_years_apart(spark):
    month = lambda: raw(spark)
    both = clean.union_months({(2025, 1): month(), (2024, 1): month()})
    assert rows(both, "year", "month") == [(2024, 1), (2025, 1)]


def write_month(spark, folder, name, df):
    df.coalesce(1).write.parquet(str(folder / "tmp" / name))
    (part,) = (folder / "tmp" / name).glob("part-*.parquet")
    part.rename(folder / name)


def test_read_months_and_job(spark, tmp_path):
    feb = dt.datetime(2024, 2, 3, 9, 0)
    write_month(spark, tmp_path, "yellow_tripdata_2025-01.parquet", raw(spark, [{}, {}]))
    write_month(spark, tmp_path, "yellow_tripdata_2024-02.parquet",
                raw(spark, fee="airport_fee", start=feb).withColumn("cbd_congestion_fee", F.lit(0.75)))
    both = trip_files.read_trips(spark, str(tmp_path))
    assert rows(both, "year", "month") == [(2024, 2), (2025, 1), (2025, 1)]
    tables = run_cleaning(spark, str(tmp_path), str(tmp_path / "out"))
    assert rows(tables["trip_details"], "year", "month") == [(2024, 2), (2025, 1)]
    assert rows(tables["date_day_data"], "day", "is_weekend") == [("Monday", 0), ("Saturday", 1)]
    plan = tables["trip_details"].where("year = 2025").select("fare_amount")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_read_months_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        trip_files.read_trips(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError):
        trip_files.month_of("yellow_tripdata_2025-13.parquet")
    with pytest.raises(ValueError):
        trip_files.month_of("green_2025-01.parquet")


def test_csv_union_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pickup_location_id,fare_amount,pickup_date\n1,2.5,2025-01-06\n")
    (tmp_path / "b.csv").write_text("fare_amount,pickup_time,pickup_location_id\nbad,10:00:00,7\n")
    df = trip_files.read_trip_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert rows(df, "pickup_location_id", "fare_amount", "pickup_time") == [(1, 2.5, None), (7, None, "10:00:00")]


def trip(spark, **change):
    base = {
        "pickup_location_id": "1", "dropff_location_id": "2", "pickup_date": "2025-01-05", "pickup_time": "10:00:00",
        "dropff_date": "2025-01-05", "dropff_time": "10:30:00", "trip_distance": "3", "fare_amount": "12",
        "tip_amount": "1", "payment_type": "1",
    } | change
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{c} string" for c in base))


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, 1), ({"dropff_time": "14:00:00"}, 1), ({"dropff_time": "14:00:01"}, 0), ({"dropff_time": "10:00:00"}, 0),
        ({"pickup_time": "xx:00:00"}, 0), ({"fare_amount": "abc"}, 0), ({"trip_distance": "NaN"}, 0),
        ({"dropff_location_id": "1"}, 0),
    ],
)
def test_prepare_anomaly_limits(spark, change, kept):
    assert prepare.prepare_anomaly(trip(spark, **change)).count() == kept


def test_prepare_anomaly_columns(spark):
    row = prepare.rate_features(prepare.prepare_anomaly(trip(spark))).first()
    assert (row["day_of_week"], row["is_weekend"], row["pickup_hour"]) == (0, 1, 10)
    assert (row["eta_minutes"], row["speed_mph"], row["fare_per_mile"], row["fare_per_minute"]) == (30.0, 6.0, 4.0, 0.4)


def test_prepare_forecast_needs_a_boundary(spark):
    typed = lambda **c: trip(spark, **c)
    assert prepare.prepare_forecast(typed(pickup_time="10:00:59", dropff_time="10:01:00")).first()["eta_minutes"] == 1
    assert prepare.prepare_forecast(typed(dropff_time="10:00:59")).isEmpty()
    assert prepare.prepare_forecast(typed(pickup_date="2025-12-05", dropff_date="2025-12-05")).isEmpty()


def test_impute_uses_one_global_median(spark):
    data = [(float(i),) for i in range(9)] + [(float("inf"),), (None,), (float("nan"),)]
    df = spark.createDataFrame(data, "x double").repartition(5)
    assert sorted(r["x"] for r in prepare.impute_median(df, ["x"]).collect())[4:8] == [4.0] * 4
    nothing = spark.createDataFrame([(None,)], "x double")
    assert prepare.impute_median(nothing, ["x"], 7.0).first()["x"] == 7.0


def test_window_arguments(spark):
    df, day = trip(spark), dt.date(2025, 1, 5)
    assert prepare.filter_window(df, day, day, 10, 11).count() == 1
    assert prepare.filter_window(df, day, day, 11, 12).count() == 0
    for bad in ((day, day - dt.timedelta(days=1), 0, 24), (day, day, -1, 4), (day, day, 3, 25), (day, day, 5, 5)):
        with pytest.raises(ValueError):
            prepare.filter_window(df, *bad)


def test_segments_hold_unreadable_hours_in_all(spark):
    for text, expected in (("07:59:59", [("all",)]), ("xx:00:00", [("all",)]), ("09:00:00", [("all",), ("morning",)])):
        assert rows(prepare.segment_trips(trip(spark, pickup_time=text)), "segment") == expected


def test_request_hours(spark):
    ask = lambda hour: prepare.normalise_pickup(
        spark.createDataFrame([(dt.date(2024, 12, 31), hour)], "pickup_date date, pickup_hour int")
    )
    row = ask(24).first()
    assert (row["_day"], row["_hour"], row["month"]) == (dt.date(2025, 1, 1), 0, 1)
    with pytest.raises(Exception, match="0 to 24"):
        ask(25).collect()
